"""A cuckoo filter: sixteen-bit fingerprints in buckets of four, with exact deletion of what was inserted."""

from __future__ import annotations

import numpy as np

from .words import mix

SLOTS = 4
_ROUNDS = 400


class CuckooFilter:
    """Approximate membership of 64-bit keys; no false negatives, and inserted keys can be removed again."""

    def __init__(self, capacity: int = 0, packed: bytes | None = None) -> None:
        if packed is None:
            buckets = 1 << max(2, int(capacity / SLOTS / 0.8).bit_length())
            self.table = np.zeros((buckets, SLOTS), dtype=np.uint16)
        else:
            self.table = np.frombuffer(packed, dtype=np.uint16).reshape(-1, SLOTS).copy()

    def pack(self) -> bytes:
        return self.table.tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table))

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(prints.astype(np.uint64)).astype(np.int64) & (len(self.table) - 1))

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spread = mix(keys.astype(np.uint64) + np.uint64(77))
        prints = (spread >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return (spread & np.uint64(len(self.table) - 1)).astype(np.int64), prints

    def contains(self, keys: np.ndarray) -> np.ndarray:
        bucket, prints = self._place(keys)
        same = self.table[bucket] == prints[:, None]
        return same.any(axis=1) | (self.table[self._other(bucket, prints)] == prints[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Insert keys, each once more; false if they do not fit, and then the filter has to be built anew, larger."""
        bucket, prints = self._place(keys)
        rng = np.random.default_rng(len(keys))
        for turn in range(_ROUNDS):
            if not len(bucket):
                return True
            order = np.argsort(bucket, kind="stable")
            bucket, prints = bucket[order], prints[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            # free slots of each bucket first, in order
            by_use = np.argsort(self.table[bucket] != 0, axis=1, kind="stable")
            free = SLOTS - np.count_nonzero(self.table[bucket], axis=1)
            fits = rank < free
            self.table[bucket[fits], by_use[fits, rank[fits]]] = prints[fits]
            bucket, prints, rank = bucket[~fits], prints[~fits], rank[~fits]
            if turn % 2:  # both buckets are full: one waiting key of each bucket throws out another
                lead = np.flatnonzero(np.diff(bucket, prepend=-1) != 0)
                slot = rng.integers(SLOTS, size=len(lead))
                out = self.table[bucket[lead], slot].copy()
                self.table[bucket[lead], slot] = prints[lead]
                prints[lead] = out
            bucket = self._other(bucket, prints)
        return not len(bucket)

    def remove(self, keys: np.ndarray) -> None:
        """Remove keys that were inserted before, one copy each."""
        for bucket, mark in zip(*self._place(keys), strict=True):
            for b in (bucket, self._other(np.array([bucket]), np.array([mark]))[0]):
                held = np.flatnonzero(self.table[b] == mark)
                if len(held):
                    self.table[b, held[0]] = 0
                    break
