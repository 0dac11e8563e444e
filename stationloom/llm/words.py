"""Word boundaries and rolling hashes of many texts at once, on byte arrays.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. Those bytes never
occur inside a longer UTF-8 character, so bytes are enough. Hashes are 64 bits;
callers that need certainty take two of them with different seeds.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Texts are taken together up to this many bytes; a longer text is taken alone.
BATCH_BYTES = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=8)
def _seeded(seed: int) -> tuple[np.ndarray, int, int]:
    """A table of random byte values, an odd base, and its inverse modulo 2**64."""
    rng = np.random.default_rng(1000 + seed)
    base = int(rng.integers(1 << 62, dtype=np.uint64)) * 8 + 5
    return rng.integers(1 << 64, size=256, dtype=np.uint64), base % (1 << 64), pow(base, -1, 1 << 64)


_KEPT: dict[str, dict] = {}


def kept(kind: str) -> dict:
    """What this worker keeps from batch to batch for one kind of work.

    Python workers outlive the stages they were started for, so what another kind of work left behind is let go first.
    """
    if kind not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            gc.collect()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim is not None:
                trim(0)
        _KEPT[kind] = {}
    return _KEPT[kind]


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** k`` modulo 2**64 for k below n; kept up to the size of a batch."""
    powers = kept("powers")
    have = powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        out = np.empty(size, dtype=np.uint64)
        out[0] = 1
        done = 1
        while done < size:
            step = min(done, size - done)
            out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        have = out
        if size <= 2 * BATCH_BYTES:
            powers[base] = out
    return have[:n]


class Words:
    """Words of a list of texts: ``start`` and ``end`` bytes, ``doc`` index, ``first`` word of each text."""

    def __init__(self, texts: Iterable[str | None]) -> None:
        encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.raw = b"\n".join(encoded) + b"\n"
        self.data = np.frombuffer(self.raw, dtype=np.uint8)
        inside = ~_SPACE[self.data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        ends = np.cumsum([len(e) + 1 for e in encoded], dtype=np.int64)
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends)])
        self.doc = np.repeat(np.arange(len(encoded)), np.diff(self.first))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        table, base, inverse = _seeded(seed)
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[self.data] * _powers(base, n), out=sums[1:])
        found = (sums[self.end] - sums[self.start]) * _powers(inverse, n)[self.start]
        return mix(found + (self.end - self.start).astype(np.uint64))

    def windows(self, width: int, words: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``width`` words inside one text, and a hash of each window."""
        n = len(words)
        if n < width:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        _, base, inverse = _seeded(seed + 100)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * _powers(base, n), out=sums[1:])
        at = np.flatnonzero(self.doc[:n - width + 1] == self.doc[width - 1:])
        return at, mix((sums[at + width] - sums[at]) * _powers(inverse, n)[at] + np.uint64(width))


def spans(texts: list, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts that together stay near ``limit`` characters."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "") + 1
        if size >= limit:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
