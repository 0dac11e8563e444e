"""Line deduplication with a reversible index: cuckoo filters in front of exact reference counts.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased; only keys of ``min_chars`` code points count. The index has

* references: which documents hold a key, by block of documents;
* counts: for each key and block, the number of documents with an id and the largest id, by shard of keys; rows
  without an id, one document over all blocks, show only as the largest id and are counted where blocks meet;
* one cuckoo filter per shard, holding a fingerprint of every key with a count above zero.

A key that a filter does not know needs no look-up among the counts; any other is
looked up exactly. Documents can be inserted and deleted: a shard gets the new counts
of a block, and fingerprints of keys that came or went are inserted or removed.
Within a block equal keys are counted first, so a line that every document holds
costs its shard one entry per block.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .cuckoo import CuckooFilter

_LAST = np.iinfo(np.int64).max
_STRIP = b" \t\n\x0b\x0c\r"
KEY = 16
REFERENCES = "block int, keys binary, docs binary"
COUNTS = "block int, shard int, keys binary, docs binary, tops binary"
FILTERS = "shard int, filter binary"


def _id(value) -> int:
    """A missing id counts as larger than all others."""
    return _LAST if pd.isna(value) else int(value)


def line_key(line: str, min_chars: int) -> bytes | None:
    """128-bit key of a line, none for a line that is too short to count."""
    if len(line) < min_chars:
        return None
    raw = line.encode("utf-8", "surrogatepass").strip(_STRIP).lower()
    if len(raw) < min_chars or len(line.strip(" \t\n\x0b\x0c\r")) < min_chars:
        return None
    return blake2b(raw, digest_size=KEY).digest()


def _holders(frame: pd.DataFrame, min_chars: int) -> dict[bytes, set[int]]:
    held: dict[bytes, set[int]] = {}
    for doc, text in zip(frame["doc_id"], frame["text"], strict=True):
        for line in (text or "").split("\n"):
            key = line_key(line, min_chars)
            if key is not None:
                held.setdefault(key, set()).add(_id(doc))
    return held


def _pack_references(block: int, held: dict[bytes, set[int]]) -> pd.DataFrame:
    pairs = [(k, d) for k in sorted(held) for d in sorted(held[k])]
    return pd.DataFrame([(block, b"".join(k for k, _ in pairs), np.array([d for _, d in pairs], dtype=np.int64).tobytes())],
                        columns=["block", "keys", "docs"])


def _unpack_references(frame: pd.DataFrame) -> dict[bytes, set[int]]:
    held: dict[bytes, set[int]] = {}
    for keys, docs in zip(frame["keys"], frame["docs"], strict=True):
        for i, doc in enumerate(np.frombuffer(docs, dtype=np.int64).tolist()):
            held.setdefault(keys[KEY * i:KEY * i + KEY], set()).add(doc)
    return held


def _heads(keys: bytes) -> np.ndarray:
    """First half of each key as a number; its order is the order of the keys."""
    return np.frombuffer(keys, dtype=">u8").reshape(-1, 2)[:, 0].astype(np.uint64)


def _count_rows(n_shards: int):
    def counts(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        held = _unpack_references(frame)
        keys = sorted(held)
        cut = B.cuts(_heads(b"".join(keys)), n_shards, 64) if keys else [0]
        rows = []
        for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
            if b > a:
                rows.append((key[0], k, b"".join(keys[a:b]), np.array([len(held[x] - {_LAST}) for x in keys[a:b]], dtype=np.int64).tobytes(),
                             np.array([max(held[x]) for x in keys[a:b]], dtype=np.int64).tobytes()))
        return pd.DataFrame(rows, columns=["block", "shard", "keys", "docs", "tops"])
    return counts


class _Shard:
    """The filter and the exact counts of one shard while parts of blocks come in."""

    def __init__(self, capacity: int, packed: bytes | None = None) -> None:
        self.filter = CuckooFilter(capacity, packed)
        self.total: dict[bytes, list[int]] = {}

    def add(self, keys: bytes, docs: bytes, tops: bytes) -> None:
        heads = _heads(keys)
        maybe = self.filter.contains(heads)
        fresh = np.ones(len(heads), dtype=bool)
        for i, (n, top) in enumerate(zip(np.frombuffer(docs, dtype=np.int64).tolist(), np.frombuffer(tops, dtype=np.int64).tolist(), strict=True)):
            key = keys[KEY * i:KEY * i + KEY]
            entry = self.total.get(key) if maybe[i] else None
            if entry is None:
                self.total[key] = [n, top]
            else:
                fresh[i] = False
                entry[0] += n
                entry[1] = max(entry[1], top)
        if not self.filter.insert(heads[fresh]):
            self.rebuild()

    def rebuild(self) -> None:
        heads, size = _heads(b"".join(self.total)), 2 * len(self.total)
        while True:
            self.filter = CuckooFilter(size)
            if self.filter.insert(heads):
                return
            size *= 2


def _decide(min_docs: int):
    """Of each key of each block: does it repeat in enough documents, and does the block hold its largest id?"""
    def decided(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        shard = _Shard(sum(len(k) for k in frame["keys"]) // KEY)
        for part in zip(frame["keys"], frame["docs"], frame["tops"], strict=True):
            shard.add(*part)
        rows = []
        for block, keys, tops in zip(frame["block"], frame["keys"], frame["tops"], strict=True):
            here = [shard.total[keys[i:i + KEY]] for i in range(0, len(keys), KEY)]
            drop = np.array([n + (t == _LAST) >= min_docs for n, t in here])
            top = np.array([t for _, t in here]) == np.frombuffer(tops, dtype=np.int64)
            rows.append((block, key[0], len(here), B.bits_of(np.concatenate([drop, top]))))
        return pd.DataFrame(rows, columns=["block", "shard", "n", "bits"])
    return decided


def _rebuild(min_chars: int, names: list[str]):
    def kept(key: tuple, frame: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        held = _holders(frame, min_chars)
        drop, top = [], []
        for _, packed, n in sorted(bits[["shard", "bits", "n"]].itertuples(index=False, name=None)):
            flags = B.flags_of(packed, 2 * n)
            drop.append(flags[:n])
            top.append(flags[n:])
        gone = {}  # key: the only id that keeps it, none if that is in another block
        if drop:
            for k, d, t in zip(sorted(held), np.concatenate(drop), np.concatenate(top), strict=True):
                if d:
                    gone[k] = max(held[k]) if t else None
        out = []
        for doc, text in zip(frame["doc_id"], frame["text"], strict=True):
            lines = (text or "").split("\n")
            stay = []
            for line in lines:
                k = line_key(line, min_chars)
                if k is None or k not in gone or gone[k] == _id(doc):
                    stay.append(line)
            out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
        done = pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])
        done.insert(0, "doc_id", frame["doc_id"].astype("Int64").array)
        for name in names:
            done[name] = frame[name].array
        return done
    return kept


def _rows(docs: DataFrame, n_blocks: int, carry: list[str]) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       *[F.col(f"`{c}`").alias(f"carry_{i}") for i, c in enumerate(carry)])
    return rows.withColumn("block", B.block_of(F.col("doc_id"), F.col("text"), n_blocks))


def _references(rows: DataFrame, min_chars: int) -> DataFrame:
    def made(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _pack_references(key[0], _holders(frame, min_chars))
    return rows.groupBy("block").applyInPandas(made, REFERENCES)


def drop_repeated_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, carry: tuple[str, ...] = (),
                        block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """Drop the lines whose key is in at least ``min_docs`` documents, except in the largest id that holds it.

    Returns ``doc_id, n_lines`` (before), ``n_dropped, kept`` and the columns named in ``carry``, one row for each row
    of ``docs``; other columns are not read. A null or empty text is one empty line. Rows with equal ids are one
    document; rows without an id count as one document with the largest id. ``carry`` must not name result columns.
    """
    clash = {"doc_id", "n_lines", "n_dropped", "kept"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results and cannot be carried")
    n_blocks, n_shards = B.block_counts(docs.sparkSession, B.text_bytes(docs, "text"), block_bytes)
    rows = _rows(docs, n_blocks, list(carry))

    def counts(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _count_rows(n_shards)(key, _pack_references(key[0], _holders(frame, min_chars)))

    parts = rows.groupBy("block").applyInPandas(counts, COUNTS)
    bits = parts.groupBy("shard").applyInPandas(_decide(min_docs), "block int, shard int, n int, bits binary")
    names = [f"carry_{i}" for i in range(len(carry))]
    schema = "doc_id long, n_lines long, n_dropped long, kept string" + "".join(
        f", {n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, carry, strict=True))
    done = rows.groupBy("block").cogroup(bits.groupBy("block")).applyInPandas(_rebuild(min_chars, names), schema)
    return done.withColumnsRenamed(dict(zip(names, carry, strict=True)))


@dataclass
class LineIndex:
    """The index as three frames; checkpoint or write them between batches."""

    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    n_blocks: int
    n_shards: int
    min_chars: int

    @classmethod
    def empty(cls, spark, n_blocks: int, n_shards: int, min_chars: int = 40) -> LineIndex:
        return cls(spark.createDataFrame([], REFERENCES), spark.createDataFrame([], COUNTS),
                   spark.createDataFrame([], FILTERS), n_blocks, n_shards, min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with the documents added; a document that it has already gains the lines it lacked."""
        def merged(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
            held = _unpack_references(old)
            for k, d in _unpack_references(new).items():
                held.setdefault(k, set()).update(d)
            return _pack_references(key[0], held)

        new = _references(_rows(docs, self.n_blocks, []), self.min_chars)
        return self._with(self.references.groupBy("block").cogroup(new.groupBy("block")).applyInPandas(merged, REFERENCES))

    def delete(self, docs: DataFrame) -> LineIndex:
        """The index as if the documents with these ids and texts had never come."""
        def merged(key: tuple, old: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
            ids = {_id(d) for d in gone["doc_id"]}
            return _pack_references(key[0], {k: d - ids for k, d in _unpack_references(old).items() if d - ids})

        rows = _rows(docs, self.n_blocks, []).select("block", "doc_id")
        return self._with(self.references.groupBy("block").cogroup(rows.groupBy("block")).applyInPandas(merged, REFERENCES))

    def _with(self, references: DataFrame) -> LineIndex:
        """Counts of the new references, and filters changed by the keys that came and went."""
        references = B.checkpointed(references)
        counts = references.groupBy("block").applyInPandas(_count_rows(self.n_shards), COUNTS)
        both = self.counts.withColumn("now", F.lit(0)).unionByName(counts.withColumn("now", F.lit(1)))

        def changed(key: tuple, state: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
            seen = [set(), set()]
            for keys, now in zip(parts["keys"], parts["now"], strict=True):
                seen[now].update(keys[i:i + KEY] for i in range(0, len(keys), KEY))
            shard = _Shard(len(seen[1]), state["filter"].iloc[0] if len(state) else None)
            shard.filter.remove(_heads(b"".join(seen[0] - seen[1])))
            if not shard.filter.insert(_heads(b"".join(sorted(seen[1] - seen[0])))):
                shard.total = dict.fromkeys(seen[1])
                shard.rebuild()
            return pd.DataFrame([(key[0], shard.filter.pack())], columns=["shard", "filter"])

        filters = self.filters.groupBy("shard").cogroup(both.groupBy("shard")).applyInPandas(changed, FILTERS)
        return LineIndex(references, counts, B.checkpointed(filters), self.n_blocks, self.n_shards, self.min_chars)

    def repeated(self, min_docs: int = 5) -> DataFrame:
        """``key, n_docs, largest_doc`` of the keys that enough documents hold."""
        def unpack(frames):
            for frame in frames:
                for keys, docs, tops in zip(frame["keys"], frame["docs"], frame["tops"], strict=True):
                    yield pd.DataFrame({"key": [keys[i:i + KEY].hex() for i in range(0, len(keys), KEY)],
                                        "n": np.frombuffer(docs, dtype=np.int64), "top": np.frombuffer(tops, dtype=np.int64)})

        flat = self.counts.select("keys", "docs", "tops").mapInPandas(unpack, "key string, n long, top long")
        found = flat.groupBy("key").agg(F.sum("n").alias("n_docs"), F.max("top").alias("largest_doc"))
        found = found.withColumn("n_docs", F.col("n_docs") + (F.col("largest_doc") == _LAST).cast("long"))
        return found.filter(F.col("n_docs") >= min_docs)
