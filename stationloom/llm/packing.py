"""Best-fit packing of tokenized documents into sequences of one capacity.

Lengths are whole numbers up to the capacity, so the packing is decided on the counts
of lengths alone, of which there are at most ``capacity``, whatever the corpus is:

* lengths above a third of the capacity pair up at most twice per sequence: from the
  longest down, each takes the longest partner that still fits;
* the others, from the longest down, go where the least room is left that holds them.

The decision is a list of ranges: so many items of this length, by their rank among
all of that length, go to these sequences at this offset. Ranks are counted in buckets
of a hash, so that no length, however common, meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks as B
from .tokens import BATCH_CHARS, encoder
from .words import spans


@dataclass(frozen=True)
class Range:
    """Items ``first`` to ``first + bins * each`` of one length go to ``bins`` sequences, ``each`` to every one."""

    length: int
    first: int
    bins: int
    each: int
    sequence: int
    offset: int


def plan_packing(counts: dict[int, int], capacity: int) -> list[Range]:
    """Decide on counts of lengths; every item gets one place, and sequences fill from the front."""
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    left = {length: n for length, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    room: dict[int, list[tuple[int, int]]] = {}  # space left: ranges of sequences
    plan: list[Range] = []
    sequences = 0

    def put(length: int, bins: int, each: int, sequence: int, offset: int) -> None:
        plan.append(Range(length, used[length], bins, each, sequence, offset))
        used[length] += bins * each
        left[length] -= bins * each

    def leave(space: int, sequence: int, bins: int) -> None:
        if space and bins:
            room.setdefault(space, []).append((sequence, bins))

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for a in large:
        while left[a]:
            partner = next((b for b in large if b <= min(a, capacity - a) and left[b] >= 1 + (a == b)), None)
            bins = left[a] if partner is None else left[a] // 2 if partner == a else min(left[a], left[partner])
            put(a, bins, 1, sequences, 0)
            if partner is not None:
                put(partner, bins, 1, sequences, a)
            leave(capacity - a - (partner or 0), sequences, bins)
            sequences += bins
    for a in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        for space in sorted(s for s in room if s >= a):
            each, ranges = space // a, room.pop(space)
            while ranges and left[a]:
                sequence, bins = ranges.pop()
                fill = min(bins, left[a] // each)
                if fill:
                    put(a, fill, each, sequence, capacity - space)
                    leave(space - each * a, sequence, fill)
                    sequence, bins = sequence + fill, bins - fill
                if bins and left[a]:
                    few = min(each, left[a])
                    put(a, 1, few, sequence, capacity - space)
                    leave(space - few * a, sequence, 1)
                    sequence, bins = sequence + 1, bins - 1
                if bins:
                    ranges.append((sequence, bins))
            if ranges:
                room.setdefault(space, []).extend(ranges)
            if not left[a]:
                break
        each = capacity // a
        for bins, few in ((left[a] // each, each), (1, left[a] % each)):
            if bins and few:
                put(a, bins, few, sequences, 0)
                leave(capacity - few * a, sequences, bins)
                sequences += bins
    return plan


def cut_documents(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Token ids of each text and ``end_id``, in pieces of at most ``capacity``; of longer ones the first may be shorter."""
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).encode
        for frame in frames:
            texts, keys = [t or "" for t in frame["text"]], frame["doc_id"].astype("Int64").array
            for a, b in spans(texts, BATCH_CHARS):
                ids, sizes = encode(texts[a:b])
                docs_of, rows, stop = [], [], 0
                for i, size in enumerate(sizes.tolist()):
                    own = np.append(ids[stop:stop + size], np.uint32(end_id)).astype("<u4")
                    stop += size
                    edges = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
                    for k, (s, e) in enumerate(zip(edges, edges[1:], strict=False)):
                        docs_of.append(a + i)
                        rows.append((k, s, e - s, zlib.crc32(own[s:e].tobytes())) + ((own[s:e].astype(np.int64),) if with_ids else ()))
                out = pd.DataFrame(rows, columns=["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
                out.insert(0, "doc_id", keys[docs_of])
                yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, and ``ids`` if asked for.

    A null or empty text is the end id alone. Rows with equal ids are packed each; other columns are not read. An empty
    table gives no pieces. Sequences fill without gaps from offset 0.
    """
    pieces = B.checkpointed(cut_documents(docs, vocabulary, capacity, end_id, with_ids))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = sorted(plan_packing(counts, capacity), key=lambda r: (r.length, r.first))
    keys = np.array([r.length for r in plan], dtype=np.int64) << 40 | np.array([r.first for r in plan], dtype=np.int64)
    first, each, sequence, offset = (np.array([getattr(r, k) for r in plan], dtype=np.int64) for k in ("first", "each", "sequence", "offset"))

    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (pieces.withColumn("rank", F.row_number().over(own) - 1).join(bases, ["length", "bucket"])
              .withColumn("rank", F.col("rank") + F.col("base")).drop("base", "bucket"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            at = np.searchsorted(keys, length << 40 | rank, "right") - 1
            k = rank - first[at]
            frame["sequence_id"] = sequence[at] + k // each[at]
            frame["offset"] = offset[at] + k % each[at] * length
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return ranked.select(*columns, "rank").mapInPandas(place, f"{schema}, rank long, sequence_id long, offset long").drop("rank")
