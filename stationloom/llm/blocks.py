"""Documents in blocks that talk to shards of a hash space through small packed rows.

A block is a set of documents chosen by a hash of the id, so it is the same in
every pass and after a lost task. A block sends each shard one packed row and gets
one bit per entry back, in the order it sent them. Equal entries of one block are
sent once, so an entry that every document holds costs one entry per block.
"""

from __future__ import annotations

import math
import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes of one block at most on average; raise it with executor memory.
BLOCK_BYTES = 16_000_000


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, from ``spark.checkpoint.dir``; its own only in local mode, as in tests."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = context.getConf().get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back, so that lost executors cost no recomputation."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return int(docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()["n"] or 0)


def block_counts(spark: SparkSession, n_bytes: int, block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """Numbers of blocks and shards: in proportion to the text, and enough for the session's shuffle partitions."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(partitions, math.ceil(n_bytes / block_bytes))
    return 2 * shards, shards


def block_of(doc_id: Column, text: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(doc_id, F.xxhash64(text))), F.lit(n_blocks)).cast("int")


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers below 2**62 as differences, seven bits to a byte."""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    if not len(gaps):
        return b""
    width = np.ones(len(gaps), dtype=np.int64)
    limit = 7
    while limit < 63 and (more := gaps >= np.uint64(1 << limit)).any():
        width += more
        limit += 7
    last = np.cumsum(width)
    out = np.zeros(last[-1], dtype=np.uint8)
    first = last - width
    for k in range(int(width.max())):
        sel = width > k
        part = (gaps[sel] >> np.uint64(7 * k)) & np.uint64(127)
        out[first[sel] + k] = part.astype(np.uint8) | np.where(width[sel] > k + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.uint64)
    stop = np.flatnonzero(raw < 128)
    begin = np.concatenate([[0], stop[:-1] + 1])
    gaps = np.zeros(len(stop), dtype=np.uint64)
    width = stop - begin + 1
    for k in range(int(width.max())):
        sel = width > k
        gaps[sel] |= (raw[begin[sel] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
    return np.cumsum(gaps)


def cuts(sorted_keys: np.ndarray, n_shards: int, bits: int) -> np.ndarray:
    """Where ascending keys of ``bits`` bits pass from shard to shard; shards are equal ranges."""
    edges = np.array([(k << bits) // n_shards for k in range(1, n_shards)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_keys, edges), [len(sorted_keys)]])


def bits_of(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags_of(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, dtype=np.uint8), count=n).astype(bool)
