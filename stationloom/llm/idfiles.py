"""Token ids in binary files: one zstandard frame a document, one shared dictionary, an offset index a file.

A folder holds

* ``dictionary``: a zstandard dictionary trained on serialized id arrays of a bounded sample of documents;
* ``shard-*.ids``: a header with the dictionary's hash and the width of an id, the documents' frames in ascending
  order of their ids, an index (document id, offset, number of ids) and a trailer that tells where the index is;
* ``manifest``: a table of the shards that belong to the folder, in order, with the first and last document of each.

Short documents compress with the dictionary alone, so any one of them is read by its own bytes, without neighbours.
Tasks write shards under names of their own, and only shards of tasks that ended well come into the manifest; what a
lost task leaves behind is never read. Paths are those of ``pyarrow.fs``: local or shared folders, or URIs.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks as B
from .tokens import BATCH_CHARS, encoder
from .words import spans

MAGIC = b"SLIDS001"
#: magic, sha256 of the dictionary, bytes of an id.
HEADER = struct.Struct("<8s32sB")
#: offset of the index, documents, crc32 of the index, magic.
TRAILER = struct.Struct("<QQI8s")
SHARD_BYTES = 32_000_000
READ_BYTES = 8_000_000
#: Documents whose ids the dictionary is trained on, and the pieces taken of one of them.
SAMPLE_DOCS, SAMPLE_PIECES, PIECE_BYTES = 1024, 4, 2048
DICTIONARY_BYTES = 110_000
LEVEL = 3
_FRAMES = "doc_id long, n_tokens long, frame binary"
_SHARDS = "first_null boolean, first_id long, first_place long, last_null boolean, last_id long, file string, n_docs long, n_tokens long"


def _at(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def _read_all(folder: str, name: str) -> bytes:
    system, path = _at(folder)
    with system.open_input_file(f"{path}/{name}") as file:
        return file.read()


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT) if raw else None


def _id_arrays(frames: Iterator[pd.DataFrame], vocabulary: str, end_id: int, width: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Batches of rows and the ids of each, with the end id."""
    encode = encoder(vocabulary).encode
    for frame in frames:
        texts = [t or "" for t in frame["text"]]
        for a, b in spans(texts, BATCH_CHARS):
            ids, sizes = encode(texts[a:b])
            whole = np.insert(ids, np.cumsum(sizes), end_id).astype(f"<u{width}")
            yield frame.iloc[a:b], np.split(whole, np.cumsum(sizes + 1)[:-1])


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int, width: int, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """A dictionary from at most ``sample_docs`` documents, those of the least hashes; empty if they are too few to train on.

    A sampled document gives up to ``SAMPLE_PIECES`` pieces, spread evenly over it. Equal rows count as one.
    """
    own = docs.select("text", F.xxhash64("doc_id", "text").alias("hash"))
    # first a share of all hashes that holds enough of them, so that few are sorted
    share = min(1.0, 8 * sample_docs / max(1, own.count()))
    few = own.filter(F.col("hash") <= int(-2 ** 63 + share * (2 ** 64 - 1)) if share < 1 else F.lit(True))
    last = few.select("hash").distinct().orderBy("hash").limit(sample_docs).agg(F.max("hash").alias("h")).first()["h"]
    if last is None:
        return b""

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, arrays in _id_arrays(frames, vocabulary, end_id, width):
            rows = []
            for key, ids in zip(frame["hash"].tolist(), arrays, strict=True):
                raw = ids.tobytes()
                cuts = np.unique(np.linspace(0, max(0, len(raw) - PIECE_BYTES), SAMPLE_PIECES).astype(np.int64) // width * width)
                rows += [(key, k, raw[c:c + PIECE_BYTES]) for k, c in enumerate(cuts.tolist())]
            yield pd.DataFrame(rows, columns=["hash", "k", "piece"])

    one = few.filter(F.col("hash") <= last).groupBy("hash").agg(F.first("text").alias("text"))
    samples = [bytes(r["piece"]) for r in one.mapInPandas(pieces, "hash long, k int, piece binary").orderBy("hash", "k").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too short
        return b""


def write_ids(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 2, shard_bytes: int = SHARD_BYTES, sample_docs: int = SAMPLE_DOCS) -> None:
    """Write the ids of every whole text and ``end_id`` to a new ``folder``, in ascending order of ``doc_id``.

    A null or empty text is the end id alone. Rows with equal ids are written each, one after the other, and rows without
    an id at the end. An empty table gives a folder without shards. Columns other than ``doc_id, text`` are not read.
    """
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    width = 2 if max(Tokenizer.from_file(vocabulary).get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    system, path = _at(folder)
    system.create_dir(path, recursive=True)
    raw = train_dictionary(docs, vocabulary, end_id, width, sample_docs)
    with system.open_output_stream(f"{path}/dictionary") as file:
        file.write(raw)

    def compress(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = _dictionary(_read_all(folder, "dictionary"))
        if shared:
            shared.precompute_compress(level=LEVEL)
        make = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_dict_id=False)
        for frame, arrays in _id_arrays(frames, vocabulary, end_id, width):
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64").array, "n_tokens": [len(x) for x in arrays], "frame": [make.compress(x.tobytes()) for x in arrays]})

    made = B.checkpointed(docs.mapInPandas(compress, _FRAMES).withColumn("place", F.monotonically_increasing_id()))
    total = made.agg(F.sum(F.octet_length("frame")).alias("n")).first()["n"] or 0
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("place")]
    dealt = made.repartitionByRange(max(1, -(-total // shard_bytes)), *order).sortWithinPartitions(*order)
    shards = dealt.mapInPandas(lambda frames: _write_shard(frames, folder, hashlib.sha256(raw).digest(), width), _SHARDS)
    shards.write.parquet(f"{folder}/manifest")


def _write_shard(frames: Iterator[pd.DataFrame], folder: str, digest: bytes, width: int) -> Iterator[pd.DataFrame]:
    """One shard of the rows of a partition, if it has any."""
    system, path = _at(folder)
    name, file, at = f"shard-{uuid.uuid4().hex}.ids", None, HEADER.size
    ids, missing, offsets, sizes = [], [], [], []
    for frame in frames:
        if not len(frame):
            continue
        if file is None:
            file, first = system.open_output_stream(f"{path}/{name}"), frame["place"].iloc[0]
            file.write(HEADER.pack(MAGIC, digest, width))
        file.write(b"".join(frame["frame"]))
        lengths = np.array([len(x) for x in frame["frame"]], dtype=np.int64)
        offsets.append(at + np.cumsum(lengths) - lengths)
        at += int(lengths.sum())
        ids.append(frame["doc_id"].fillna(0).to_numpy(dtype=np.int64))
        missing.append(frame["doc_id"].isna().to_numpy())
        sizes.append(frame["n_tokens"].to_numpy(dtype=np.int64))
    if file is None:
        return
    ids, missing, offsets, sizes = map(np.concatenate, (ids, missing, offsets, sizes))
    index = b"".join(x.tobytes() for x in (ids.astype("<i8"), offsets.astype("<u8"), sizes.astype("<i8"), missing.astype("u1")))
    file.write(index + TRAILER.pack(at, len(ids), zlib.crc32(index), MAGIC))
    file.close()
    yield pd.DataFrame([(bool(missing[0]), int(ids[0]), int(first), bool(missing[-1]), int(ids[-1]), name, len(ids), int(sizes.sum()))],
                       columns=[c.strip().split(" ")[0] for c in _SHARDS.split(",")])


class _Shard:
    """An open shard: its index, and any of its documents."""

    def __init__(self, folder: str, name: str, dictionary: bytes) -> None:
        system, path = _at(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        magic, digest, self.width = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        end = self.file.size() - TRAILER.size
        at, n, check, again = TRAILER.unpack(self.file.read_at(TRAILER.size, end))
        index = self.file.read_at(end - at, at) if magic == again == MAGIC and at <= end else None
        if index is None or zlib.crc32(index) != check:
            raise ValueError(f"{name} is no whole file of token ids")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name} was written with another dictionary")
        self.ids, offsets, self.sizes = (np.frombuffer(index, dtype=t, count=n, offset=8 * n * k) for k, t in enumerate(("<i8", "<u8", "<i8")))
        self.missing = np.frombuffer(index, dtype="u1", count=n, offset=24 * n).astype(bool)
        self.edges = np.append(offsets.astype(np.int64), at)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def documents(self, first: int, last: int) -> Iterator[tuple[int, np.ndarray]]:
        """Number and ids of consecutive documents, read some megabytes at a time."""
        while first < last:
            upto = min(last, max(first + 1, int(np.searchsorted(self.edges, self.edges[first] + READ_BYTES, "right")) - 1))
            raw = memoryview(self.file.read_at(int(self.edges[upto] - self.edges[first]), int(self.edges[first])))
            for i in range(first, upto):
                frame = raw[self.edges[i] - self.edges[first]:self.edges[i + 1] - self.edges[first]]
                ids = np.frombuffer(self.reader.decompress(frame, max_output_size=int(self.sizes[i]) * self.width), dtype=f"<u{self.width}").astype("<u4")
                if len(ids) != self.sizes[i]:
                    raise ValueError("a document has another number of ids than the index says")
                yield i, ids
            first = upto


def _manifest(spark: SparkSession, folder: str) -> list[tuple]:
    """Shards in order, with the number of ids before each."""
    rows = sorted(spark.read.parquet(f"{folder}/manifest").collect(), key=lambda r: (r["first_null"], r["first_id"], r["first_place"]))
    before = np.cumsum([0] + [r["n_tokens"] for r in rows]).tolist()
    return [(r["file"], b, r["first_null"], r["first_id"], r["last_null"], r["last_id"]) for r, b in zip(rows, before, strict=False)]


def _read(spark: SparkSession, folder: str, shards: list[tuple], pick, with_ids: bool) -> DataFrame:
    """Documents of shards; ``pick`` gives the ranges of documents to read of an open one."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dictionary = _read_all(folder, "dictionary")
        for frame in frames:
            for name, before in zip(frame["file"], frame["before"], strict=True):
                shard, rows, size = _Shard(folder, name, dictionary), [], 0
                for first, last in pick(shard):
                    for i, ids in shard.documents(first, last):
                        rows.append((None if shard.missing[i] else int(shard.ids[i]), before + int(shard.starts[i]), len(ids), zlib.crc32(ids.tobytes()))
                                    + ((ids.astype(np.int64),) if with_ids else ()))
                        size += len(ids)
                        if size > READ_BYTES or len(rows) >= 10_000:
                            yield made(rows)
                            rows, size = [], 0
                yield made(rows)

    columns = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def made(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    files = spark.createDataFrame([s[:2] for s in shards], "file string, before long").repartition(max(1, len(shards)))
    return files.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files of ``folder``, and ``ids`` if asked for.

    ``start`` is the number of ids of all documents before it. A shard with another dictionary, or not whole, is an error.
    """
    return _read(spark, folder, _manifest(spark, folder), lambda shard: [(0, len(shard.ids))], with_ids)


def fetch_ids(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The same with ``ids`` for a list of documents: only shards that may hold them are opened, only their bytes are read.

    Ids that the files do not hold give no row; repeated ones of the files give each of their rows.
    """
    wanted = np.unique(np.array(doc_ids, dtype=np.int64))

    def may_hold(shard: tuple) -> bool:
        _, _, first_null, first_id, last_null, last_id = shard
        if first_null or not len(wanted):
            return False
        k = np.searchsorted(wanted, first_id)
        return k < len(wanted) and (last_null or wanted[k] <= last_id)

    def pick(shard: _Shard) -> list[tuple[int, int]]:
        own = shard.ids[:len(shard.ids) - int(shard.missing.sum())]
        low, high = np.searchsorted(own, wanted, "left"), np.searchsorted(own, wanted, "right")
        return [(a, b) for a, b in zip(low.tolist(), high.tolist(), strict=True) if b > a]

    return _read(spark, folder, [s for s in _manifest(spark, folder) if may_hold(s)], pick, True)
