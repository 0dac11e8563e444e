"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document is its set of shingles: five words each, lower-cased, each of weight one,
because links are verified on sets. Each shingle is a Poisson process of rate its
weight; arrivals fall on random registers, and a register keeps its first arrival.
Processing stops as soon as no later arrival can be first anywhere. The share of
registers in which two signatures agree estimates their probability Jaccard similarity,
which for weights of one is the Jaccard similarity of the sets.

Equal texts become one vertex. Bands of registers give buckets; links from the first
member of a bucket to all others are verified on the exact sets of shingles. Members
of a bucket that are connected by then need no more comparison. Where a bucket still
holds several classes, its members are compared by signature in blocks, which gives
families, and the members of a family by their exact sets. Both give links between classes only, no more
than join them, so a group of near copies costs links in proportion to its size and no
link between different texts is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .words import Words, mix, spans

SHINGLE = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Ends of links that one task of a search for components takes, at least.
TASK_ENDS = 250_000
#: Members of a bucket compared in one task.
PAIR_BLOCK = 512


def shingles(words: Words, hashes: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts and the text of each; a text below ``width`` words is one shingle of all its words."""
    at, found = words.windows(width, hashes)
    docs = words.doc[at]
    sizes = np.diff(words.first)
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        whole = np.array([_chain(hashes[words.first[d]:words.first[d + 1]]) for d in short], dtype=np.uint64)
        docs, found = np.concatenate([docs, short]), np.concatenate([found, whole])
    return found, docs


def _chain(hashes: np.ndarray) -> np.uint64:
    out = np.array([len(hashes)], dtype=np.uint64)
    for h in hashes:
        out = mix(out + h)
    return out[0]


def distinct_shingles(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles by text: hash, text."""
    found, docs = shingles(words, hashes)
    order = np.lexsort((found, docs))
    found, docs = found[order], docs[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (docs[1:] != docs[:-1])
    return found[new], docs[new]


def prob_min_hash(elements: np.ndarray, docs: np.ndarray, weights: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """Signatures of weighted sets: by document, the element whose arrival is first in each register."""
    arrival = np.full(n_docs * registers, np.inf)
    winner = np.zeros(n_docs * registers, dtype=np.uint64)
    time = np.zeros(len(elements))
    turn = 0
    while len(elements):
        turn += 1
        draw = mix(elements + _STEP * np.array([2 * turn], dtype=np.uint64))
        time = time - np.log(((draw >> np.uint64(11)) + 0.5) / (1 << 53)) / weights
        cell = docs * registers + (mix(draw + _STEP) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(arrival, cell, time)
        first = arrival[cell] == time
        winner[cell[first]] = elements[first]
        stop = arrival.reshape(n_docs, registers).max(axis=1)
        going = time < stop[docs]
        elements, docs, weights, time = elements[going], docs[going], weights[going], time[going]
    return winner.reshape(n_docs, registers)


def _lowered(texts: list) -> list[str]:
    return [(t or "").lower() for t in texts]


def _keys(words: Words) -> list[bytes | None]:
    """A 128-bit key of the words of each text, none where there are no words."""
    place = (np.arange(len(words.doc)) - words.first[words.doc] + 1).astype(np.uint64)
    size = np.diff(words.first).astype(np.uint64)
    halves = []
    for seed in (0, 1):
        sums = np.zeros(len(place) + 1, dtype=np.uint64)
        np.cumsum(mix(words.hashes(seed) + _STEP * place), out=sums[1:])
        halves.append(mix(sums[words.first[1:]] - sums[words.first[:-1]] + size))
    both = np.stack(halves, axis=1)
    return [both[i].tobytes() if n else None for i, n in enumerate(size)]


def signatures(docs: DataFrame, bands: int, rows: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, key, size, bands, marks``: key of the words, distinct shingles, band hashes, a byte of each register; columns of ``carry``."""
    registers, names = bands * rows, [f"carry_{i}" for i in range(len(carry))]

    def signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, ids = frame["text"].tolist(), frame["doc_id"].astype("Int64").array
            for a, b in spans(texts):
                words = Words(_lowered(texts[a:b]))
                found, doc = distinct_shingles(words, words.hashes())
                size = np.bincount(doc, minlength=b - a)
                sig = prob_min_hash(found, doc, np.ones(len(found)), b - a, registers)
                band = np.zeros((b - a, bands), dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _STEP
                for r in range(rows):
                    band = mix(band + sig[:, r::rows])
                marks = (mix(sig) & np.uint64(255)).astype(np.uint8)
                yield pd.DataFrame({"doc_id": ids[a:b], "key": _keys(words), "size": size, "bands": list(band.view(np.int64)),
                                    "marks": [m.tobytes() for m in marks]} | {n: frame[n].array[a:b] for n in names})

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(f"`{c}`").alias(n) for n, c in zip(names, carry, strict=True)])
    schema = "doc_id long, key binary, size int, bands array<long>, marks binary" + "".join(
        f", {n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, carry, strict=True))
    return own.mapInPandas(signed, schema).withColumnsRenamed(dict(zip(names, carry, strict=True)))


def _shingle_sets(docs: DataFrame) -> DataFrame:
    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            for a, b in spans(texts):
                words = Words(_lowered(texts[a:b]))
                found, doc = distinct_shingles(words, words.hashes())
                cut = np.searchsorted(doc, np.arange(1, b - a))
                yield pd.DataFrame({"key": _keys(words), "set": np.split(found.view(np.int64), cut)})

    return docs.select("text").mapInPandas(sets, "key binary, set array<long>")


def _sets_of(keys: DataFrame, docs: DataFrame, vertices: DataFrame) -> DataFrame:
    """``key, set`` of the shingles behind some keys; ``vertices`` gives a document id for each key."""
    ids = vertices.join(keys, "key", "left_semi").select(F.col("doc_id").alias("id")).distinct()
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    return _shingle_sets(texts.select("text")).filter(F.col("key").isNotNull()).dropDuplicates(["key"])


def _verify(pairs: DataFrame, docs: DataFrame, vertices: DataFrame, threshold: float) -> DataFrame:
    """Those ``a, b`` whose sets of shingles are similar enough."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), docs, vertices)
    joined = (pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("set_a")), "a")
              .join(sets.select(F.col("key").alias("b"), F.col("set").alias("set_b")), "b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = F.size("set_a") + F.size("set_b")
    return (joined.select("a", "b", common.alias("common"), both.alias("both"))
            .filter(F.col("common") >= threshold * (F.col("both") - F.col("common")) - 1e-9).select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """``v, label`` of every end of an edge; the label is the least key that can be reached.

    Rounds of least neighbours and of labels of labels, each written to the shared folder, until nothing changes.
    """
    both = B.checkpointed(edges.select(F.col("a").alias("v"), F.col("b").alias("u"))
                          .union(edges.select(F.col("b").alias("v"), F.col("a").alias("u"))).distinct())
    # Every round has a few shuffles: with as many tasks as the session's partitions, a few links would cost many small files.
    tasks = max(1, math.ceil(both.count() / TASK_ENDS))
    both = both.coalesce(tasks)
    labels = B.checkpointed(both.groupBy("v").agg(F.min("u").alias("least")).select("v", F.least("v", "least").alias("label")).coalesce(tasks))
    while True:
        near = (both.join(labels.select(F.col("v").alias("u"), "label"), "u").coalesce(tasks).groupBy("v").agg(F.min("label").alias("near")))
        nearer = (labels.join(near.coalesce(tasks), "v").coalesce(tasks)
                  .select("v", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        further = labels.select(F.col("v").alias("label"), F.col("label").alias("far"))
        labels = B.checkpointed(nearer.join(further, "label", "left").coalesce(tasks)
                                .select("v", "old", F.coalesce(F.least("label", "far"), F.col("label")).alias("label")))
        if labels.filter(F.col("old") != F.col("label")).isEmpty():
            return labels.select("v", "label")
        labels = labels.select("v", "label")


class _Forest:
    """Labels joined so far."""

    def __init__(self) -> None:
        self.up: dict[bytes, bytes] = {}

    def root(self, label: bytes) -> bytes:
        while (above := self.up.get(label, label)) != label:
            self.up[label] = self.up.get(above, above)
            label = above
        return label

    def join(self, a: bytes, b: bytes) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[a] = b
        return a != b


def _meetings(members: DataFrame, group: str, more: DataFrame) -> DataFrame:
    """Members of the groups that hold several labels, in parts; each part meets itself and every other part once.

    ``more`` has the other columns of each ``key``; only those members get them.
    """
    extra = [c for c in more.columns if c != "key"]
    parts = members.groupBy(group).agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    parts = parts.filter(F.col("low") != F.col("high")).select(group, F.ceil(F.col("n") / PAIR_BLOCK).cast("int").alias("parts"))
    own = members.join(parts, group).join(more, "key").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select(group, F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "key", "label", *extra)
    # few bytes, much work: keep all partitions
    return met.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), group, "p", "q")


def _sides(key: tuple, frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    _, p, q = key
    left = frame[frame["part"] == p]
    return left, left if p == q else frame[frame["part"] == q]


def _likely(members: DataFrame, marked: DataFrame, registers: int, threshold: float, least_share: float) -> DataFrame:
    """``a, b``: labels met in one bucket whose signatures leave similarity possible: a spanning forest, not all pairs."""
    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        left, right = _sides(key, frame)
        out, forest = [], _Forest()
        if len(left) and len(right):
            marks = np.frombuffer(b"".join(right["marks"]), dtype=np.uint8).reshape(len(right), registers)
            labels, sizes = right["label"].to_numpy(), right["size"].to_numpy()
            for label, size, mark in zip(left["label"], left["size"], left["marks"], strict=True):
                same = (marks == np.frombuffer(mark, dtype=np.uint8)).sum(axis=1)
                close = np.flatnonzero((same >= least_share * registers) & (labels != label) & (np.minimum(sizes, size) >= threshold * np.maximum(sizes, size) - 1e-9))
                out += [(label, labels[i]) for i in close if forest.join(label, labels[i])]
        return pd.DataFrame(out, columns=["a", "b"])

    return _meetings(members, "bucket", marked).groupBy("bucket", "p", "q").applyInPandas(compare, "a binary, b binary")


def _similar(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: labels of one family joined by exact similarity of any of their members: again a spanning forest."""
    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        left, right = _sides(key, frame)
        out, forest = [], _Forest()
        if len(left) and len(right):
            sizes = [np.array([len(x) for x in side["set"]]) for side in (left, right)]
            flat = [np.concatenate(list(side["set"])) for side in (left, right)]
            shared = np.intersect1d(flat[0], flat[1])
            at = [np.searchsorted(shared, f) for f in flat]
            row = [np.repeat(np.arange(len(n)), n) for n in sizes]
            held = [(a < len(shared)) & (shared[np.minimum(a, max(0, len(shared) - 1))] == f) if len(shared) else np.zeros(len(f), bool)
                    for a, f in zip(at, flat, strict=True)]
            common = np.zeros((len(left), len(right)), dtype=np.float32)
            for low in range(0, len(shared), 4096):
                tables = []
                for a, r, h, n in zip(at, row, held, sizes, strict=True):
                    sel = h & (a >= low) & (a < low + 4096)
                    table = np.zeros((len(n), 4096), dtype=np.float32)
                    table[r[sel], a[sel] - low] = 1
                    tables.append(table)
                common += tables[0] @ tables[1].T
            near = common >= threshold * (sizes[0][:, None] + sizes[1][None, :] - common) - 1e-6
            labels = [side["label"].tolist() for side in (left, right)]
            out = [(labels[0][i], labels[1][j]) for i, j in zip(*np.nonzero(near), strict=True) if forest.join(labels[0][i], labels[1][j])]
        return pd.DataFrame(out, columns=["a", "b"])

    return _meetings(members, "family", sets).groupBy("family", "p", "q").applyInPandas(compare, "a binary, b binary")


#: Least share of equal registers of two members of a bucket that are compared further; estimates of 0.8 scatter by 0.034.
LEAST_SHARE = 0.65


def class_labels(docs: DataFrame, threshold: float = 0.8, bands: int = 28, rows: int = 5, carry: tuple[str, ...] = (),
                 least_share: float = LEAST_SHARE) -> DataFrame:
    """``doc_id, n_shingles, label`` of every row, and its columns named in ``carry``; rows of one class have one label.

    A row whose text is null or has no words is alone in its class and has no label. Members of one bucket are compared
    further if their signatures agree in ``least_share`` of the registers; 0 compares all of them, which is exact for
    every pair that shares a bucket. The rest is as for :func:`near_duplicates`.
    """
    signed = B.checkpointed(signatures(docs, bands, rows, carry))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vertices = B.checkpointed(signed.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("marks").alias("marks")))
    buckets = B.checkpointed(vertices.select("key", F.explode("bands").alias("bucket")))
    centres = buckets.groupBy("bucket").agg(F.min("key").alias("centre"), F.count("*").alias("n")).filter(F.col("n") > 1)
    shared = B.checkpointed(buckets.join(centres.select("bucket", "centre"), "bucket"))
    stars = shared.filter(F.col("centre") != F.col("key")).select(F.col("centre").alias("a"), F.col("key").alias("b")).distinct()
    ids = vertices.select("key", "doc_id")
    links = B.checkpointed(_verify(B.checkpointed(stars), docs, ids, threshold))
    labels = components(links)
    members = (shared.select("bucket", "key").join(labels.withColumnRenamed("v", "key"), "key", "left")
               .withColumn("label", F.coalesce("label", "key")))
    marked = vertices.select("key", "size", "marks")
    likely = B.checkpointed(_likely(members, marked, bands * rows, threshold, least_share))
    if not likely.isEmpty():
        families = components(likely).select(F.col("v").alias("class"), F.col("label").alias("family"))
        classed = labels.join(families, F.col("label") == F.col("class")).select(F.col("v").alias("key"), "label", "family")
        alone = families.join(labels, F.col("class") == F.col("v"), "left_anti")
        inside = B.checkpointed(classed.union(alone.select(F.col("class").alias("key"), F.col("class").alias("label"), "family")))
        more = B.checkpointed(_similar(inside, _sets_of(inside, docs, ids), threshold))
        if not more.isEmpty():
            joined = components(more).select(F.col("v").alias("class"), F.col("label").alias("least"))
            alone = joined.join(labels, F.col("class") == F.col("v"), "left_anti").select(F.col("class").alias("v"), F.col("least").alias("label"))
            labels = (labels.join(joined, F.col("label") == F.col("class"), "left")
                      .select("v", F.coalesce("least", "label").alias("label")).union(alone))
    carried = [F.col(f"`{c}`") for c in carry]
    named = (signed.select("doc_id", "key", F.col("size").alias("n_shingles"), *carried).join(labels.withColumnRenamed("v", "key"), "key", "left")
             .select("doc_id", "n_shingles", F.coalesce("label", "key").alias("label"), *carried))
    return B.checkpointed(named)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, bands: int = 28, rows: int = 5, least_share: float = LEAST_SHARE) -> DataFrame:
    """``doc_id, class_id, n_shingles`` of every row; rows of one class are connected by similarities of ``threshold`` or more.

    Similarity is that of the sets of lower-cased five-word shingles. ``class_id`` is the least id of the class. A text
    of one to four words is one shingle; null texts and texts without words are alone in their classes, each under its
    own id. Equal texts are one class even under one id; a class without any id has none. Other columns are not read.
    ``least_share`` is that of :func:`class_labels`.
    """
    named = class_labels(docs, threshold, bands, rows, least_share=least_share)
    classes = named.filter(F.col("label").isNotNull()).groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return named.join(classes, "label", "left").select(
        "doc_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "n_shingles")
