"""Benchmark decontamination: test items found inside documents by containment of their shingles.

Items are partitioned by size, each class up to 1.25 times its smallest member. A
document is read in windows three times as long as the largest item of a class, in
steps of that item, so an item of the class lies in one window and its containment of
0.8 means a Jaccard similarity of 0.2 or more with it. MinHash with one row to a band
and ``hashes`` bands then misses an item with probability ``0.8 ** hashes``: 64 make
that less than one in a million. A window can only share a minimum if it has one of
the items' minimal shingles, so all others are passed over by one look-up a word.
Candidates are verified on the words themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, mix, spans

SHINGLE = 5
#: Text bytes of the items that go to all tasks at once; more items take more rounds over the documents.
ITEM_BYTES = 4_000_000
GROWTH = 1.25


class Items:
    """Signatures of a block of items, by size class."""

    def __init__(self, ids: list[int], texts: list[str], hashes: int) -> None:
        words = Words([t.lower() for t in texts])
        at, found = words.windows(SHINGLE, words.hashes())
        doc = words.doc[at]
        self.ids, self.sets, self.top = ids, [_shingle_set(words, i) for i in range(len(ids))], []
        probes, owners, turns, classes = [], [], [], []
        for i in range(len(ids)):
            own = np.unique(found[doc == i])
            if not len(own):
                continue
            level = math.ceil(math.log(len(own), GROWTH))
            for turn in range(hashes):
                probes.append(own[np.argmin(_turned(own, turn))])
                owners.append(i)
                turns.append(turn)
                classes.append(level)
        order = np.argsort(np.array(probes, dtype=np.uint64), kind="stable")
        self.probes = np.array(probes, dtype=np.uint64)[order]
        self.owners, self.turns, self.levels = (np.array(x, dtype=np.int64)[order] for x in (owners, turns, classes))
        self.quick = np.zeros(1 << 20, dtype=bool)
        self.quick[self.probes >> np.uint64(44)] = True


def _turned(values: np.ndarray, turn: int) -> np.ndarray:
    return mix(values ^ np.uint64((int(turn) + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def _shingle_set(words: Words, doc: int) -> set[bytes]:
    first, last = int(words.first[doc]), int(words.first[doc + 1])
    own = [words.raw[s:e] for s, e in zip(words.start[first:last].tolist(), words.end[first:last].tolist(), strict=True)]
    return {b" ".join(own[i:i + SHINGLE]) for i in range(len(own) - SHINGLE + 1)}


def _search(words: Words, items: Items, threshold: float) -> Iterator[tuple[int, int, int, int]]:
    """Text, item, shingles of the item, how many of them the text has."""
    at, found = words.windows(SHINGLE, words.hashes())
    hits = np.flatnonzero(items.quick[found >> np.uint64(44)])
    low, high = (np.searchsorted(items.probes, found[hits], side) for side in ("left", "right"))
    doc_of = words.doc[at]
    edges = np.searchsorted(doc_of, np.arange(len(words.first)))
    settled: set[tuple[int, int]] = set()
    sets: dict[int, set[bytes]] = {}
    for hit, a, b in zip(hits[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
        doc = int(doc_of[hit])
        for k in range(a, b):
            item = int(items.owners[k])
            if (doc, item) in settled:
                continue
            size, begin, end = math.ceil(GROWTH ** items.levels[k]), edges[doc], edges[doc + 1]
            window = (hit - begin) // size
            for start in (begin + max(0, window - 2 + j) * size for j in range(3)):
                inside = found[start:min(end, start + 3 * size)]
                if start <= hit < start + 3 * size and _turned(inside, items.turns[k]).min() == _turned(found[hit:hit + 1], items.turns[k])[0]:
                    settled.add((doc, item))
                    if doc not in sets:
                        sets = {doc: _shingle_set(words, doc)}
                    common = len(items.sets[item] & sets[doc])
                    if common >= threshold * len(items.sets[item]) - 1e-9:
                        yield doc, item, len(items.sets[item]), common
                    break


def find_test_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8, hashes: int = 64, item_bytes: int = ITEM_BYTES,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_common, containment`` of every document that has an item's shingles.

    ``items`` has ``item_id, text``. Containment is the share of the item's distinct five-word shingles, lower-cased,
    that the whole document has; it must reach ``threshold``. Items of fewer than five words have no shingle and are
    never found, nor is anything in null, empty or shorter texts. Repeated rows are searched each; the columns
    named in ``carry`` come along, others are not read. Items go to the tasks in blocks of about ``item_bytes``, one
    round over the documents for each.
    """
    names = [f"carry_{i}" for i in range(len(carry))]
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(f"`{c}`").alias(n) for n, c in zip(names, carry, strict=True)])
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull())
    total = asked.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    rounds = max(1, math.ceil(total / item_bytes))
    schema = "doc_id long, item_id long, n_shingles long, n_common long, containment double" + "".join(
        f", {n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, carry, strict=True))
    out = None
    for k in range(rounds):
        block = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == k).orderBy("item_id", "text").collect()
        ids, texts = [r["item_id"] for r in block], [r["text"] for r in block]

        def search(frames: Iterator[pd.DataFrame], ids=ids, texts=texts) -> Iterator[pd.DataFrame]:
            signed = Items(ids, texts, hashes)
            for frame in frames:
                own_ids, own_texts = frame["doc_id"].astype("Int64").array, frame["text"].tolist()
                for a, b in spans(own_texts):
                    rows = [(a + d, ids[i], n, c, c / n) for d, i, n, c in _search(Words([(t or "").lower() for t in own_texts[a:b]]), signed, threshold)]
                    if rows:
                        at, *rest = zip(*rows, strict=True)
                        yield pd.DataFrame({"doc_id": own_ids[list(at)], "item_id": pd.array(rest[0], dtype="Int64"), "n_shingles": rest[1], "n_common": rest[2], "containment": rest[3]}
                                           | {n: frame[n].array[list(at)] for n in names})

        found = own.mapInPandas(search, schema)
        out = found if out is None else out.union(found)
    return out.withColumnsRenamed(dict(zip(names, carry, strict=True)))
