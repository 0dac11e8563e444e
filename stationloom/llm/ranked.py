"""Ranked lexical search of all documents for many items by two trees.

A term's weight times a document's factor, summed over an item's terms, is a product of two vectors without negative
entries. Items and documents are ordered so that alike ones stand together, and stacked into trees; a node holds the
greatest value of every coordinate below it. The product of an item node and a document node is therefore at least the
score of every pair below them. Both trees are descended at once, the most promising documents first; a pair of nodes is
left out if its bound is below the weakest k-th score of the node's items, which no document there can then reach.

Documents are read once and reduced to the terms that items ask for. Every task searches its documents in groups of
bounded size, each with a tree of its own. A pilot walks one path of each first group, whose merged k-th scores are lower
bounds for all tasks from the start. What is left out can never be among the k best, so results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks as B
from .tokens import ranges
from .words import Words, spans

#: Pairs of item and term that go to all tasks at once (about 24 bytes each); more items take more rounds.
BLOCK_PAIRS = 1_000_000
#: Documents, and their entries, under one tree.
GROUP_DOCS, GROUP_ENTRIES = 8192, 4_000_000
LEAF, FAN = 32, 8
_BEST = 63

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class Terms(Words):
    """Terms of a list of texts: maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased."""

    def __init__(self, texts: list[str | None]) -> None:
        encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.data = _LOWER[np.frombuffer(b"\n".join(encoded) + b"\n", dtype=np.uint8)]
        edge = np.flatnonzero(np.diff(_TERM[self.data], prepend=False))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.concatenate([[0], np.searchsorted(self.start, np.cumsum([len(e) + 1 for e in encoded], dtype=np.int64))])
        self.doc = np.repeat(np.arange(len(encoded)), np.diff(self.first))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of every term."""
        return self.hashes(20), self.hashes(21)


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``item_id, a, b``: the hashes of each item's terms."""
    def terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo, hi in spans(frame["text"].tolist()):
                found = Terms(frame["text"].tolist()[lo:hi])
                a, b = found.keys()
                yield pd.DataFrame({"item_id": frame["item_id"].astype("Int64").array[lo:hi][found.doc], "a": a.view(np.int64), "b": b.view(np.int64)})

    own = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return own.mapInPandas(terms, "item_id long, a long, b long").distinct()


@dataclass
class Items:
    """A block of items as rows over their vocabulary; ``a`` is ascending."""

    ids: list[int | None]
    a: np.ndarray
    b: np.ndarray
    first: np.ndarray
    terms: np.ndarray

    @classmethod
    def of(cls, pairs: pd.DataFrame) -> Items:
        a, b = (pairs[c].to_numpy(dtype=np.int64).view(np.uint64) for c in ("a", "b"))
        words = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), dtype=np.uint64)
        if len(np.unique(words[:, 0])) < len(words):
            raise ValueError("two terms share a 64-bit hash")
        ids = pairs["item_id"].astype("Int64")
        codes, values = pd.factorize(ids, sort=True, use_na_sentinel=False)
        term = np.searchsorted(words[:, 0], a)
        order = np.lexsort((term, codes))
        return cls([None if pd.isna(v) else int(v) for v in values], words[:, 0], words[:, 1],
                   np.searchsorted(codes[order], np.arange(len(values) + 1)), term[order])

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of terms in the vocabulary, -1 for others."""
        at = np.minimum(np.searchsorted(self.a, a), len(self.a) - 1)
        return np.where((self.a[at] == a) & (self.b[at] == b), at, -1)


_PACKED = ("docs binary, missing binary, sizes binary, entries binary, terms binary, times binary, "
           "n_docs long, n_terms long, held array<int>, holders array<long>")


def _reduce(docs: DataFrame, items: Items) -> DataFrame:
    """Documents by their counts of the items' terms, packed; each task's last row has its share of the corpus statistics."""
    def reduced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n_docs = n_terms = 0
        held = np.zeros(len(items.a), dtype=np.int64)
        for frame in frames:
            texts, ids = frame["text"].tolist(), frame["doc_id"].astype("Int64")
            for lo, hi in spans(texts):
                found = Terms(texts[lo:hi])
                size = np.diff(found.first)
                n_docs, n_terms = n_docs + int((size > 0).sum()), n_terms + int(size.sum())
                term = items.number(*found.keys())
                cells, times = np.unique(found.doc[term >= 0] * len(items.a) + term[term >= 0], return_counts=True)
                doc, term = cells // len(items.a), cells % len(items.a)
                held += np.bincount(term, minlength=len(held))
                some, entries = np.unique(doc, return_counts=True)
                own = ids.iloc[lo:hi].iloc[some]
                yield packed(own.fillna(0).to_numpy(dtype=np.int64), own.isna().to_numpy(), size[some], entries, term.astype(np.int32), times)
        yield pd.DataFrame({"docs": [None], "missing": [None], "sizes": [None], "entries": [None], "terms": [None], "times": [None], "n_docs": [n_docs], "n_terms": [n_terms],
                            "held": [np.flatnonzero(held).astype(np.int32)], "holders": [held[held > 0]]})

    def packed(*arrays: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({k: [x.tobytes()] for k, x in zip(("docs", "missing", "sizes", "entries", "terms", "times"), arrays, strict=True)} 
                            | {"n_docs": [0], "n_terms": [0], "held": [[]], "holders": [[]]})

    return docs.mapInPandas(reduced, _PACKED)


@dataclass
class Corpus:
    """Numbers that scores depend on: documents, terms, and documents of each term of the vocabulary."""

    n_docs: int
    n_terms: int
    held: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * d + 1))) for d in self.held.tolist()], dtype=np.int64)

    def factors(self, sizes: np.ndarray, times: np.ndarray) -> np.ndarray:
        """A document's factor for a term: ``sizes`` are the terms of the document, ``times`` those that are this term."""
        if len(sizes) and int(sizes.max()) * self.n_docs * 90 >= 1 << 63:
            m = np.array([10 + 90 * int(n) * self.n_docs // self.n_terms for n in sizes], dtype=np.int64)
        else:
            m = 10 + 90 * sizes * self.n_docs // self.n_terms
        return 1_000_000_000 * times // (1000 * times + 8 * m)

    def order(self, first: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """An order of rows in which those with the same of the most telling terms stand together."""
        telling = np.argsort(np.abs(2 * self.held - self.n_docs), kind="stable")[:_BEST]
        bit = np.zeros(len(self.held), dtype=np.uint64)
        bit[telling] = np.uint64(1) << np.arange(_BEST - 1, _BEST - 1 - len(telling), -1, dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(bit[terms])])  # distinct bits: sums of a row do not carry
        return np.argsort(sums[first[1:]] - sums[first[:-1]], kind="stable")


class Tree:
    """Levels of nodes over rows of non-negative entries; a node's row has the greatest value of every term below it."""

    def __init__(self, first: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int, leaf: int) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n, width = len(first) - 1, leaf
        row = np.repeat(np.arange(n), np.diff(first))
        while True:
            nodes = -(-n // width)
            cell = row // width * n_terms + terms
            order = np.argsort(cell, kind="stable")
            at = np.flatnonzero(np.diff(cell[order], prepend=-1))
            values = np.maximum.reduceat(values[order], at) if len(at) else values[:0]
            row, terms = cell[order][at] // n_terms, cell[order][at] % n_terms
            self.levels.append((np.searchsorted(row, np.arange(nodes + 1)), terms, values))
            if nodes <= 1:
                return
            n, width = nodes, FAN

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Nodes one level below."""
        below = len(self.levels[level - 1][0]) - 1
        out = (np.asarray(nodes)[:, None] * FAN + np.arange(FAN)).reshape(-1)
        return out[out < below]


class Search:
    """The best documents of a block of items so far; documents are searched group by group."""

    def __init__(self, items: Items, corpus: Corpus, k: int, floor: np.ndarray) -> None:
        self.items, self.corpus, self.k = items, corpus, k
        weights = corpus.weights()
        order = corpus.order(items.first, items.terms)
        size = np.diff(items.first)[order]
        self.rank = order  # items in the order of the tree
        terms = items.terms[ranges(items.first[order], size)]
        self.tree = Tree(np.concatenate([[0], np.cumsum(size)]), terms, weights[terms], len(items.a), 1)
        self.floor = floor[order]
        self.best: list[list[tuple]] = [[] for _ in order]  # (-score, id is missing, id), ascending
        self.scored = self.pairs = 0
        self._weakest()

    def _weakest(self) -> None:
        """The weakest k-th score below each node of the items."""
        self.weakest = [self.floor]
        for _ in self.tree.levels[1:]:
            self.weakest.append(np.minimum.reduceat(self.weakest[-1], np.arange(0, len(self.weakest[-1]), FAN)))

    def _bounds(self, node: tuple[int, int], level: int, nodes: np.ndarray) -> np.ndarray:
        """Products of a document node with item nodes."""
        first, terms, values = self.docs.levels[node[0]]
        a, b = first[node[1]], first[node[1] + 1]
        self.dense[terms[a:b]] = values[a:b]
        own, own_terms, weights = self.tree.levels[level]
        begin, size = own[nodes], own[nodes + 1] - own[nodes]
        at = ranges(begin, size)
        products = np.concatenate([[0], np.cumsum(self.dense[own_terms[at]] * weights[at])])
        self.dense[terms[a:b]] = 0
        stop = np.cumsum(size)
        return products[stop] - products[stop - size]

    def group(self, ids: np.ndarray, missing: np.ndarray, sizes: np.ndarray, entries: np.ndarray, terms: np.ndarray, times: np.ndarray, pilot: bool = False) -> None:
        """Search a group of documents; a pilot follows, for each item, only the most promising path."""
        first = np.concatenate([[0], np.cumsum(entries)])
        values = self.corpus.factors(np.repeat(sizes, entries), times)
        order = self.corpus.order(first, terms)
        at = ranges(first[order], entries[order])
        self.ids, self.missing = ids[order], missing[order]
        self.first, self.terms, self.values = np.concatenate([[0], np.cumsum(entries[order])]), terms[at].astype(np.int64), values[at]
        self.docs = Tree(self.first, self.terms, self.values, len(self.items.a), LEAF)
        self.dense = np.zeros(len(self.items.a), dtype=np.int64)
        top, items_top = len(self.docs.levels) - 1, len(self.tree.levels) - 1
        if pilot:
            self._pilot(top)
        else:
            self._visit((top, 0), items_top, self._open((top, 0), items_top, np.array([0]))[0])

    def _open(self, node: tuple[int, int], level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item nodes that a document node may still improve, and their bounds."""
        bounds = self._bounds(node, level, nodes)
        stay = (bounds >= self.weakest[level][nodes]) & (bounds > 0)
        return nodes[stay], bounds[stay]

    def _visit(self, node: tuple[int, int], level: int, nodes: np.ndarray) -> None:
        if not len(nodes):
            return
        if node[0] == 0 and level == 0:
            self._score(node[1], nodes)
            return
        below = [(node[0] - 1, int(c)) for c in self.docs.children(node[0], np.array([node[1]]))] if node[0] else [node]
        if level:
            level, nodes = level - 1, self.tree.children(level, nodes)
        opened = [(child, *self._open(child, level, nodes)) for child in below]
        for child, own, bounds in sorted(opened, key=lambda x: -x[2].max(initial=0)):
            self._visit(child, level, own[bounds >= self.weakest[level][own]])
        if node[0] == 1:
            self._weakest()

    def _pilot(self, top: int) -> None:
        at = np.zeros(len(self.rank), dtype=np.int64)
        for level in range(top, 0, -1):
            following, best = at.copy(), np.full(len(at), -1, dtype=np.int64)
            for parent in np.unique(at).tolist():
                own = np.flatnonzero(at == parent)
                for child in self.docs.children(level, np.array([parent])).tolist():
                    bounds = self._bounds((level - 1, child), 0, own)
                    better = bounds > best[own]
                    best[own[better]], following[own[better]] = bounds[better], child
            at = following
        for leaf in np.unique(at).tolist():
            self._score(leaf, np.flatnonzero(at == leaf))

    def _score(self, leaf: int, rows: np.ndarray) -> None:
        """Exact scores of the documents of a leaf for some items."""
        low, high = leaf * LEAF, min((leaf + 1) * LEAF, len(self.ids))
        a, b = self.first[low], self.first[high]
        union, place = np.unique(self.terms[a:b], return_inverse=True)
        table = np.zeros((high - low, len(union) + 1), dtype=np.int64)
        table[np.repeat(np.arange(high - low), np.diff(self.first[low:high + 1])), place] = self.values[a:b]
        self.dense[union] = np.arange(len(union)) - len(union)  # others point at the column of zeros
        own, own_terms, weights = self.tree.levels[0]
        size = own[rows + 1] - own[rows]
        at = ranges(own[rows], size)
        sums = np.concatenate([np.zeros((high - low, 1), dtype=np.int64), np.cumsum(table[:, self.dense[own_terms[at]] - 1] * weights[at], axis=1)], axis=1)
        self.dense[union] = 0
        stop = np.cumsum(size)
        scores = sums[:, stop] - sums[:, stop - size]
        self.scored += scores.size
        good = (scores > 0) & (scores >= self.floor[rows])
        for j in np.flatnonzero(good.any(axis=0)).tolist():
            row, some = rows[j], np.flatnonzero(good[:, j])
            made = [(-int(s), bool(m), int(d)) for s, m, d in zip(scores[some, j], self.missing[low + some], self.ids[low + some], strict=True)]
            kept = self.best[row] = sorted(self.best[row] + made)[:self.k]
            if len(kept) == self.k:
                self.floor[row] = max(self.floor[row], -kept[-1][0])

    def rows(self) -> pd.DataFrame:
        """``item`` by number, ``score, doc_id`` of what was found."""
        out = [(int(self.rank[r]), -s, None if m else d) for r, own in enumerate(self.best) for s, m, d in own]
        frame = pd.DataFrame(out, columns=["item", "score", "doc_id"])
        return frame.astype({"item": "int32", "score": "int64", "doc_id": "Int64"})


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[list[np.ndarray]]:
    """Packed rows as arrays, some thousand documents at a time."""
    kinds = {"docs": np.int64, "missing": bool, "sizes": np.int64, "entries": np.int64, "terms": np.int32, "times": np.int64}
    parts, n, entries = [], 0, 0
    for frame in frames:
        for row in zip(*(frame[c] for c in kinds), strict=True):
            own = [np.frombuffer(x, dtype=t) for x, t in zip(row, kinds.values(), strict=True)]
            if not len(own[0]):
                continue
            parts.append(own)
            n, entries = n + len(own[0]), entries + len(own[4])
            if n >= GROUP_DOCS or entries >= GROUP_ENTRIES:
                yield [np.concatenate(x) for x in zip(*parts, strict=True)]
                parts, n, entries = [], 0, 0
    if parts:
        yield [np.concatenate(x) for x in zip(*parts, strict=True)]


def _found(packed: DataFrame, items: Items, corpus: Corpus, k: int, floor: np.ndarray, pilot: bool) -> DataFrame:
    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Search(items, corpus, k, floor.copy())
        for group in _groups(frames):
            own.group(*group, pilot=pilot)
            if pilot:
                break
        yield own.rows()

    rows = packed.filter(F.col("docs").isNotNull()).select("docs", "missing", "sizes", "entries", "terms", "times")
    return rows.mapInPandas(search, "item int, score long, doc_id long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of each item, scores above 0 only.

    ``items`` has ``item_id, text``; rows of one id, or without one, are one item with the terms of all. Rows of ``docs``
    count each, whatever their ids; a null or empty text has no terms. Equal scores are ranked by ascending ``doc_id``,
    rows without an id last. Other columns are not read. Items without terms, and empty tables, give no rows.

    The documents are read once for every ``block_pairs`` pairs of item and term; an item is never split.
    """
    asked = B.checkpointed(_item_terms(items))
    rounds = max(1, -(-asked.count() // block_pairs))
    own_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for r in range(rounds):
        block = Items.of(asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r).toPandas())
        if not block.ids:
            continue
        packed = B.checkpointed(_reduce(own_docs, block))
        total = packed.agg(F.sum("n_docs").alias("d"), F.sum("n_terms").alias("t")).first()
        if not total["t"]:
            continue
        held = np.zeros(len(block.a), dtype=np.int64)
        for row in packed.select(F.explode(F.arrays_zip("held", "holders")).alias("h")).groupBy(F.col("h.held").alias("term")).agg(F.sum("h.holders").alias("n")).collect():
            held[row["term"]] = row["n"]
        corpus = Corpus(total["d"], total["t"], held)
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        none = np.zeros(len(block.ids), dtype=np.int64)
        floor = none.copy()
        seen = _found(packed, block, corpus, k, none, True).withColumn("rank", F.row_number().over(best))
        for row in seen.filter(F.col("rank") == k).collect():
            floor[row["item"]] = row["score"]
        ranked = _found(packed, block, corpus, k, floor, False).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        ids = block.ids

        def named(frames: Iterator[pd.DataFrame], ids=ids) -> Iterator[pd.DataFrame]:
            for frame in frames:
                frame.insert(0, "item_id", pd.array([ids[i] for i in frame["item"]], dtype="Int64"))
                frame["doc_id"] = frame["doc_id"].astype("Int64")
                yield frame[["item_id", "rank", "doc_id", "score"]]

        out = out.union(ranked.mapInPandas(named, "item_id long, rank int, doc_id long, score long"))
    return out
