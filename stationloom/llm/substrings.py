"""Removal of word windows that repeat across documents, behind a count-min prefilter.

First pass: each block of documents makes a sparse count-min sketch of its windows;
shards of the sketch merge the parts of all blocks and tell each block which of its
cells reach two. Sums never underestimate, so a repeated window is always reported.
Second pass: only windows whose cells all reach two are grouped exactly, by 128-bit
hashes, for the smallest document id. Cells grow with the number of windows, so the
share of windows reported without need stays the same at every size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .words import Words, mix, spans

_LAST = np.iinfo(np.int64).max


def _ids(frame: pd.DataFrame) -> np.ndarray:
    """Document ids; a missing id counts as larger than all others."""
    return np.array([_LAST if pd.isna(x) else int(x) for x in frame["doc_id"]], dtype=np.int64)


def _windows(frame: pd.DataFrame, width: int, seeds: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """All windows of a block: first word in the block's words, document id, and a hash for each seed."""
    ids, texts = _ids(frame), frame["text"].tolist()
    at, docs, hashes, base = [], [], [[] for _ in seeds], 0
    for a, b in spans(texts):
        words = Words(texts[a:b])
        for own, seed in zip(hashes, seeds, strict=True):
            here, found = words.windows(width, words.hashes(seed), seed)
            own.append(found)
        at.append(base + here)
        docs.append(ids[a + words.doc[here]])
        base += len(words.start)

    def joined(parts: list, kind: type) -> np.ndarray:
        return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)

    return joined(at, np.int64), joined(docs, np.int64), [joined(h, np.uint64) for h in hashes]


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each window in one row of the sketch."""
    return mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (row + 1) % (1 << 64))) >> np.uint64(64 - bits)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal entries begin."""
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def _counted(cells: np.ndarray, bits: int, docs: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct cells, and whether two of the documents, numbered from 0, count into one."""
    low = np.uint64(max(1, n_docs - 1).bit_length())
    if bits + int(low) > 64:
        order = np.lexsort((docs, cells))
        cells, docs = cells[order], docs[order]
    else:  # sorting plain numbers is much faster than finding their order
        both = np.sort((cells << low) | docs.astype(np.uint64))
        cells, docs = both >> low, both & ((np.uint64(1) << low) - np.uint64(1))
    first = _runs(cells)
    last = np.append(first, len(cells))[1:] - 1
    return cells[first], docs[first] != docs[last]


def _candidates(frame: pd.DataFrame, bits_rows: pd.DataFrame, width: int, depth: int, bits: int):
    """Candidate windows of a block: row, first word in the block's words, two hashes, the id; ascending by hash."""
    back = bits_rows[~bits_rows["exact"]].sort_values("shard")
    at, doc, (h, g) = _windows(frame, width, (0, 1))
    left = np.arange(len(h))
    for row in range(depth):
        # a window left out by one row of the sketch need not be looked for in the next, but counts among its cells
        cells = np.sort(_cells(h, row, bits))
        cells = cells[_runs(cells)]
        hits = [B.flags_of(p[row], n[row]) for p, n in zip(back["bits"], back["n"], strict=True)]
        hot = cells[np.concatenate(hits)] if hits else cells[:0]
        c = _cells(h[left], row, bits)
        where = np.searchsorted(hot, c)
        left = left[hot[np.minimum(where, len(hot) - 1)] == c] if len(hot) else left[:0]
    h, g, doc, at = h[left], g[left], doc[left], at[left]
    order = np.lexsort((doc, g, h))
    h, g, doc, at = h[order], g[order], doc[order], at[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    return h, g, doc, at, new


def _sketch(n_shards: int, width: int, depth: int, bits: int):
    def part(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        parts = [[] for _ in range(n_shards)]
        _, docs, (h,) = _windows(frame, width, (0,))
        names, docs = np.unique(docs, return_inverse=True)
        for row in range(depth):
            cells, twice = _counted(_cells(h, row, bits), bits, docs, len(names))
            cut = B.cuts(cells, n_shards, bits)
            packed = cells * np.uint64(2) + twice
            for own, a, b in zip(parts, cut, cut[1:], strict=False):
                own.append(B.pack_sorted(packed[a:b]))
        return pd.DataFrame([(key[0], k, own) for k, own in enumerate(parts) if any(own)], columns=["block", "shard", "cells"])
    return part


def _merge(n_shards: int, depth: int, bits: int):
    """Adds the parts of one shard of the sketch; a sum of two is all that matters."""
    def merged(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        low, high = (shard << bits) // n_shards, ((shard + 1) << bits) // n_shards
        answers = [[] for _ in range(len(frame))]
        for row in range(depth):
            sums = np.zeros(high - low, dtype=np.uint8)
            for packed in frame["cells"]:
                got = B.unpack_sorted(packed[row])
                cell = (got >> np.uint64(1)).astype(np.int64) - low
                sums[cell] = np.minimum(sums[cell] + 1 + (got & np.uint64(1)).astype(np.uint8), 2)
            for own, packed in zip(answers, frame["cells"], strict=True):
                own.append(sums[(B.unpack_sorted(packed[row]) >> np.uint64(1)).astype(np.int64) - low] >= 2)
        return pd.DataFrame({"block": frame["block"], "exact": False, "shard": shard, "n": [[len(x) for x in own] for own in answers],
                             "bits": [[B.bits_of(x) for x in own] for own in answers]})
    return merged


def _exact(n_shards: int, width: int, depth: int, bits: int):
    def part(key: tuple, frame: pd.DataFrame, bits_rows: pd.DataFrame) -> pd.DataFrame:
        if not len(frame) or not len(bits_rows):
            return pd.DataFrame({"block": [], "shard": [], "hashes": [], "docs": []})
        h, g, doc, _, new = _candidates(frame, bits_rows, width, depth, bits)
        h, g, doc = h[new], g[new], doc[new]
        cut = B.cuts(h, n_shards, 64)
        rows = []
        for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
            if b > a:
                ids = doc[a:b].astype(np.uint32) if 0 <= doc[a:b].min() and doc[a:b].max() < 1 << 32 else doc[a:b]
                rows.append((key[0], k, np.concatenate([h[a:b], g[a:b]]).tobytes(), ids.tobytes()))
        return pd.DataFrame(rows, columns=["block", "shard", "hashes", "docs"])
    return part


def _smallest(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Whether another block holds the window in a document with a smaller id."""
    hs, docs = [], []
    for packed, ids in zip(frame["hashes"], frame["docs"], strict=True):
        pair = np.frombuffer(packed, dtype=np.uint64).reshape(2, -1)
        n = pair.shape[1]
        hs.append(pair)
        docs.append(np.frombuffer(ids, dtype=np.uint32 if len(ids) == 4 * n else np.int64).astype(np.int64))
    sizes = [len(d) for d in docs]
    (h, g), doc = np.concatenate(hs, axis=1), np.concatenate(docs)
    order = np.lexsort((doc, g, h))
    h, g, ordered = h[order], g[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    least = np.empty(len(h), dtype=np.int64)
    least[order] = ordered[np.flatnonzero(new)][np.cumsum(new) - 1]
    smaller = np.split(least < doc, np.cumsum(sizes)[:-1])
    return pd.DataFrame({"block": frame["block"], "exact": True, "shard": int(key[0]), "n": [[n] for n in sizes],
                         "bits": [[B.bits_of(x)] for x in smaller]})


def _finish(width: int, depth: int, bits: int):
    def kept(key: tuple, frame: pd.DataFrame, bits_rows: pd.DataFrame) -> pd.DataFrame:
        texts = frame["text"].tolist()
        if not len(frame):
            return pd.DataFrame({"doc_id": [], "n_words": [], "n_removed": [], "kept": []})
        h, g, doc, at, new = _candidates(frame, bits_rows, width, depth, bits)
        back = bits_rows[bits_rows["exact"]].sort_values("shard")
        flags = [B.flags_of(p[0], n[0]) for p, n in zip(back["bits"], back["n"], strict=True)]
        smaller = np.concatenate(flags) if flags else np.zeros(0, dtype=bool)
        group = np.cumsum(new) - 1
        least = doc[np.flatnonzero(new)][group] if len(doc) else doc
        repeated = np.sort(at[smaller[group] | (doc > least)]) if len(doc) else at
        out, base = [], 0
        for a, b in spans(texts):
            words = Words(texts[a:b])
            n = len(words.start)
            here = repeated[np.searchsorted(repeated, base):np.searchsorted(repeated, base + n)].astype(np.int64) - base
            step = np.zeros(n + 1, dtype=np.int64)
            np.add.at(step, here, 1)
            np.add.at(step, np.minimum(here + width, n), -1)
            gone = np.cumsum(step[:n]) > 0
            for i in range(b - a):
                f, t = words.first[i], words.first[i + 1]
                lost = int(gone[f:t].sum())
                pieces = (words.raw[s:e] for s, e in zip(words.start[f:t][~gone[f:t]], words.end[f:t][~gone[f:t]], strict=True)) if lost else (texts[a + i] or "").encode("utf-8", "surrogatepass").split()
                out.append((int(t - f), lost, b" ".join(pieces).decode("utf-8", "surrogatepass")))
            base += n
        done = pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])
        done.insert(0, "doc_id", frame["doc_id"].astype("Int64").array)
        return done
    return kept


def remove_repeated_windows(docs: DataFrame, width: int = 50, depth: int = 2, load: int = 16, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """Drop the words of every window of ``width`` words that also starts in a document with a smaller id.

    ``depth`` rows of the sketch have at least ``load`` cells for each window there can be. Returns
    ``doc_id, n_words, n_removed, kept``, one row for each row of ``docs``; other columns of ``docs`` are not read.
    A null text has no words. Rows with equal ids are one document: neither removes the other. Rows without an id
    count as larger than all others. Texts below ``width`` words stay. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    n_bytes = B.text_bytes(docs, "text")
    n_blocks, n_shards = B.block_counts(spark, n_bytes, block_bytes)
    # a word and its space take two bytes at least; five is common, and a fuller sketch only reports more windows
    bits = max(10, int(max(1, n_bytes // 5) * load - 1).bit_length())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("block", B.block_of(F.col("doc_id"), F.col("text"), n_blocks))
    parts = rows.groupBy("block").applyInPandas(
        _sketch(n_shards, width, depth, bits), "block int, shard int, cells array<binary>")
    flags = "block int, exact boolean, shard int, n array<int>, bits array<binary>"
    hot = parts.groupBy("shard").applyInPandas(_merge(n_shards, depth, bits), flags)
    exact = rows.groupBy("block").cogroup(hot.groupBy("block")).applyInPandas(
        _exact(n_shards, width, depth, bits), "block int, shard int, hashes binary, docs binary")
    smaller = exact.groupBy("shard").applyInPandas(_smallest, flags)
    return rows.groupBy("block").cogroup(hot.unionByName(smaller).groupBy("block")).applyInPandas(
        _finish(width, depth, bits), "doc_id long, n_words long, n_removed long, kept string")
