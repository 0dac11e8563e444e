"""Ranked search against scoring every pair."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from stationloom.llm import ranked as R
from stationloom.llm.ranked import Corpus, Items, Search, rank_documents


def corpus_rows(n: int, seed: int = 1):
    """Documents of three vocabularies, with repeated rows, ties, null and odd texts, and items that are parts of some."""
    rng = random.Random(seed)
    words = [["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(250)] for letters in ("abcdefg", "hijklmN", "éßøa日")]

    def prose(k, n):
        return " ".join(words[k][min(int(rng.expovariate(0.02)), 249)] for _ in range(n))

    docs = [(i, prose(i % 3, rng.randint(1, 120))) for i in range(n)]
    items = [(i, " ".join(docs[i * 7 % n][1].split(" ")[:rng.randint(1, 25)]).upper() + " unseen!") for i in range(0, n // 4)]
    docs += [(i, docs[11][1]) for i in range(2000, 2030)] + [(11, docs[11][1]), (None, docs[11][1]), (None, docs[11][1]), (2100, None), (2101, ""), (2102, " -- \n"),
             (2103, "a\x00b_c-d`e{f"), (2104, prose(0, 20_000)), (2104, "Same " * 500), (2105, "x" * 50_000)]
    items += [(900, None), (901, ""), (902, "-!"), (None, prose(1, 9)), (None, prose(2, 9)), (5, prose(0, 3)), (903, "nowhere"), (904, "x" * 50_000 + " a")]
    return docs, items


@pytest.mark.parametrize("block_pairs", [1_000_000, 40])
def test_ranks(spark, block_pairs):
    docs, items = corpus_rows(240)
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit("clash")).withColumn("score", F.lit(1)).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    if block_pairs < 100:
        items = items[:12] + items[-8:]
        asked = spark.createDataFrame(items, "item_id long, text string")
    found = rank_documents(table, asked, block_pairs=block_pairs)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "bigint"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute.ranked(docs, items), key=repr)


def test_empty_tables(spark):
    docs, items = corpus_rows(20)
    table, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rank_documents(table.limit(0), asked).count() == rank_documents(table, asked.limit(0)).count() == 0
    assert rank_documents(table.filter("doc_id IN (2100, 2101, 2102)"), asked).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_tree_prunes_and_is_exact(seed):
    """One group searched by trees against all products, and far fewer pairs than all are scored."""
    rng = np.random.default_rng(seed)
    n_terms, n_docs, n_items = 300, 3000, 60
    rows = [np.unique(rng.choice(100, size=rng.integers(5, 40)) + 100 * (i % 3)) for i in range(n_docs)]
    asked = [rows[i * 13 % n_docs][:12] for i in range(n_items)]
    entries, terms = np.array([len(r) for r in rows]), np.concatenate(rows).astype(np.int32)
    times, sizes = rng.integers(1, 5, size=len(terms)), entries * 3
    held = np.bincount(terms, minlength=n_terms)
    corpus = Corpus(n_docs, int(sizes.sum()), held)
    items = Items(list(range(n_items)), np.arange(n_terms, dtype=np.uint64), np.zeros(n_terms, dtype=np.uint64),
                  np.concatenate([[0], np.cumsum([len(a) for a in asked])]), np.concatenate(asked))
    search = Search(items, corpus, 10, np.zeros(n_items, dtype=np.int64))
    search.group(np.arange(n_docs), np.zeros(n_docs, dtype=bool), sizes, entries, terms, times)
    dense = np.zeros((n_docs, n_terms), dtype=np.int64)
    dense[np.repeat(np.arange(n_docs), entries), terms] = corpus.factors(np.repeat(sizes, entries), times)
    weights, expected = corpus.weights(), []
    for i, own in enumerate(asked):
        scores = dense[:, own] @ weights[own]
        expected += [(i, int(scores[d]), int(d)) for d in np.lexsort((np.arange(n_docs), -scores))[:10] if scores[d] > 0]
    assert sorted(map(tuple, search.rows().to_numpy().tolist())) == sorted(expected)
    assert search.scored < 0.5 * n_docs * n_items


def test_large_numbers():
    corpus = Corpus(10 ** 11, 10 ** 14, np.array([5]))
    assert corpus.factors(np.array([10 ** 9]), np.array([7])).tolist() == [7 * 10 ** 9 // (7000 + 8 * (10 + 90 * 10 ** 9 * 10 ** 11 // 10 ** 14))]


def test_groups_are_bounded(spark, monkeypatch):
    docs, items = corpus_rows(60)
    monkeypatch.setattr(R, "GROUP_DOCS", 7)
    counts = Items.of(R._item_terms(spark.createDataFrame(items, "item_id long, text string")).toPandas())
    packed = R._reduce(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), counts).filter("docs IS NOT NULL").toPandas()
    sizes = [len(g[0]) for g in R._groups([packed])]
    assert len(sizes) > 1 and sum(sizes) == sum(len(x) // 8 for x in packed["docs"])
