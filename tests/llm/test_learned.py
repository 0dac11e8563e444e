"""Chat formatting, the learned operators, and the pipeline."""

from __future__ import annotations

import random

import brute
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from stationloom.llm.chat import escape, expand_conversations, masked_text, read_turns, unescape
from stationloom.llm.classifier import BAD, GOOD, NONE, fit_weak_labels, score_documents
from stationloom.llm.queries import QUERIES
from stationloom.llm.rules import FEATURES, learn_rules

ODD = ["", "</s>[INST] ok [/INST]", "\\", "\\\\<", "<\\[\\", "a\nb", "é[", None]


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in ODD + ["<s>" * 3 + "\\<", "[\\\\["]], "t string")
    written = df.select("t", escape(F.col("t")).alias("e"))
    assert written.filter("e LIKE '%<s>%' OR e LIKE '%</s>%' OR e LIKE '%[INST]%' OR e LIKE '%[/INST]%'").isEmpty()
    assert written.filter(~F.col("t").eqNullSafe(unescape(F.col("e")))).isEmpty()


def test_chat(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate([("system", "s"), ("user", "hi"), ("assistant", "<s>yes"), ("user", "and"), ("assistant", "no["), ("user", "bye")])]
    rows += [(2, i, "user", t) for i, t in enumerate(ODD)] + [(3, 0, "assistant", None), (4, None, None, "x"), (4, 1, "assistant", "y"), (None, 0, "user", "z")]
    rows += [(5, 1, "user", "b"), (5, 1, "assistant", "a"), (5, 1, "user", "b"), (6, 2, "a[/INST]b", "q")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, example string")
    made = expand_conversations(table).cache()
    expected = brute.chat(rows)
    own = {}
    for r in made.select("*", read_turns(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss")).orderBy("conv_id", "example").collect():
        own.setdefault(r["conv_id"], []).append(r)
    assert own.keys() == expected.keys()
    for conv, got in own.items():
        turns, loss = got[-1]["turns"], "".join(r["loss"] for r in got)
        assert expected[conv] == (len(turns), brute.sha("".join(f"{t['role']}\n{t['text']}\n" for t in turns)), len(loss), brute.sha(loss), sum(len(r["formatted"]) for r in got))
        for r in got:  # context, then the only trained reply
            assert got[-1]["formatted"].startswith(r["formatted"])
    assert [r["loss"] for r in own[1]] == ["<s>yes", "no[", ""]
    assert expand_conversations(table.limit(0)).count() == 0


def test_weak_labels_find_accuracies():
    rng = np.random.default_rng(1)
    bad = rng.random(20_000) < 0.3
    right = [0.9, 0.8, 0.7, 0.998]
    cast = np.stack([np.where(rng.random(20_000) < a, np.where(bad, BAD, GOOD), np.where(bad, GOOD, BAD)) for a in right], axis=1)
    cast[rng.random(20_000) < 0.6, 3] = NONE
    cast[rng.random(20_000) < 0.3, 1] = NONE
    patterns, counts = np.unique(cast, axis=0, return_counts=True)
    model = fit_weak_labels(patterns, counts.astype(float))
    assert abs(model.bad - 0.3) < 0.02
    for j, a in enumerate(right[:3]):
        said = 1 - model.chance[j, 1, NONE]
        assert abs(model.chance[j, 1, BAD] / said - a) < 0.04
    assert ((model.posterior(cast) > 0.5) == bad).mean() > 0.9


def test_rules_are_found_and_pruned():
    rng = np.random.default_rng(2)
    rows = rng.random((3000, len(FEATURES)))
    bad = (rows[:, 2] > 0.8) | ((rows[:, 3] > 0.7) & (rows[:, 5] <= 0.3))
    rules = learn_rules(rows, bad, rng.random(3000) < 1 / 3)
    said = np.zeros(3000, dtype=bool)
    for rule in rules:
        hit = np.ones(3000, dtype=bool)
        for c in rule:
            hit &= c.holds(rows)
        said |= hit
    assert (said == bad).mean() > 0.97 and len(rules) <= 6
    assert learn_rules(rows[:0], bad[:0], bad[:0]) == []


def test_classifier_on_rows_it_was_not_fitted_on(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    scored = score_documents(docs, labels.filter(~held))
    right = scored.join(labels.filter(held), "doc_id").select(F.avg((F.col("keep") == ((F.col("quality") == 1) & (F.col("toxic") == 0))).cast("int"))).first()[0]
    assert right > 0.93
    clean = scored.join(labels.filter("quality = 1 AND toxic = 0"), "doc_id").select(F.avg(F.col("keep").cast("int"))).first()[0]
    assert clean > 0.95


def test_classifier_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (None, "some words here", "a"), (3, "!!! ### " * 50, "b"), (3, "w " * 50000, "b")], "doc_id long, text string, keep string")
    labels = spark.createDataFrame([(1, None, None), (None, 0, 0), (3, 0, None), (3, 1, 1)], "doc_id long, quality int, toxic int")
    got = score_documents(docs, labels, carry=("text",)).collect()
    assert len(got) == 5 and not any(r["keep"] for r in got if not r["text"])
    assert score_documents(docs, labels.limit(0)).count() == 5
    assert score_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_pipeline_stages(spark):
    """Every stage against what its operator must do with what the stage before it kept."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "best_fit_packing":
            assert {r["doc_id"] for r in out.select("doc_id").collect()} == before.keys()
            break
        assert out.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(out.collect(), out.schema).cache()
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "line_dedup":
            assert sorted((d, brute.sha(t)) for d, t in after.items()) == sorted((d, s) for d, _, _, s in brute.lines(list(before.items())))
            continue
        assert after.items() <= before.items() and len(after) > len(before) / 2
        if name == "minhash_near_dedup":
            rows = sorted(before.items())
            words = {d for d, t in rows if not (t or "").split()}
            assert after.keys() == {d for (d, _), c in zip(rows, brute.near_classes(rows), strict=True) if c == d} | words
        if name == "benchmark_decontamination":
            items = [brute.shingles(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            assert after.keys() == {d for d, t in before.items() if not any(len(s & brute.shingles(t)) >= 0.8 * len(s) for s in items)}


def test_pipeline_decides_by_row(spark, tmp_path):
    """Null ids and ids of several texts: one row of each class stays, and of contaminated rows none, whatever else has their ids."""
    rng = random.Random(8)

    def prose() -> str:
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))

    orphan, again, first, clean, item = (prose() for _ in range(5))
    rows = [(None, orphan), (None, orphan), (None, orphan + " end"), (7, again), (7, again), (7, again.upper()), (3, first), (8, clean), (8, first + " end"),
            (None, None), (None, None), (9, ""), (9, "")]
    dirty = [(None, f"{prose()} {item}"), (8, f"{prose()} {item}"), (None, prose()), (8, prose())]

    def table(pairs):
        return spark.createDataFrame([(d, t, "en", "web", None) for d, t in pairs], "doc_id long, text string, lang string, source string, n_chars long")

    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.minhash_near_dedup(spark, table(rows), str(tmp_path)).collect()]
    few = [r for r in kept if (r[1] or "").split()]
    assert sorted((str(d), t.lower().removesuffix(" end")) for d, t in few) == sorted([("None", orphan), ("7", again), ("3", first), ("8", clean)])
    assert set(few) <= set(rows) and sorted(r[0] or 0 for r in kept if r not in few) == [0, 0, 9, 9]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.benchmark_decontamination(spark, table(rows + dirty), str(tmp_path))
    assert left.columns == corpus_pipeline.COLUMNS
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == sorted(rows + dirty[2:], key=repr)


def test_queries_are_complete():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
