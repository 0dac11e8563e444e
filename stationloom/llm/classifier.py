"""Quality classifier: a weak-label model over heuristic labellers trains a hashed linear scorer.

Labellers vote bad, good or nothing on every document; one of them is the annotator,
who voted on the rows of the label table only. Expectation-maximisation over the counts
of all vote patterns, of which there are at most ``3 ** labellers``, estimates how each
labeller votes on bad and on good documents. The posterior labels of a bounded sample
of labelled rows train a logistic scorer on hashed words, word beginnings and ranges
of the same figures that the labellers use; it scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, _powers, _seeded, mix, spans

#: Labelled rows that the scorer is trained on at most.
MAX_LABELLED = 6_000
BITS = 20
#: Share of its votes in which the annotator is right.
ANNOTATOR = 0.998
#: Bytes of a word's beginning that are features besides the whole word.
BEGINNINGS = (4, 5, 6, 8, 10)

# Insults that the lexicon labeller knows.
INSULTS = ["clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
SYMBOLS = b"#*$%&|<>"

NONE, GOOD, BAD = 0, 1, 2
LABELLERS = ["symbols", "capitals", "variety", "exclamations", "lexicon", "lines", "annotator"]


def figures(words: Words) -> dict[str, np.ndarray]:
    """Of each text: words, and shares of symbols, capitals, distinct words, exclamation marks, repeated lines; insults."""
    n = len(words.first) - 1
    count = np.diff(words.first)
    byte_class = np.zeros(256, dtype=np.uint8)
    byte_class[list(SYMBOLS)] = 1
    byte_class[ord("A"):ord("Z") + 1] = 2
    byte_class[ord("a"):ord("z") + 1] = 3
    byte_class[ord("!")] = 4
    kinds = byte_class[words.data]
    lo = np.where(count > 0, words.start[np.minimum(words.first[:-1], max(0, len(words.start) - 1))] if len(words.start) else 0, 0)
    hi = np.where(count > 0, words.end[np.maximum(words.first[1:] - 1, 0)] if len(words.end) else 0, 0)

    def per_text(kind: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kinds == kind)])
        return sums[hi] - sums[lo]

    symbols, upper, lower, marks = (per_text(k) for k in (1, 2, 3, 4))
    bare = np.maximum(hi - lo, 1)
    hashes = words.hashes()
    order = np.lexsort((hashes, words.doc))
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (words.doc[order][1:] != words.doc[order][:-1])
    distinct = np.bincount(words.doc[order][fresh], minlength=n)
    return {"n_words": count, "symbols": symbols / bare, "capitals": upper / np.maximum(upper + lower, 1),
            "variety": distinct / np.maximum(count, 1), "exclamations": marks / np.maximum(count, 1)}


def _insults(texts: list[str]) -> np.ndarray:
    return np.array([sum(w in t for w in INSULTS) for t in texts])


def _repeated_lines(texts: list[str]) -> np.ndarray:
    out = []
    for t in texts:
        lines = [x for x in t.split("\n") if x and not x.isspace()]
        out.append(1 - len(set(lines)) / len(lines) if lines else 0.0)
    return np.array(out)


def votes(texts: list[str], annotated: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], Words]:
    """Votes of all labellers on each text, its figures, and the words of the lower-cased texts."""
    f = figures(Words(texts))
    lowered = [t.lower() for t in texts]
    f["insults"], f["lines"] = _insults(lowered), _repeated_lines(texts)
    long = f["n_words"] >= 20

    def vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(bad, BAD, np.where(good, GOOD, NONE))

    never = np.zeros(len(texts), dtype=bool)
    cast = [vote(f["symbols"] > 0.03, f["symbols"] < 0.005), vote(f["capitals"] > 0.4, f["capitals"] < 0.15),
            vote(long & (f["variety"] < 0.3), long & (f["variety"] > 0.4)), vote(f["exclamations"] > 0.2, f["exclamations"] < 0.02),
            vote(f["insults"] > 0, never), vote(f["lines"] > 0.3, never), annotated]
    return np.stack(cast, axis=1), f, Words(lowered)


@dataclass(frozen=True)
class WeakLabels:
    """Share of bad documents, and the chance of each vote of each labeller on good and on bad documents."""

    bad: float
    chance: np.ndarray  # labeller, class (good, bad), vote

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is bad."""
        logs = [np.log(1 - self.bad) + np.zeros(len(cast)), np.log(self.bad) + np.zeros(len(cast))]
        for j in range(cast.shape[1]):
            for c in (0, 1):
                logs[c] = logs[c] + np.log(self.chance[j, c, cast[:, j]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit_weak_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> WeakLabels:
    """Expectation-maximisation on vote patterns and how many documents have each.

    The last labeller is the annotator, whose accuracy is given; it ties the classes to their meaning. The others start
    from the majority of votes and are estimated. No vote is less likely than one in a thousand.
    """
    n_labellers = patterns.shape[1]
    chance = np.full((n_labellers, 2, 3), 1 / 3)
    if not len(patterns):
        return WeakLabels(0.5, chance)
    bad_votes, good_votes = (patterns == BAD).sum(axis=1), (patterns == GOOD).sum(axis=1)
    # a single vote for bad weighs more than one for good: most labellers look for one fault only
    belief = (3 * bad_votes + 0.5) / (3 * bad_votes + good_votes + 1)
    told = patterns[:, -1]
    belief = np.where(told == BAD, ANNOTATOR, np.where(told == GOOD, 1 - ANNOTATOR, belief))
    model = WeakLabels(0.5, chance)
    for _ in range(rounds):
        share = float(np.clip((belief * counts).sum() / counts.sum(), 1e-3, 1 - 1e-3))
        chance = np.empty((n_labellers, 2, 3))
        for c, weight in ((0, (1 - belief) * counts), (1, belief * counts)):
            for j in range(n_labellers):
                seen = np.bincount(patterns[:, j], weights=weight, minlength=3)
                chance[j, c] = (seen + 1e-3 * (weight.sum() + 1)) / (seen.sum() + 3e-3 * (weight.sum() + 1))
        for c, right in ((0, GOOD), (1, BAD)):
            spoken = 1 - chance[-1, c, NONE]
            chance[-1, c, [GOOD, BAD]] = spoken * (1 - ANNOTATOR)
            chance[-1, c, right] = spoken * ANNOTATOR
        model = WeakLabels(share, chance)
        belief = model.posterior(patterns)
    return model


def features(words: Words, f: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Text and hashed feature of all distinct features of each text."""
    n = len(words.first) - 1
    table, base, inverse = _seeded(7)
    size = len(words.data)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(table[words.data] * _powers(base, size), out=sums[1:])
    back = _powers(inverse, size)
    length = words.end - words.start
    docs, hashed = [words.doc], [mix((sums[words.end] - sums[words.start]) * back[words.start])]
    for k in BEGINNINGS:
        long = np.flatnonzero(length > k)
        start = words.start[long]
        docs.append(words.doc[long])
        hashed.append(mix((sums[start + k] - sums[start]) * back[start] + np.uint64(k)))
    for i, name in enumerate(("symbols", "capitals", "variety", "exclamations", "lines")):
        level = np.minimum((f[name] * 40).astype(np.int64), 40) if name != "symbols" else np.minimum((f[name] * 200).astype(np.int64), 40)
        docs.append(np.arange(n))
        hashed.append(mix((np.uint64(1000 * (i + 1)) + level.astype(np.uint64))))
    docs.append(np.arange(n))
    hashed.append(mix(np.uint64(9000) + np.log2(f["n_words"] + 1).astype(np.uint64)))
    doc, feature = np.concatenate(docs), np.concatenate(hashed) >> np.uint64(64 - BITS)
    both = np.unique(doc.astype(np.int64) << BITS | feature.astype(np.int64))
    return both >> BITS, both & ((1 << BITS) - 1)


def train(doc: np.ndarray, feature: np.ndarray, target: np.ndarray, least: float = 4.0, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic weights of the features whose frequency differs between the classes, by accelerated gradient steps."""
    good, bad = max((1 - target).sum(), 1e-9), max(target.sum(), 1e-9)
    in_bad = np.bincount(feature, weights=target[doc], minlength=1 << BITS)
    seen = np.bincount(feature, minlength=1 << BITS)
    share = seen / max(len(target), 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / good + 1 / bad))
    keep = (np.abs(in_bad / bad - (seen - in_bad) / good) > least * spread) & (seen >= 5)
    chosen = np.flatnonzero(keep)
    column = np.full(1 << BITS, -1, dtype=np.int64)
    column[chosen] = np.arange(len(chosen))
    doc, col = doc[keep[feature]], column[feature[keep[feature]]]
    n, m = len(target), len(chosen)
    base = np.log(bad / good)
    weights, before, bias = np.zeros(m), np.zeros(m), base
    # steps in proportion to how rare a feature is keep common ones from swinging
    step = 4.0 / (np.bincount(col, minlength=m) + 10.0) ** 0.5 / max(1.0, np.sqrt(np.bincount(doc, minlength=n).mean() if n else 1.0))
    for k in range(rounds):
        ahead = weights + (weights - before) * (k / (k + 3))
        score = bias + np.bincount(doc, weights=ahead[col], minlength=n)
        error = target - 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        before = weights
        slope = np.bincount(col, weights=error[doc], minlength=m) - 0.5 * ahead
        weights = ahead + step * slope / np.sqrt(np.bincount(col, minlength=m) + 10.0)
        bias += 0.5 * error.mean()
    return chosen, weights, float(bias)


def _annotated(quality: pd.Series, toxic: pd.Series) -> np.ndarray:
    known = quality.notna() | toxic.notna()
    bad = (quality.fillna(1) == 0) | (toxic.fillna(0) == 1)
    return np.where(known, np.where(bad, BAD, GOOD), NONE).astype(np.int64)


def score_documents(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score, keep`` of every document; ``score`` is the probability that it is bad, and those below 0.5 are kept.

    ``labels`` has ``doc_id, quality`` (0 is bad), ``toxic`` (1 is bad); of several rows of a document the worst counts.
    Training takes ``max_labelled`` labelled rows at most, the first by a hash of the id. Texts that are null or have no
    words score 1. Without labels the heuristic labellers alone decide. Repeated ids are scored row by row. The columns
    named in ``carry`` come along; they must not name results. Other columns are not read.
    """
    clash = {"doc_id", "score", "keep"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results and cannot be carried")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))

    def cast(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for a, b in spans(texts):
                got, _, _ = votes(texts[a:b], np.zeros(b - a, dtype=np.int64))
                yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64").array[a:b], "votes": ["".join(map(str, v[:-1])) for v in got.tolist()]})

    annotator = (F.when(F.col("quality").isNull() & F.col("toxic").isNull(), str(NONE))
                 .when((F.col("quality") == 0) | (F.col("toxic") == 1), str(BAD)).otherwise(str(GOOD)))
    patterns = (own.mapInPandas(cast, "doc_id long, votes string").join(marks, "doc_id", "left")
                .groupBy(F.concat("votes", annotator).alias("votes")).agg(F.count("*").alias("n")).orderBy("votes").collect())
    weak = fit_weak_labels(np.array([[int(c) for c in r["votes"]] for r in patterns], dtype=np.int64).reshape(-1, len(LABELLERS)),
                           np.array([r["n"] for r in patterns], dtype=np.float64))

    sample = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    labelled = own.join(F.broadcast(sample), "doc_id").repartition(1)

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs_of, hashed, target, n = [], [], [], 0
        for frame in frames:
            texts, annotated = [t or "" for t in frame["text"]], _annotated(frame["quality"], frame["toxic"])
            for a, b in spans(texts):
                got, f, words = votes(texts[a:b], annotated[a:b])
                doc, feature = features(words, f)
                docs_of.append((doc + n).astype(np.int32))
                hashed.append(feature.astype(np.int32))
                target.append(weak.posterior(got))
                n += b - a
        if n:
            chosen, weights, bias = train(np.concatenate(docs_of), np.concatenate(hashed), np.concatenate(target))
            yield pd.DataFrame({"feature": np.append(chosen, -1), "weight": np.append(weights, bias)})

    model = labelled.mapInPandas(fit, "feature long, weight double").collect()  # at most 2 ** BITS rows
    weight, bias = np.zeros(1 << BITS), None
    for r in model:
        if r["feature"] < 0:
            bias = r["weight"]
        else:
            weight[r["feature"]] = r["weight"]
    weight = weight.astype(np.float32)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for a, b in spans(texts):
                got, f, words = votes(texts[a:b], np.zeros(b - a, dtype=np.int64))
                if bias is None:
                    bad = weak.posterior(got)
                else:
                    doc, feature = features(words, f)
                    total = bias + np.bincount(doc, weights=weight[feature], minlength=b - a)
                    bad = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                bad = np.where(f["n_words"] == 0, 1.0, bad)
                yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64").array[a:b], "score": bad, "keep": bad < 0.5}
                                   | {n: frame[n].array[a:b] for n in names})

    names = [f"carry_{i}" for i in range(len(carry))]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(f"`{c}`").alias(n) for n, c in zip(names, carry, strict=True)])
    schema = "doc_id long, score double, keep boolean" + "".join(
        f", {n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, carry, strict=True))
    return rows.mapInPandas(score, schema).withColumnsRenamed(dict(zip(names, carry, strict=True)))
