"""Quality rules learned as an ordered decision list, in DataFrame expressions alone.

Statistics of each text are expressions. Sequential covering on a bounded sample of
labelled rows learns rules for bad documents: a conjunction of thresholds grows, one
condition at a time, by information gain on two thirds of the rows until it covers no
good document there; then its last conditions are pruned as long as the remaining third
judges the rule no worse; rows it covers are taken out and the next rule is learned. The
list becomes one ``CASE WHEN`` that Spark evaluates.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that rules are learned on at most.
MAX_LABELLED = 20_000
WINDOW = 5
_WHITE = " \t\n\x0b\x0c\r"
_WORD = r"[^\x20\x09-\x0D]+"
FEATURES = ["n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "variety", "capital_share", "mark_share"]


def _missing(text: Column, characters: str) -> Column:
    """How many of these characters a text has."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def add_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of each whole text: words, their code points, symbols, repeated lines and windows."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, _WHITE, "") != "")
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)).alias("words"),
        lines.alias("lines"),
        F.length(F.translate(text, _WHITE, "")).cast("long").alias("word_chars"),
        _missing(text, "#*$%&|<>").cast("long").alias("n_symbols"),
        _missing(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÀÂÇÈÉÊËÎÏÔÙÛÁÍÓÚÑ").alias("n_capitals"),
        _missing(text, "!").alias("n_marks"))
    windows = F.slice(F.transform("words", lambda w, i: F.xxhash64(F.slice("words", i + 1, F.lit(WINDOW)))), 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))
    counted = split.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_capitals", "n_marks",
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("words")).alias("n_distinct"), windows.alias("windows"))
    return counted.withColumn("n_repeat_words", _covered(F.col("windows"))).drop("windows")


def _covered(windows: Column) -> Column:
    """Words in windows that a text has twice or more; windows are sorted to find equal neighbours."""
    placed = F.array_sort(F.arrays_zip(windows.alias("h"), F.sequence(F.lit(1), F.size(windows)).alias("p")))

    def repeated(ordered: Column) -> Column:
        beside = F.arrays_zip(ordered.alias("own"), F.slice(ordered, 2, F.size(ordered)).alias("next"),
                              F.concat(F.array(F.lit(None).cast("struct<h:bigint,p:int>")), ordered).alias("prior"))
        twice = F.filter(beside, lambda x: F.coalesce(x["own"]["h"] == x["next"]["h"], F.lit(False)) | F.coalesce(x["own"]["h"] == x["prior"]["h"], F.lit(False)))
        return F.array_sort(F.transform(twice, lambda x: x["own"]["p"]))

    def length(at: Column) -> Column:
        steps = F.arrays_zip(at.alias("a"), F.slice(at, 2, F.size(at)).alias("b"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + F.least(F.coalesce(x["b"] - x["a"], F.lit(WINDOW)), F.lit(WINDOW)))

    # each step is bound once by a lambda, so that its array is not made anew for every use
    bound = F.transform(F.transform(F.array(placed), repeated), length)[0]
    return F.when(F.size(windows) == F.size(F.array_distinct(windows)), F.lit(0).cast("long")).otherwise(bound)


def feature_columns() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {"n_words": F.col("n_words").cast("double"), "word_length": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"), "variety": share("n_distinct", "n_words"),
            "capital_share": share("n_capitals", "word_chars"), "mark_share": share("n_marks", "n_words")}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: np.ndarray) -> np.ndarray:
        column = rows[:, FEATURES.index(self.feature)]
        return column > self.threshold if self.above else column <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, rows: np.ndarray) -> np.ndarray:
    out = np.ones(len(rows), dtype=bool)
    for c in rule:
        out &= c.holds(rows)
    return out


def _best_condition(rows: np.ndarray, bad: np.ndarray) -> Condition | None:
    """The threshold with the largest gain: bad rows kept times the information won on each."""
    total, wrong = bad.sum(), len(bad) - bad.sum()
    best, gain = None, 1e-9
    before = np.log2(total / (total + wrong))
    for j, name in enumerate(FEATURES):
        order = np.argsort(rows[:, j], kind="stable")
        values, hit = rows[order, j], bad[order]
        cut = np.flatnonzero(values[1:] > values[:-1])
        if not len(cut):
            continue
        low_bad, low_all = np.cumsum(hit)[cut], cut + 1
        for above, p, n in ((False, low_bad, low_all), (True, total - low_bad, len(bad) - low_all)):
            won = p * (np.log2(np.maximum(p, 1e-9) / n) - before)
            k = int(np.argmax(won))
            if won[k] > gain:
                best, gain = Condition(name, above, float((values[cut[k]] + values[cut[k] + 1]) / 2)), won[k]
    return best


def learn_rules(rows: np.ndarray, bad: np.ndarray, fold: np.ndarray, least_precision: float = 0.9, max_conditions: int = 4) -> list[Rule]:
    """Rules in order, each for bad documents; ``fold`` marks the third that prunes."""
    rules: list[Rule] = []
    left = np.ones(len(rows), dtype=bool)
    while True:
        grow, prune = left & ~fold, left & fold
        if bad[grow].sum() < 3:
            return rules
        rule: Rule = ()
        inside = grow.copy()
        while len(rule) < max_conditions and bad[inside].sum() and (~bad[inside]).any():
            condition = _best_condition(rows[inside], bad[inside])
            if condition is None:
                break
            rule += (condition,)
            inside &= condition.holds(rows)

        def worth(r: Rule, over: np.ndarray) -> float:
            covered = _covers(r, rows) & over
            p, n = (bad & covered).sum(), (~bad & covered).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1], prune) >= worth(rule, prune):
            rule = rule[:-1]
        covered = _covers(rule, rows) & left
        judged = covered & fold if (covered & fold).any() else covered
        if not rule or bad[judged].mean() < least_precision or not (covered & bad).any():
            return rules
        rules.append(rule)
        left &= ~covered


def verdict(rules: list[Rule]) -> Column:
    """The decision list: the first rule that holds says no; otherwise yes."""
    columns, out = feature_columns(), None
    for rule in rules:
        holds = F.lit(True)
        for c in rule:
            holds = holds & (columns[c.feature] > c.threshold if c.above else columns[c.feature] <= c.threshold)
        out = F.when(holds, False) if out is None else out.when(holds, False)
    return F.lit(True) if out is None else out.otherwise(True)


def fit_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Learn from ``quality`` (0 is bad) of at most ``max_labelled`` rows of ``labels``, the first by a hash of the id."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality"))
    sample = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    statistics = add_statistics(labelled).join(F.broadcast(sample), "doc_id")
    got = statistics.select(*[c.alias(k) for k, c in feature_columns().items()], (F.col("quality") == 0).alias("bad"),
                            (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0).alias("fold"), "doc_id").collect()
    got = sorted(got, key=lambda r: r["doc_id"])
    if not got:
        return []
    rows = np.array([[r[k] for k in FEATURES] for r in got], dtype=np.float64)
    return learn_rules(rows, np.array([r["bad"] for r in got]), np.array([r["fold"] for r in got]))


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Counts of every row, ``base_failed`` and ``kept``: the base limits first, then the decision list.

    A null text has no words and fails the base limits. Repeated ids are judged row by row; other columns are not read.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return add_statistics(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                       failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
