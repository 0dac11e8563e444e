"""Exact quantiles and other aggregates per group, with small group state.

``percentile`` keeps one entry per distinct value of a group, too much for a group with
a large share of all rows. So a first pass makes a sketch of each group, which brackets
every wanted quantile between two values. Clamping a value into its bracket keeps the
order of all values and leaves those inside unchanged, so ``percentile`` over clamped
values is the exact answer while its state shrinks to the values inside the brackets: a
share of ``4 / accuracy`` of the group. All groups go the same way, whatever their size.
A check fails the query should a bracket ever miss its rank.

What decides is what the key is, never how many rows there are: a group of one series and
one day, month or year is bounded by the calendar, so callers that group that way say so
and get plain ``percentile`` in the one aggregate that reads the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.operators.attach import attach

# Ranks are known to a part in ACCURACY; it changes time and state, not results.
ACCURACY = 10_000


@dataclass(frozen=True)
class Quantile:
    """Quantile ``p`` of column ``value``, delivered as ``name``."""

    name: str
    value: str
    p: float


def aggregate_groups(df: DataFrame, keys: Sequence[str],
                     quantiles: Sequence[Quantile],
                     aggregates: Sequence[Column] = (), *, calendar: bool = False,
                     accuracy: int = ACCURACY) -> DataFrame:
    """One row per ``keys`` with exact ``quantiles`` and plain ``aggregates``.

    Quantiles interpolate linearly and ignore nulls. ``calendar`` says that the keys hold
    a series and a period of the calendar, which bounds every group.
    """
    if not quantiles:
        return df.groupBy(*keys).agg(*aggregates)
    if calendar:
        exact = [F.percentile(q.value, q.p).alias(q.name) for q in quantiles]
        return df.groupBy(*keys).agg(*aggregates, *exact)
    by_value: dict[str, list[Quantile]] = {}
    for q in sorted(quantiles, key=lambda q: q.p):
        by_value.setdefault(q.value, []).append(q)
    return _with_brackets(df, keys, by_value, aggregates, accuracy)


def _percentiles(column: str, wanted: Sequence[Quantile]) -> Column:
    return F.percentile(F.col(column), F.array(*[F.lit(q.p) for q in wanted]))


def _with_brackets(df: DataFrame, keys: Sequence[str],
                   by_value: dict[str, list[Quantile]],
                   aggregates: Sequence[Column], accuracy: int) -> DataFrame:
    # The sketch is right to one rank in ``accuracy``, so twice that to each side holds
    # the wanted rank.
    margin = 2.0 / accuracy
    sketches, edges = [], []
    for i, (value, wanted) in enumerate(by_value.items()):
        points = []
        for j, q in enumerate(wanted):
            points += [max(0.0, q.p - margin), min(1.0, q.p + margin)]
            # A group of up to ``accuracy`` values is its own bracket.
            edge = F.when(F.col(f"__size_{i}") > accuracy, F.col(f"__edges_{i}"))
            edges += [edge[2 * j].alias(f"__low_{i}_{j}"),
                      edge[2 * j + 1].alias(f"__high_{i}_{j}")]
        sketches += [F.percentile_approx(value, points, accuracy).alias(f"__edges_{i}"),
                     F.count(value).alias(f"__size_{i}")]
    brackets = df.groupBy(*keys).agg(*sketches).select(*keys, *edges)
    return exact_within(df, brackets, keys, by_value, aggregates)


def exact_within(df: DataFrame, brackets: DataFrame, keys: Sequence[str],
                 by_value: dict[str, list[Quantile]], aggregates: Sequence[Column]) -> DataFrame:
    """Exact quantiles from one pass, with state for the values inside ``brackets`` only.

    ``brackets`` has ``__low_i_j`` and ``__high_i_j`` for quantile j of column i, in
    ascending order; null means no bracket.
    """
    added = [c for c in brackets.columns if c not in keys]
    rows = attach(df, brackets, keys, added)

    clamped, measures = {}, list(aggregates)
    for i, (value, wanted) in enumerate(by_value.items()):
        v = F.col(value)
        clamped[f"__clamped_{i}"] = _clamp(v, i, len(wanted))
        measures += [_percentiles(f"__clamped_{i}", wanted).alias(f"__points_{i}"),
                     F.count(v).alias(f"__n_{i}")]
        for j in range(len(wanted)):
            measures += [
                F.count_if(v < F.col(f"__low_{i}_{j}")).alias(f"__below_{i}_{j}"),
                F.count_if(v > F.col(f"__high_{i}_{j}")).alias(f"__above_{i}_{j}"),
            ]
    grouped = rows.withColumns(clamped).groupBy(*keys).agg(*measures)

    results = {}
    for i, wanted in enumerate(by_value.values()):
        n = F.col(f"__n_{i}")
        for j, q in enumerate(wanted):
            position = F.lit(q.p) * (n - 1)
            held = (F.col(f"__below_{i}_{j}") <= F.floor(position)) & (
                F.col(f"__above_{i}_{j}") <= n - 1 - F.ceil(position)
            )
            results[q.name] = F.when(
                (n == 0) | held, F.col(f"__points_{i}")[j]
            ).otherwise(
                F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
            )
    helpers = [c for c in grouped.columns if c.startswith("__")]
    return grouped.withColumns(results).drop(*helpers)


def _clamp(v: Column, i: int, brackets: int) -> Column:
    """``v`` inside a bracket, else the edge of the bracket below (or the first)."""
    def low(j: int) -> Column:
        return F.col(f"__low_{i}_{j}")

    def high(j: int) -> Column:
        return F.col(f"__high_{i}_{j}")

    result = F.when(low(0).isNull() | v.isNull(), v)
    for j in range(brackets):
        result = result.when(v < low(j), low(0) if j == 0 else high(j - 1))
        result = result.when(v <= high(j), v)
    return result.otherwise(high(brackets - 1))
