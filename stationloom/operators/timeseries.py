"""Gap filling along time.

Nothing here runs a window over all rows of a series. Windows look inside an hour of a
series; what an hour must know of its neighbours (row offset, nearest valid value before
and after) is found over one summary row per hour inside a year, and what a year must
know over one summary row per year. The levels are the same for every series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationloom.functions import (
    format_offset,
    number_column,
    observation_instant,
    round_n,
    unit_of,
)
from stationloom.operators.reshape import only_row
from stationloom.operators.attach import attach
from stationloom.schema import ELEMENT, OFFSET, SOURCE, TIME, UNIT, VALUE

SERIES_KEYS = (SOURCE, ELEMENT)
LEVELS = ("hour", "year")


def with_position(df: DataFrame, keys: Sequence[str] = SERIES_KEYS,
                  time: str = TIME, value: str = VALUE,
                  second: bool = False) -> DataFrame:
    """Add where each row stands in its series.

    ``position`` numbers the rows of a series from 0 by time, ``series_rows``
    is their number. ``before`` and ``after`` are ``(at, value, row)`` of the
    nearest valid rows at or before and at or after, null if there is none:
    time in microseconds, value and position.
    With ``second`` they also hold ``(at2, value2, row2)`` of the valid row next
    beyond, null if there is none. Two rows of a series at one time are an error.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    fields = [f"k{i}" for i in range(len(keys))]
    # Keys travel inside the chunk only, so that a row is as short as can be where it is sorted.
    chunked = df.select(*_group(
        [*[F.col(k).alias(f) for k, f in zip(keys, fields)],
         *[F.date_trunc(u, time).alias(u) for u in reversed(LEVELS)]], "chunk"), *others)
    forward = Window.partitionBy("__chunk_mix", "__chunk").orderBy(time)
    is_valid = F.col(value).isNotNull()
    at = F.unix_micros(time)

    numbered = chunked.withColumns({
        "__row": F.row_number().over(forward).cast("bigint") - 1,
        "__tied": F.lag(time).over(forward) == F.col(time),
    })
    point = F.when(is_valid, F.struct(
        at.alias("at"), F.col(value).alias("value"), F.col("__row").alias("row")))

    # All neighbours come from the one order, so a task sorts its rows once.
    sides = {}
    for side, f in (("before", "lag"), ("after", "lead")):
        sides[f"__{side}"] = F.coalesce("__point", _next_valid(f, "__point", 1, "chunk", time))
        if second:
            sides[f"__{side}_next"] = F.when(
                F.col("__point").isNotNull(), _next_valid(f, "__point", 1, "chunk", time)
            ).otherwise(_next_valid(f, "__point", 2, "chunk", time))
    windowed = numbered.withColumn("__point", point).withColumns(sides)
    if second:
        windowed = windowed.withColumns({
            f"__{side}": _and_next(f"__{side}", f"__{side}_next") for side in ("before", "after")})
    # After the shuffle of the rows, which the summary shares: an hour holds few rows, so
    # combining them before a shuffle of its own would save little.
    edges = (windowed, F.col("__after"), F.col("__before")) if second else (numbered, point, point)
    valid_at = F.when(is_valid, at)
    summary = edges[0].groupBy("__chunk_mix", "__chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(edges[1], valid_at).alias("first"),
        F.max_by(edges[2], valid_at).alias("last"),
    )
    summary = _carry(summary, [*fields, *reversed(LEVELS)], len(keys), second).select(
        F.col("__chunk_mix").alias("__their_mix"), F.col("__chunk").alias("__their_chunk"),
        "__offset", "__carry_before", "__carry_after", "__series_rows",
    )
    # Both sides are dealt and sorted by the chunk already, or are one row per chunk.
    joined = windowed.join(summary, (windowed["__chunk_mix"] == summary["__their_mix"])
                           & (windowed["__chunk"] == summary["__their_chunk"]))
    offset = F.col("__offset")

    def untied(result: Column) -> Column:
        return F.when(
            F.col("__tied"), F.raise_error(F.lit("two rows of one series at one time"))
        ).otherwise(result)

    before = _completed(_shifted("__before", offset, second), "__carry_before", second)
    after = _completed(_shifted("__after", offset, second), "__carry_after", second)
    key_of = dict(zip(keys, fields))
    return joined.select(
        *[F.col("__chunk")[key_of[c]].alias(c) if c in key_of else c for c in df.columns],
        untied(F.col("__row") + offset).alias("position"),
        F.col("__series_rows").alias("series_rows"),
        untied(before).alias("before"),
        after.alias("after"),
    )


def _group(fields: Sequence[Column], name: str) -> list[Column]:
    """``__name``, a struct of what makes a group, and its hash, which keeps sorting and comparing cheap.

    The struct itself is never null, so it is equal where all its fields are or are both
    null, and windows, aggregates and joins by it share one shuffle.
    """
    group = F.struct(*fields)
    return [F.xxhash64(group).alias(f"__{name}_mix"), group.alias(f"__{name}")]


def _next_valid(f: str, point: str, steps: int, name: str, order: str) -> Column:
    """The ``steps``-th row before (``lag``) or after (``lead``) with a point."""
    return F.expr(f"{f}({point}, {steps}) IGNORE NULLS OVER "
                  f"(PARTITION BY __{name}_mix, __{name} ORDER BY `{order}`)")


def _and_next(point: str, beyond: str) -> Column:
    """A point together with the one beyond it."""
    p, q = F.col(point), F.col(beyond)
    return F.when(p.isNotNull(), F.struct(
        p["at"].alias("at"), p["value"].alias("value"), p["row"].alias("row"),
        q["at"].alias("at2"), q["value"].alias("value2"), q["row"].alias("row2"),
    ))


def _shifted(valid_row: str, offset: Column, second: bool = False) -> Column:
    c = F.col(valid_row)
    fields = [c["at"].alias("at"), c["value"].alias("value"),
              (c["row"] + offset).alias("row")]
    if second:
        fields += [c["at2"].alias("at2"), c["value2"].alias("value2"),
                   (c["row2"] + offset).alias("row2")]
    return F.when(c.isNotNull(), F.struct(*fields))


def _completed(nearest: Column, beyond: str, second: bool) -> Column:
    """``nearest``, or what lies beyond its chunk if there is none; ``second`` fills up its second point."""
    other = F.col(beyond)
    if second:
        nearest = F.when(nearest["at2"].isNotNull(), nearest).when(
            nearest.isNotNull(), F.struct(
                nearest["at"].alias("at"), nearest["value"].alias("value"),
                nearest["row"].alias("row"), other["at"].alias("at2"),
                other["value"].alias("value2"), other["row"].alias("row2")))
    return F.coalesce(nearest, other)


def _carry(summary: DataFrame, fields: Sequence[str], n_keys: int, second: bool) -> DataFrame:
    """What each chunk of the finest level inherits from the rest of its series.

    ``fields`` are those of the chunk: ``n_keys`` keys, then the levels from the coarsest.
    Windows over the chunks of one coarser chunk are bounded by the calendar; the
    coarser chunks are summed up and treated the same way.
    """
    *outer, finest = fields
    chunk = F.col("__chunk")
    summary = summary.select(
        *_group([chunk[f].alias(f) for f in outer], "up"), chunk[finest].alias("__at"),
        "n", "first", "last")
    along = Window.partitionBy("__up_mix", "__up").orderBy("__at")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn(
        "__offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))
    ).withColumns({
        "__first": _shifted("first", F.col("__offset"), second),
        "__last": _shifted("last", F.col("__offset"), second),
    })
    carries = {
        "__carry_before": _next_valid("lag", "__last", 1, "up", "__at"),
        "__carry_after": _next_valid("lead", "__first", 1, "up", "__at"),
    }
    if second:
        # The second point of a chunk with one valid row lies in another chunk.
        summary = summary.withColumns({f"{c}_1": v for c, v in carries.items()}).withColumns({
            "__last": F.when(F.col("__last").isNotNull(), _completed(
                F.col("__last"), "__carry_before_1", True)),
            "__first": F.when(F.col("__first").isNotNull(), _completed(
                F.col("__first"), "__carry_after_1", True)),
        })
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summary = summary.withColumns(carries | {"__series_rows": F.sum("n").over(whole)})
    up = F.col("__up")
    own = _group([*[up[f].alias(f) for f in outer], F.col("__at").alias(finest)], "chunk")
    carried = ["__offset", "__carry_before", "__carry_after", "__series_rows"]
    if len(outer) == n_keys:
        return summary.select(*own, *carried)
    above = summary.groupBy("__up_mix", "__up").agg(
        F.sum("n").alias("n"),
        F.min_by("__first", F.col("__first.at")).alias("first"),
        F.max_by("__last", F.col("__last.at")).alias("last"),
    ).select(F.col("__up_mix").alias("__chunk_mix"), F.col("__up").alias("__chunk"), "n", "first", "last")
    above = _carry(above, outer, n_keys, second).select(
        F.col("__chunk_mix").alias("__over_mix"), F.col("__chunk").alias("__over"),
        *[F.col(c).alias(f"__up{c}") for c in carried])
    joined = summary.join(above, (summary["__up_mix"] == above["__over_mix"])
                          & (summary["__up"] == above["__over"]))
    base = F.col("__up__offset")
    return joined.select(
        *own, (F.col("__offset") + base).alias("__offset"),
        *[_completed(_shifted(c, base, second), f"__up{c}", second).alias(c)
          for c in ("__carry_before", "__carry_after")],
        F.col("__up__series_rows").alias("__series_rows"),
    )


_ADDED = ("position", "series_rows", "before", "after")


def on_the_line(time: str) -> Column:
    """Value at ``time`` on the straight line between the valid neighbours."""
    x0, y0 = F.col("before.at"), F.col("before.value")
    x1, y1 = F.col("after.at"), F.col("after.value")
    return y0 + (y1 - y0) * (F.unix_micros(time) - x0) / F.nullif(x1 - x0, F.lit(0))


def monotone_cubic(time: str, y0: Column, y1: Column, y2: Column, y3: Column) -> Column:
    """Value at ``time`` on a cubic between two valid points that never leaves their range.

    ``y1`` and ``y2`` belong to ``before.at`` and ``after.at``, ``y0`` and ``y3`` to the
    points beyond (``before.at2``, ``after.at2``). Slopes at the two points are weighted
    harmonic means of the slopes to both sides, 0 at a turning point, and that of the
    straight line where there is no point beyond.
    """
    def length(a: str, b: str) -> Column:
        # in days, so that numbers stay near 1
        return F.nullif((F.col(b) - F.col(a)) / F.lit(86_400_000_000.0), F.lit(0.0))

    h0, h1 = length("before.at2", "before.at"), length("before.at", "after.at")
    h2 = length("after.at", "after.at2")
    d0, d1, d2 = (y1 - y0) / h0, (y2 - y1) / h1, (y3 - y2) / h2

    def slope(ha: Column, hb: Column, da: Column, db: Column) -> Column:
        wa, wb = 2 * hb + ha, hb + 2 * ha
        mean = (wa + wb) / F.nullif(
            wa / F.nullif(da, F.lit(0.0)) + wb / F.nullif(db, F.lit(0.0)), F.lit(0.0))
        return F.when(da * db <= 0, 0.0).otherwise(mean)

    m1 = F.coalesce(slope(h0, h1, d0, d1), d1)
    m2 = F.coalesce(slope(h1, h2, d1, d2), d1)
    t = (F.unix_micros(time) - F.col("before.at")) / F.lit(86_400_000_000.0) / h1
    return (
        y1 + (y2 - y1) * t * t * (3 - 2 * t)
        + h1 * t * (1 - t) * (m1 * (1 - t) - m2 * t)
    )


def interpolate_time_limited(df: DataFrame, limit: int = 3,
                             keys: Sequence[str] = SERIES_KEYS, time: str = TIME,
                             value: str = VALUE) -> DataFrame:
    """Time-weighted interpolation of the first ``limit`` nulls of each gap.

    The rest of a longer gap stays null, leading nulls stay null, trailing
    nulls repeat the last value up to the limit.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    rows = with_position(df, keys, time, value)
    into_gap = F.col("position") - F.col("before.row")
    filled = (
        F.when(F.col(value).isNotNull(), F.col(value))
        .when(F.col("before").isNull() | (into_gap > limit), F.lit(None))
        .when(F.col("after").isNull(), F.col("before.value"))
        .otherwise(on_the_line(time))
    )
    return rows.withColumn(value, filled).drop(*_ADDED)


def fill_both(time: str, value: str) -> Column:
    return (
        F.when(F.col(value).isNotNull(), F.col(value))
        .when(F.col("before").isNull(), F.col("after.value"))
        .when(F.col("after").isNull(), F.col("before.value"))
        .otherwise(on_the_line(time))
    )


def interpolate_time(df: DataFrame, keys: Sequence[str] = SERIES_KEYS,
                     time: str = TIME, value: str = VALUE) -> DataFrame:
    """Time-weighted interpolation of every gap; the ends take the nearest value."""
    rows = with_position(df, keys, time, value)
    return rows.withColumn(value, fill_both(time, value)).drop(*_ADDED)


def fill_forward_backward(df: DataFrame, keys: Sequence[str] = SERIES_KEYS,
                          time: str = TIME, value: str = VALUE) -> DataFrame:
    """Last valid value carried forward, then the first carried backward."""
    rows = with_position(df, keys, time, value)
    return rows.withColumn(
        value, F.coalesce("before.value", "after.value")
    ).drop(*_ADDED)


def impute(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, time: str = TIME,
           value: str = VALUE, method: str = "line", limit: int = 3,
           period: int = 365) -> DataFrame:
    """Fill every gap of every series; observed values stay.

    ``line`` fills short gaps by limited interpolation and all others by seasonal
    recomposition. A decomposition's parts add up to the interpolated series they came
    from, and limited interpolation puts its values on the same line, so both steps
    together are :func:`interpolate_time`, whatever ``limit`` and ``period``.
    ``seasonal_spline`` puts gaps of up to ``limit`` rows on the line and longer ones, and
    those at the ends of a series, on a monotone cubic above the season; see
    :func:`stationloom.operators.decompose.seasonal_impute`.
    """
    if method == "line":
        return interpolate_time(df, keys, time, value)
    if method != "seasonal_spline":
        raise ValueError("method must be 'line' or 'seasonal_spline'")
    from stationloom.operators.decompose import seasonal_impute

    return seasonal_impute(df, "spline", period, keys, time, value, limit)


def observation_grid(df: DataFrame) -> DataFrame:
    """Every element of a station at every instant the station has.

    ``instant`` is time plus offset. Cells without a row have a null value and
    ``observed_offset``. Two rows for one cell are an error. Rows without an element
    belong to no series and are left out.
    """
    rows = df.where(F.col(ELEMENT).isNotNull()).select(
        SOURCE, ELEMENT, OFFSET,
        observation_instant(F.col(TIME), F.col(OFFSET)).alias("instant"),
        number_column(df).alias(VALUE),
    )
    cells = rows.groupBy(SOURCE, "instant", ELEMENT).agg(
        only_row(F.struct(VALUE, OFFSET), "observation").alias("cell")
    )
    # At most one entry per element: bounded by the vocabulary.
    instants = cells.groupBy(SOURCE, "instant").agg(
        F.map_from_entries(F.collect_list(F.struct(ELEMENT, "cell"))).alias("cells")
    )
    elements = rows.groupBy(SOURCE).agg(F.collect_set(ELEMENT).alias("elements"))
    # Observations of a station bound its instants.
    wide = attach(instants, elements, [SOURCE], ["elements"])
    grid = wide.select(
        SOURCE, "instant", "cells", F.explode("elements").alias(ELEMENT)
    )
    cell = F.try_element_at("cells", F.col(ELEMENT))
    return grid.select(
        SOURCE, "instant", ELEMENT,
        cell[VALUE].alias(VALUE), cell[OFFSET].alias("observed_offset"),
    )


def impute_observations(df: DataFrame, keep_observed_offsets: bool = False,
                        method: str = "line", limit: int = 3,
                        period: int = 365) -> DataFrame:
    """Complete grid of observations with every gap filled, 3 decimals.

    ``method``, ``limit`` and ``period`` are those of :func:`impute`.

    Offsets come from the instant's time of day, so a filled element appears at
    every time of day its station has; ``keep_observed_offsets`` keeps the
    offset text of rows that existed. ``is_imputed`` marks filled values.
    """
    grid = observation_grid(df)
    grid = grid.withColumn("is_imputed", F.col(VALUE).isNull())
    filled = impute(grid, (SOURCE, ELEMENT), "instant", VALUE, method, limit, period)
    offset = format_offset(F.col("instant"))
    if keep_observed_offsets:
        offset = F.coalesce("observed_offset", offset)
    return filled.select(
        SOURCE, F.col("instant").alias(TIME), offset.alias(OFFSET), ELEMENT,
        round_n(F.col(VALUE), 3).alias(VALUE), unit_of(F.col(ELEMENT)).alias(UNIT),
        F.col("is_imputed") & F.col(VALUE).isNotNull(),
    ).toDF(SOURCE, TIME, OFFSET, ELEMENT, VALUE, UNIT, "is_imputed")
