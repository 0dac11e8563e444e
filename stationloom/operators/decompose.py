"""Classical seasonal decomposition of evenly spaced series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationloom.operators.attach import attach
from stationloom.operators.timeseries import (
    SERIES_KEYS,
    fill_both,
    interpolate_time,
    monotone_cubic,
    on_the_line,
    with_position,
)
from stationloom.plans.materialise import materialise
from stationloom.schema import TIME, VALUE

# Rows per piece of a series in the moving-average window.
BLOCK_ROWS = 100_000


def seasonal_decompose(df: DataFrame, period: int = 365, model: str = "additive",
                       keys: Sequence[str] = SERIES_KEYS, time: str = TIME,
                       value: str = VALUE,
                       strict: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``trend``, ``seasonal`` and ``resid``.

    The trend is a centred moving average over ``period`` rows (end points of an
    even period weigh half). Where its window does not fit it follows the line
    fitted to the ``period`` trend points next to that end. Seasonal figures are
    mean deviations per position in the period, centred on 0 (multiplicative:
    on 1). Series shorter than two periods get nulls; with ``strict`` they
    raise. A null value fails the query: interpolate first. So does a value of 0
    or less in the multiplicative model.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError("model must be 'additive' or 'multiplicative'")
    if period < 2:
        raise ValueError("period must be at least 2")
    keys = list(keys)
    additive = model == "additive"
    rows = with_position(
        df.withColumn(value, _usable(value, additive)), keys, time, value
    ).drop("before", "after")
    if strict:
        short = rows.where(F.col("series_rows") < 2 * period)
        if not short.isEmpty():
            raise ValueError(f"a series has fewer than {2 * period} rows")
    # Seasonal figures and the join onto them both read the windowed rows.
    rows = materialise(
        _moving_average(rows, keys, period, value, block_rows).withColumn(
            "__phase", F.col("position") % period
        )
    )
    figures = _phase_figures(rows, keys, period, value, additive)
    columns = ["seasonal", *_LINES]
    rows = attach(rows, figures, [*keys, "__phase"], columns)
    rows = rows.withColumn("trend", _trend(period))
    x, trend, seasonal = F.col(value), F.col("trend"), F.col("seasonal")
    resid = (
        x - trend - seasonal if additive
        else x / _nonzero(trend) / _nonzero(seasonal)
    )
    return rows.withColumn("resid", resid).select(
        *df.columns, "trend", "seasonal", "resid"
    )


_LINES = ["__front_slope", "__front_level", "__back_slope", "__back_level"]


def _usable(value: str, additive: bool) -> Column:
    x = F.col(value).cast("double")
    checked = F.when(
        x.isNull(), F.raise_error(F.lit("null value in a series to decompose")).cast("double"))
    if not additive:
        checked = checked.when(
            x <= 0, F.raise_error(F.lit("value of 0 or less in a multiplicative model"))
            .cast("double"))
    return checked.otherwise(x)


def _nonzero(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def _from_end() -> Column:
    """Position counted from the last row, so its numbers stay small."""
    return F.col("position") - F.col("series_rows") + 1


def _trend(period: int) -> Column:
    """Moving average, and the fitted lines where its window does not fit."""
    half = period // 2
    front = F.col("__front_slope") * F.col("position") + F.col("__front_level")
    back = F.col("__back_slope") * _from_end() + F.col("__back_level")
    return (
        F.when(F.col("__average").isNotNull(), F.col("__average"))
        .when(F.col("position") < half, front).otherwise(back)
    )


def _phase_figures(rows: DataFrame, keys: list[str], period: int, value: str,
                   additive: bool) -> DataFrame:
    """Seasonal figure and end lines, one row per series and phase.

    One aggregate suffices: a phase has at most one point in each end and in
    each stretch a line is fitted to, so these come along as plain values and
    the lines follow from the ``period`` rows per series.
    """
    half = period // 2
    x, average, position = F.col(value), F.col("__average"), F.col("position")
    from_end = _from_end()
    # Fixed rule: the right fit stops one point before the last trend point.
    last = F.col("series_rows") - 1 - half
    in_front = (position >= half) & (position < F.least(half + F.lit(period), last))
    in_back = (position >= F.greatest(F.lit(half), last - period)) & (position < last)
    at_front, at_back = position < half, from_end > -half
    long_enough = F.col("series_rows") >= 2 * period

    def only(where: Column, c: Column) -> Column:
        return F.max(F.when(where & long_enough, c))

    inner = x - average if additive else x / _nonzero(average)
    table = rows.groupBy(*keys, "__phase").agg(
        F.sum(inner).alias("sum"), F.count(inner).alias("n"),
        only(in_front, average).alias("front_t"), only(in_front, position).alias("front_p"),
        only(in_back, average).alias("back_t"), only(in_back, from_end).alias("back_p"),
        only(at_front, x).alias("front_x"), only(at_front, position).alias("front_at"),
        only(at_back, x).alias("back_x"), only(at_back, from_end).alias("back_at"),
    )
    series = Window.partitionBy(*keys)
    table = table.withColumns({
        f"__{side}_{name}": f(F.col(f"{side}_t"), F.col(f"{side}_p")).over(series)
        for side in ("front", "back")
        for name, f in (("slope", F.regr_slope), ("level", F.regr_intercept))
    })

    def at_end(side: str) -> Column:
        line = F.col(f"__{side}_slope") * F.col(f"{side}_at") + F.col(f"__{side}_level")
        x = F.col(f"{side}_x")
        return x - line if additive else x / _nonzero(line)

    total, n = F.coalesce("sum", F.lit(0.0)), F.col("n")
    for side in ("front", "back"):
        total = total + F.coalesce(at_end(side), F.lit(0.0))
        n = n + F.when(at_end(side).isNotNull(), 1).otherwise(0)
    table = table.withColumn("mean", F.when(n > 0, total / n))
    centre = F.avg("mean").over(series)
    figure = F.col("mean") - centre if additive else F.col("mean") / _nonzero(centre)
    return table.withColumn("seasonal", figure)


def _moving_average(rows: DataFrame, keys: list[str], period: int, value: str,
                    block_rows: int) -> DataFrame:
    """Centred average, null where the window does not fit.

    A series is cut into blocks of rows; rows within half a period of a block
    border are also handed to the neighbour, so every window sees all it needs
    while no task gets more than a block.
    """
    half = period // 2
    block_rows = max(block_rows, period)
    own = F.floor(F.col("position") / block_rows)
    lowest = F.floor((F.col("position") - half) / block_rows)
    highest = F.floor((F.col("position") + half) / block_rows)
    spread_out = rows.withColumn(
        "__block", F.explode(F.sequence(F.greatest(lowest, F.lit(0)), highest))
    ).withColumn("__own", own)
    w = Window.partitionBy(*keys, "__block").orderBy("position")
    # Differences of running sums: a sliding frame would add up ``period`` values
    # for every row. Running sums start at the block, which bounds their size.
    running = F.sum(value).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    if period % 2:
        total = F.lead("__running", half).over(w) - F.coalesce(
            F.lag("__running", half + 1).over(w), F.lit(0.0)
        )
    else:
        ends = F.lag(value, half).over(w) + F.lead(value, half).over(w)
        total = (
            F.lead("__running", half - 1).over(w) - F.lag("__running", half).over(w)
            + ends / 2
        )
    fits = (F.col("position") >= half) & (
        F.col("position") < F.col("series_rows") - half
    ) & (F.col("series_rows") >= 2 * period)
    return (
        spread_out.withColumn("__running", running).withColumn("__total", total)
        .where(F.col("__block") == F.col("__own"))
        .withColumn("__average", F.when(fits, F.col("__total") / period))
        .drop("__block", "__own", "__running", "__total")
    )


def seasonal_figures(rows: DataFrame, keys: Sequence[str], period: int, value: str = VALUE,
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``keys, figures``: the additive seasonal figure of each phase, in order, one row per series.

    ``rows`` come from :func:`with_position` and have no null values. Figures are null in a
    series shorter than two periods.
    """
    averaged = _moving_average(rows, list(keys), period, value, block_rows).withColumn(
        "__phase", F.col("position") % period)
    table = _phase_figures(averaged, list(keys), period, value, True)
    return table.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("__phase", "seasonal"))).alias("figures")
    ).select(*keys, F.col("figures.seasonal").alias("figures"))


def seasonal_impute(df: DataFrame, method: str = "deseasonalised", period: int = 365,
                    keys: Sequence[str] = SERIES_KEYS, time: str = TIME,
                    value: str = VALUE, limit: int = 0) -> DataFrame:
    """Fill nulls from the season; observed values stay.

    ``deseasonalised`` takes the seasonal figure of each row off the series, interpolates
    what is left over time, and puts the figure back, so long gaps follow the season. The
    figures come from decomposing the interpolated series; series shorter than two
    periods have none and are interpolated. ``recomposed`` adds up the decomposition of
    the interpolated series again, which is :func:`interpolate_time`.

    ``spline`` joins what is left by a monotone cubic through the two nearest observed
    values to each side; at an end of the series it stays at the last one. Gaps of up to
    ``limit`` rows between observed values lie on a straight line instead. A series
    without any value keeps its nulls.
    """
    if method == "recomposed":
        return interpolate_time(df, keys, time, value)
    if method == "spline":
        return _seasonal_spline(df, period, list(keys), time, value, limit)
    if method != "deseasonalised":
        raise ValueError("method must be 'deseasonalised', 'spline' or 'recomposed'")
    whole = interpolate_time(
        df.withColumn("__observed", F.col(value)), keys, time, value
    ).where(F.col(value).isNotNull())
    parts = seasonal_decompose(whole, period, "additive", keys, time, value)
    season = F.coalesce("seasonal", F.lit(0.0))
    rest = parts.withColumns({"__season": season, value: F.col("__observed") - season})
    filled = interpolate_time(
        rest.drop("trend", "seasonal", "resid"), keys, time, value)
    return filled.withColumn(
        value, F.coalesce(F.col("__observed"), F.col(value) + F.col("__season"))
    ).select(*df.columns)


def _seasonal_spline(df: DataFrame, period: int, keys: list[str], time: str, value: str,
                     limit: int) -> DataFrame:
    if period < 2 or limit < 0:
        raise ValueError("period must be at least 2 and limit not negative")
    placed = with_position(df, keys, time, value, second=True)
    gap = F.col(value).isNull()
    # Read by the figures, for the observed rows and for the gaps; only gaps need neighbours.
    rows = materialise(placed.withColumns(
        {"__whole": fill_both(time, value).cast("double")}
        | {side: F.when(gap, F.col(side)) for side in ("before", "after")}))
    figures = seasonal_figures(
        rows.where(F.col("__whole").isNotNull()).select(
            *keys, "position", "series_rows", F.col("__whole").alias(value)),
        keys, period, value)
    gaps = attach(rows.where(gap), figures, keys, ["figures"])

    def season(row: Column) -> Column:
        return F.coalesce(F.get("figures", (row % period).cast("int")), F.lit(0.0))

    def rest(side: str, which: str = "") -> Column:
        return F.col(f"{side}.value{which}") - season(F.col(f"{side}.row{which}"))

    before, after = F.col("before"), F.col("after")
    own = season(F.col("position"))
    filled = (
        F.when(before.isNull() & after.isNull(), F.lit(None))
        .when(before.isNull(), rest("after") + own)
        .when(after.isNull(), rest("before") + own)
        .when(after["row"] - before["row"] - 1 <= limit, on_the_line(time))
        .otherwise(own + monotone_cubic(
            time, rest("before", "2"), rest("before"), rest("after"), rest("after", "2")))
    )
    observed = rows.where(~gap).withColumn(value, F.col(value).cast("double")).select(*df.columns)
    return observed.unionByName(gaps.withColumn(value, filled).select(*df.columns))
