"""What one station has and the other lacks.

A *missing table* has ``date, timeOffset, elementId, left_value, right_value``
and, when it comes from :func:`missing_values`, the ``city`` lacking the value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stationloom.functions import date_part_text, null_tokens_to_null
from stationloom.operators.reshape import pivot_unique
from stationloom.operators.attach import null_safe_equal
from stationloom.schema import ELEMENT, OFFSET, SOURCE, TIME, VALUE

CELL = ["date", OFFSET, ELEMENT]
LEFT, RIGHT = "left_value", "right_value"


def _cells(df: DataFrame, source_id: str | None, *extra: Column) -> DataFrame:
    """``date, timeOffset, elementId, value`` of one station or of all, null tokens removed."""
    if isinstance(df.schema[TIME].dataType, T.StringType):
        date = date_part_text(F.col(TIME))
    else:
        date = F.date_format(TIME, "yyyy-MM-dd")
    value = F.col(VALUE)
    if isinstance(df.schema[VALUE].dataType, T.StringType):
        value = null_tokens_to_null(value)
    rows = df if source_id is None else df.where(F.col(SOURCE) == source_id)
    return rows.select(date.alias("date"), OFFSET, ELEMENT, value.alias(VALUE), *extra)


def compare_stations(df: DataFrame, left: str, right: str) -> DataFrame:
    """Both stations' values side by side, cells of either station kept.

    Repeated cells give every combination, and null keys match null keys.
    """
    a = _cells(df, left).toDF("date", OFFSET, ELEMENT, LEFT)
    b = _cells(df, right).toDF("__date", "__offset", "__element", RIGHT)
    pairs = [("date", "__date"), (OFFSET, "__offset"), (ELEMENT, "__element")]
    joined = a.join(b, null_safe_equal(a, b, pairs), "full_outer")
    return joined.select(
        *[F.coalesce(x, y).alias(x) for x, y in pairs], LEFT, RIGHT
    )


def _cell_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(VALUE).isNull()).alias("nulls"),
    )


def _lacking(have: DataFrame, lack: DataFrame, have_name: str, lack_name: str,
             city: str) -> DataFrame:
    """Valued rows of ``have`` for every null or absent counterpart in ``lack``.

    Equal to filtering the full comparison, without building its combinations:
    the counterpart is reduced to two counts per cell first.
    """
    present = have.where(F.col(VALUE).isNotNull())
    counts = _cell_counts(lack).select(
        F.col("date").alias("__date"), F.col(OFFSET).alias("__offset"),
        F.col(ELEMENT).alias("__element"), "nulls",
    )
    pairs = [("date", "__date"), (OFFSET, "__offset"), (ELEMENT, "__element")]
    joined = present.join(counts, null_safe_equal(present, counts, pairs), "left")
    copies = F.coalesce("nulls", F.lit(1)).cast("int")
    return (
        joined.where(copies > 0)
        .select(*CELL, VALUE, F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
        .select(
            *CELL,
            F.lit(None).cast(have.schema[VALUE].dataType).alias(lack_name),
            F.col(VALUE).alias(have_name),
            F.lit(city).alias("city"),
        )
    )


def missing_values(df: DataFrame, left: str, right: str, left_city: str,
                   right_city: str) -> DataFrame:
    """Cells null or absent at one station and valued at the other."""
    a, b = _cells(df, left), _cells(df, right)
    columns = [*CELL, LEFT, RIGHT, "city"]
    return _lacking(b, a, RIGHT, LEFT, left_city).select(*columns).unionByName(
        _lacking(a, b, LEFT, RIGHT, right_city).select(*columns)
    )


def missing_counts(df: DataFrame, left: str, right: str, left_city: str,
                   right_city: str) -> DataFrame:
    """``city, elementId, num_missing`` straight from the observations.

    Same figures as :func:`missing_summary` over :func:`missing_values`, from
    one aggregate per cell and no join.
    """
    # One pass over the rows; a station compared with itself stands on both sides.
    sides = F.array_compact(F.array(
        F.when(F.col(SOURCE) == left, F.lit(True)), F.when(F.col(SOURCE) == right, F.lit(False))))
    cells = _cells(df.where(F.col(SOURCE).isin(left, right)), None,
                   F.explode(sides).alias("is_left"))
    is_left, empty = F.col("is_left"), F.col(VALUE).isNull()
    counts = cells.groupBy(*CELL).agg(
        F.count_if(is_left).alias("l"),
        F.count_if(is_left & empty).alias("ln"),
        F.count_if(~is_left).alias("r"),
        F.count_if(~is_left & empty).alias("rn"),
    )
    lacking_left = (F.col("r") - F.col("rn")) * F.when(
        F.col("l") == 0, 1).otherwise(F.col("ln"))
    lacking_right = (F.col("l") - F.col("ln")) * F.when(
        F.col("r") == 0, 1).otherwise(F.col("rn"))
    totals = counts.groupBy(ELEMENT).agg(
        F.sum(lacking_left).alias("n_left"), F.sum(lacking_right).alias("n_right")
    )
    sides = F.array(
        F.struct(F.lit(left_city).alias("city"), F.col("n_left").alias("num_missing")),
        F.struct(F.lit(right_city).alias("city"), F.col("n_right").alias("num_missing")),
    )
    return (
        totals.select(ELEMENT, F.inline(sides))
        .where(F.col("num_missing") > 0)
        .select("city", ELEMENT, "num_missing")
    )


def missing_counts_for_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """:func:`missing_counts` of every pair of stations listed in ``pairs`` at once.

    ``pairs`` has ``left_station, right_station``; repeated pairs count once, a null
    station has no observations. ``side`` says which of the two lacks the values.

    Days are bits of words, 64 to a word. A cell may hold several rows, so its numbers of
    rows with and without a value are written in binary, one word for each binary digit
    in use; products of the numbers are then counts of common bits. Only words, not
    observations, are copied to the pairs and shuffled by them.
    """
    left, right = "left_station", "right_station"
    pairs = pairs.select(left, right).distinct()
    sides = F.array(F.struct(F.col(left).alias(SOURCE), F.lit(True).alias("is_left")),
                    F.struct(F.col(right).alias(SOURCE), F.lit(False).alias("is_left")))
    members = pairs.select(left, right, F.inline(sides))
    known = df.join(members.select(SOURCE).distinct(), SOURCE, "left_semi")
    words = _day_words(_cells(known, None, F.col(SOURCE)))
    # One row per station and block goes to the pairs, so at most two meet in a group.
    met = words.join(members, SOURCE).groupBy(left, right, ELEMENT, OFFSET, "block", "odd").agg(
        F.collect_list(F.struct("is_left", "words")).alias("sides")
    ).withColumns({"left_words": _words_of(True), "right_words": _words_of(False)})
    totals = met.groupBy(left, right, ELEMENT).agg(
        F.sum(_common("right_words", "left_words")).alias("n_left"),
        F.sum(_common("left_words", "right_words")).alias("n_right"))
    lacking = F.array(
        F.struct(F.lit("left").alias("side"), F.col("n_left").alias("num_missing")),
        F.struct(F.lit("right").alias("side"), F.col("n_right").alias("num_missing")))
    return totals.select(left, right, ELEMENT, F.inline(lacking)).where(
        F.col("num_missing") > 0).select(left, right, "side", ELEMENT, "num_missing")


def _words_of(is_left: bool) -> Column:
    own = F.filter("sides", lambda x: x["is_left"] == is_left)
    return F.flatten(F.transform(own, lambda x: x["words"]))


def _shifted(number: Column, by: Column) -> Column:
    return F.call_function("shiftleft", number.cast("long"), by.cast("int"))


def _day_words(cells: DataFrame) -> DataFrame:
    """``sourceId, elementId, timeOffset, block, odd, words`` of cells; ``words`` is an array of ``kind, digit, word``.

    ``block`` numbers 64 days; a text that is no date is a block of its own, ``odd``.
    Kinds are ``present`` (any row), ``valued`` and ``empty`` rows with their ``digit``.
    """
    day = F.try_to_date("date", "yyyy-MM-dd")
    number = F.when(F.date_format(day, "yyyy-MM-dd") == F.col("date"), F.unix_date(day))
    numbered = cells.select(
        SOURCE, ELEMENT, OFFSET, VALUE, number.alias("number"),
        F.when(number.isNull(), F.col("date")).alias("odd"))
    counts = numbered.groupBy(SOURCE, ELEMENT, OFFSET, "number", "odd").agg(
        F.count(VALUE).alias("valued"), F.count_if(F.col(VALUE).isNull()).alias("empty"))
    # The days of a block, 64 at most, become words where they lie.
    blocks = counts.groupBy(SOURCE, ELEMENT, OFFSET, F.floor(F.col("number") / 64).alias("block"), "odd").agg(
        F.collect_list(F.struct(
            F.coalesce(F.pmod("number", F.lit(64)), F.lit(0)).alias("bit"), "valued", "empty")).alias("days"))

    def word(holds: Callable[[Column], Column]) -> Column:
        return F.aggregate("days", F.lit(0).cast("long"), lambda total, x: total.bitwiseOR(
            _shifted(holds(x), x["bit"])))

    def digits(kind: str) -> Column:
        most = F.length(F.bin(F.array_max(F.transform("days", lambda x: x[kind]))))
        return F.filter(F.transform(
            F.sequence(F.lit(0), most - 1),
            lambda d: F.struct(F.lit(kind).alias("kind"), d.alias("digit"), word(
                lambda x: F.call_function("shiftright", x[kind], d).bitwiseAND(F.lit(1))).alias("word"))),
            lambda w: w["word"] != 0)

    present = F.array(F.struct(
        F.lit("present").alias("kind"), F.lit(0).alias("digit"), word(lambda x: F.lit(1)).alias("word")))
    return blocks.select(
        SOURCE, ELEMENT, OFFSET, "block", "odd",
        F.concat(present, digits("valued"), digits("empty")).alias("words"))


def _common(having: str, lacking: str) -> Column:
    """Valued rows of one side times empty rows of the other, or times one on days it has no row."""
    def of(words: str, kind: str) -> Column:
        return F.filter(words, lambda x: x["kind"] == kind)

    none = F.lit(0).cast("long")
    present = F.coalesce(F.get(of(lacking, "present"), F.lit(0))["word"], none)

    def product(x: Column) -> Column:
        absent = _shifted(F.bit_count(x["word"].bitwiseAND(F.bitwise_not(present))), x["digit"])
        return F.aggregate(of(lacking, "empty"), absent, lambda total, y: total + _shifted(
            F.bit_count(x["word"].bitwiseAND(y["word"])), x["digit"] + y["digit"]))

    return F.aggregate(of(having, "valued"), none, lambda total, x: total + product(x))


def missing_summary(missing: DataFrame) -> DataFrame:
    """Rows per city and element, ordered by city, then most missing first."""
    return (
        missing.groupBy("city", ELEMENT)
        .agg(F.count(F.lit(1)).alias("num_missing"))
        .orderBy("city", F.desc("num_missing"))
    )


def lacking_city(left_city: str, right_city: str) -> Column:
    """City lacking the value; when both are null it is the right one."""
    return F.when(F.col(RIGHT).isNull(), right_city).when(
        F.col(LEFT).isNull(), left_city
    )


def missing_rows_classified(missing: DataFrame, left_city: str,
                            right_city: str) -> DataFrame:
    """Rows of a missing table with the city found from its null columns."""
    return (
        missing.withColumn("missing", lacking_city(left_city, right_city))
        .where(F.col("missing").isNotNull())
        .select(*CELL, "missing")
    )


def missing_summary_classified(missing: DataFrame, left_city: str,
                               right_city: str) -> DataFrame:
    """:func:`missing_summary` with the city found from the null columns."""
    rows = missing_rows_classified(missing, left_city, right_city)
    return missing_summary(rows.withColumnRenamed("missing", "city"))


def missing_counts_filtered(missing: DataFrame, left_city: str, right_city: str,
                            element_id: str, cities: Sequence[str]) -> DataFrame:
    """Classified counts of one element for chosen cities, texts trimmed."""
    rows = missing_rows_classified(missing, left_city, right_city)
    return (
        rows.select(F.trim("missing").alias("city"), F.trim(ELEMENT).alias(ELEMENT))
        .where((F.col(ELEMENT) == element_id) & F.col("city").isin(list(cities)))
        .groupBy("city", ELEMENT)
        .agg(F.count(F.lit(1)).alias("num_missing"))
    )


def missing_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing rows per city in two missing tables, absent counted as 0.

    A table of counts, as :func:`missing_counts` makes it, does as well.
    """
    def rows(table: DataFrame) -> Column:
        return F.col("num_missing") if "num_missing" in table.columns else F.lit(1)

    both = before.select("city", rows(before).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select("city", F.lit(0).alias("b"), rows(after).alias("a"))
    )
    return both.groupBy("city").agg(
        F.sum("b").alias("before"), F.sum("a").alias("after")
    )


def missing_indicator_wide(missing: DataFrame, city: str, left_city: str,
                           right_city: str, elements: Sequence[str]) -> DataFrame:
    """Date and offset x element: 1.0 where the city lacks the value, else null.

    An element the city never lacks is a column of 0.
    """
    rows = missing_rows_classified(missing, left_city, right_city).where(
        F.col("missing") == city
    )
    lacks = {e: F.max(F.when(F.col(ELEMENT) == e, F.lit(1.0))) for e in elements}
    cells = rows.groupBy("date", OFFSET).agg(*[c.alias(e) for e, c in lacks.items()])
    # One row: whether the city ever lacks each element.
    ever = rows.agg(F.array(*[c.isNotNull() for c in lacks.values()])).scalar()
    return cells.select("date", OFFSET, *[
        F.when(ever[i], F.col(f"`{e}`")).otherwise(F.lit(0.0)).alias(e)
        for i, e in enumerate(elements)
    ])


def values_by_offset(missing: DataFrame, value: str, offsets: Sequence[str],
                     order: Sequence[str] | None = None) -> DataFrame:
    """Date x offset with one station's value; a repeated cell is an error.

    ``order`` keeps and orders some of the offset columns.
    """
    wide = pivot_unique(missing, ["date"], OFFSET, value, offsets)
    if order:
        wide = wide.select("date", *[o for o in order if o in offsets])
    return wide


def values_by_element(missing: DataFrame, value: str,
                      elements: Sequence[str]) -> DataFrame:
    """Date and offset x element with one station's value, sorted."""
    return pivot_unique(missing, ["date", OFFSET], ELEMENT, value, elements).orderBy(
        "date", OFFSET
    )


def missing_summary_pivot(summary: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Element x city counts, absent counted as 0."""
    return (
        summary.groupBy(ELEMENT).pivot("city", list(cities))
        .agg(F.first("num_missing")).na.fill(0)
    )


def missing_dates(missing: DataFrame, value: str, cells: str = "pivot",
                  elements: Sequence[str] | None = None) -> DataFrame:
    """``elementId, date`` of the missing dates, as :func:`missing_runs` takes them."""
    if cells not in ("pivot", "recorded"):
        raise ValueError("cells must be 'pivot' or 'recorded'")
    if cells == "recorded":
        dates = missing.where(F.col(value).isNull()).select(ELEMENT, "date")
    else:
        if elements is None:
            raise ValueError("cells='pivot' needs the names of the elements")
        # Elements valued in a cell form a set no larger than the vocabulary.
        valued = F.collect_set(F.when(F.col(value).isNotNull(), F.col(ELEMENT)))
        dates = missing.groupBy("date", OFFSET).agg(
            F.array_except(
                F.array(*[F.lit(e) for e in elements]), valued
            ).alias("absent")
        ).select(F.explode("absent").alias(ELEMENT), "date")
    return dates.select(ELEMENT, F.to_date("date").alias("date")).where(
        F.col("date").isNotNull()
    ).distinct()


def missing_runs(missing: DataFrame, value: str, cells: str = "pivot",
                 elements: Sequence[str] | None = None) -> DataFrame:
    """Maximal runs of missing dates per element, dates a day apart merged.

    ``cells='pivot'`` also takes a cell that the table does not hold at all as
    missing, for every date and offset it does hold. ``cells='recorded'`` takes
    only rows it holds. Repeated cells are missing if all their values are.
    """
    dates = missing_dates(missing, value, cells, elements)
    # Distinct dates per element: bounded by the calendar.
    w = Window.partitionBy(ELEMENT).orderBy("date")
    previous = F.lag("date").over(w)
    starts = previous.isNull() | (F.date_diff("date", previous) > 1)
    return (
        dates.withColumn("starts", starts.cast("int"))
        .withColumn("run", F.sum("starts").over(w))
        .groupBy(ELEMENT, "run")
        .agg(F.min("date").alias("start"), F.max("date").alias("end"))
        .select(ELEMENT, "start", "end")
    )


def nullity_correlation(wide: DataFrame, elements: Sequence[str]) -> DataFrame:
    """Pearson correlation of "is null" between the element columns of ``wide``.

    Columns that are always or never null are left out.
    """
    if len(elements) < 2:
        return wide.sparkSession.createDataFrame(
            [], "left_element string, right_element string, correlation double")
    # Cells with the same set of absent elements are counted first; pairs are then made
    # inside each set, so nothing in the plan grows with the square of the elements.
    gone = F.array_compact(F.array(*[
        F.when(F.col(f"`{e}`").isNull(), F.lit(i)) for i, e in enumerate(elements)
    ]))
    sets = wide.groupBy(gone.alias("gone")).agg(F.count(F.lit(1)).alias("n"))
    total = sets.agg(F.sum("n")).scalar()
    single = sets.select(F.explode("gone").alias("i"), "n").groupBy("i").agg(
        F.sum("n").alias("lost"))
    both = sets.select("gone", "n", F.explode("gone").alias("i")).select(
        "i", F.explode(F.filter("gone", lambda j: j > F.col("i"))).alias("j"), "n"
    ).groupBy("i", "j").agg(F.sum("n").alias("together"))
    names = F.array(*[F.lit(e) for e in elements])
    numbers = F.sequence(F.lit(0), F.lit(len(elements) - 1))
    left = single.select(F.col("i"), F.col("lost").alias("lost_i"))
    right = single.select(F.col("i").alias("j"), F.col("lost").alias("lost_j"))
    pairs = left.withColumn("j", F.explode(F.filter(numbers, lambda j: j > F.col("i"))))
    joined = pairs.join(right, "j").join(both, ["i", "j"], "left")
    n, a, b = total.cast("double"), F.col("lost_i"), F.col("lost_j")
    shared = F.coalesce("together", F.lit(0)) * n - a * b
    spread = F.sqrt(a * (n - a) * b * (n - b))
    return joined.where((a < n) & (b < n)).select(
        names[F.col("i")].alias("left_element"), names[F.col("j")].alias("right_element"),
        (shared / spread).alias("correlation"),
    )
