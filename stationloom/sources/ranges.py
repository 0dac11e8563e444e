"""Large observation documents read by many tasks.

A document is cut at every opening brace, which the text source does by byte ranges, so
one file of any size is read by as many tasks as it has ranges. What a piece means depends
on what came before: whether it begins inside a string, and how deep. Both compose. A
piece is a pair of effects, one for each state it may begin in; pieces are added up inside
a range, ranges inside a file, and the state at the start of a range then settles all its
pieces. Entries of ``data`` are the objects at depth one of that array; each is put
together from its own pieces and parsed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationloom.plans.materialise import materialise
from stationloom.schema import DOCUMENT_SCHEMA

_ENTRY = DOCUMENT_SCHEMA["data"].dataType.elementType
_RANGE = ["file", "range"]


def _closing(text: Column) -> Column:
    """Closing braces of a text that begins outside a string, those in strings left out."""
    plain = F.regexp_replace(text, '"[^"]*("|$)', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit("}"), F.lit("")))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Texts between opening braces: how they change depth from outside (0) and inside (1) a string, and how they end.

    ``ends`` is ``D`` where the array ``data`` opens, ``S`` where an array or object goes on, else ``O``.
    """
    raw = spark.read.option("lineSep", "{").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    # an escape never passes a brace, so pieces hold whole escapes
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    inside = F.regexp_replace(bare, '^[^"]*("|$)', "")
    first = (F.col("range") == 0) & F.col("before").isNull()
    ends = (F.when(F.col("text").rlike(r'(?<!\\)"data"\s*:\s*\[\s*$'), "D")
            .when(F.col("text").rlike(r",\s*$"), "S").otherwise("O"))
    order = Window.partitionBy(*_RANGE).orderBy("at")
    return raw.withColumn("before", F.lag("at").over(order)).select(
        *_RANGE, "at", "text", ends.alias("ends"), first.alias("is_first"),
        (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))).alias("quotes"),
        (F.when(first, 0).otherwise(1) - _closing(bare)).alias("out"), (-_closing(inside)).alias("in"))


def _added_up(pieces: DataFrame) -> DataFrame:
    """Pieces with what happens in their range before them: ``odd`` quotes, and depth from either state (``d0, d1``)."""
    earlier = Window.partitionBy(*_RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    with_state = pieces.withColumn("odd", odd).withColumns({
        "e0": F.when(F.col("odd") == 0, F.col("out")).otherwise(F.col("in")),
        "e1": F.when(F.col("odd") == 0, F.col("in")).otherwise(F.col("out"))})
    return with_state.withColumns({
        "d0": F.coalesce(F.sum("e0").over(earlier), F.lit(0)), "d1": F.coalesce(F.sum("e1").over(earlier), F.lit(0)),
        "prior": F.lag("ends").over(Window.partitionBy(*_RANGE).orderBy("at"))})


def _range_starts(added: DataFrame) -> DataFrame:
    """State of each range at its start and end, from the effects of all ranges of the file before it."""
    effects = added.groupBy(*_RANGE).agg(
        F.sum("quotes").alias("quotes"), F.sum("e0").alias("e0"), F.sum("e1").alias("e1"), F.max_by("ends", "at").alias("ends"))
    ranges = Window.partitionBy("file").orderBy("range")
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    state = effects.withColumn("begin_in", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    state = state.withColumn("change", F.when(F.col("begin_in") == 0, F.col("e0")).otherwise(F.col("e1")))
    return state.select(
        *_RANGE, "begin_in", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("begin_depth"),
        F.lag("ends").over(ranges).alias("begin_ends"),
        ((F.col("begin_in") + F.col("quotes")) % 2).alias("end_in"), F.sum("change").over(ranges).alias("end_depth"))


def _placed(added: DataFrame, starts: DataFrame) -> DataFrame:
    """Pieces with ``start``: the place where an entry begins here, and ``turn``: the kind of array it opens, if it opens one."""
    depth = F.col("begin_depth") + F.when(F.col("begin_in") == 0, F.col("d0")).otherwise(F.col("d1"))
    outside = (F.col("begin_in") + F.col("odd")) % 2 == 0
    kind = F.coalesce("prior", "begin_ends")
    begins = outside & (depth == 1) & ~F.col("is_first")
    return added.join(starts, _RANGE).select(
        *_RANGE, "at", "text", F.when(begins, F.struct("range", "at")).alias("start"),
        F.when(begins & (kind != "S"), kind).alias("turn"))


def _entries(placed: DataFrame) -> DataFrame:
    """``file, text`` of the entries of ``data``; a text may go on after its closing brace."""
    last = placed.groupBy(*_RANGE).agg(
        F.max("start").alias("start"), F.max_by("turn", F.when(F.col("turn").isNotNull(), F.col("at"))).alias("turn"))
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*_RANGE, F.last("start", True).over(earlier).alias("carried_start"),
                          F.last("turn", True).over(earlier).alias("carried_turn"))
    so_far = Window.partitionBy(*_RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = placed.withColumns({"own_start": F.last("start", True).over(so_far), "own_turn": F.last("turn", True).over(so_far)})
    owned = owned.join(carried, _RANGE).select(
        "file", F.coalesce("own_start", "carried_start").alias("entry"), F.coalesce("own_turn", "carried_turn").alias("turn"),
        F.struct("range", "at", "text").alias("piece"))
    grouped = owned.where((F.col("turn") == "D") & F.col("entry").isNotNull()).groupBy("file", "entry").agg(
        F.sort_array(F.collect_list("piece")).alias("pieces"))
    return grouped.select("file", F.concat(F.lit("{"), F.array_join("pieces.text", "{")).alias("text"))


def read_large_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Observation documents as ``data`` arrays of one entry each, in no order; files are read by byte ranges.

    Gives the entries that the multi-line reader gives, for files of any size and documents in any layout; the size of
    a range is ``spark.sql.files.maxPartitionBytes``. Files are UTF-8 and hold whole documents. Invalid entries, files
    whose braces or quotes do not close, and files without entries fail the query that reads them; a file of no bytes
    has no rows. An entry is put together in one task; it is one instant of one station. The pieces are written to the
    shared folder here, in one pass over the files; further passes read only what they need.
    """
    added = materialise(_added_up(_pieces(spark, path)))
    starts = materialise(_range_starts(added))
    placed = _placed(added, starts)
    entries = _entries(placed)
    parsed = entries.select(F.from_json("text", _ENTRY, {"mode": "FAILFAST"}).alias("entry"))
    final = starts.groupBy("file").agg(F.max_by(F.struct("end_in", "end_depth"), "range").alias("end"))
    known = placed.groupBy("file").agg(F.coalesce(F.bool_or(F.col("turn") == "D"), F.lit(False)).alias("has_data"))
    bad = (F.col("end.end_in") != 0) | (F.col("end.end_depth") != 0) | ~F.col("has_data")
    problem = F.raise_error(F.concat(F.lit("not a whole document with 'data': "), F.col("file")))
    # the condition stays in the expression, whatever filters are pushed below it
    failing = final.join(known, "file").select(F.when(bad, problem).cast(DOCUMENT_SCHEMA["data"].dataType).alias("data"))
    return parsed.select(F.array("entry").alias("data")).unionByName(failing.where(F.col("data").isNotNull()))
