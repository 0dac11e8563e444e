"""Secret scans with multipart credential linking, in DataFrame expressions alone.

Strong patterns are always reported. Weak parts — an identifier such as a user name, an
opaque token, an endpoint — say little alone. They are reported only where
complementary parts stand within one scope of each other: intervals of text are
joined on pieces of the document as wide as the scope, and on their distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B

#: Code points between parts of one credential at most.
SCOPE = 200

# Patterns of the strong kinds, the group that has to be long enough, and its least length.
STRONG = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
#: Weak parts: an identifier with its name, a token mixing cases and digits, an address.
WEAK = [
    ("ident", r"(?i:\b(?:user(?:name)?|login|account|client_?id|access_?key_?id))\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}"),
    ("opaque", r"(?<![A-Za-z0-9+/_-])(?=[a-zA-Z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[A-Za-z0-9+/_-]{20,}={0,2}"),
    ("endpoint", r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?[A-Za-z0-9_./?&=%-]*|(?i:\b(?:host|endpoint|server))\x20*[:=]\x20*[A-Za-z0-9.-]{4,}"),
]
KINDS = [k for k, *_ in STRONG] + [k for k, _ in WEAK]
#: Parts that complete a weak part.
COMPLEMENTS = {"ident": ["assign", "hex", "opaque"], "opaque": ["access", "ident", "endpoint"], "endpoint": ["assign", "hex", "opaque"]}
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches of a pattern in code points: what lies between them gives their places."""
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.array(F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end")))
        long = F.coalesce(F.length(x["part"]) >= least, F.lit(False))
        return F.struct(end.alias("at"), F.when(long, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    walked = F.aggregate(found, start, step, lambda state: state["spans"])
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(_SPAN))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _linked(rows: DataFrame, scope: int) -> DataFrame:
    """``doc_id, mark, linked``: the weak spans that have a complement within the scope."""
    def has(kinds: list[str]) -> Column:
        return F.exists("parts", lambda s: s["kind"].isin([KINDS.index(k) for k in kinds]))

    some = F.lit(False)
    for weak, others in COMPLEMENTS.items():
        some = some | (has([weak]) & has(others))
    flat = rows.filter(some).select("doc_id", "mark", F.explode(F.array_distinct("parts")).alias("s")).select("doc_id", "mark", "s.*").distinct()
    weak = F.lit(False)
    for k in COMPLEMENTS:
        weak = weak | (F.col("kind") == KINDS.index(k))
    asking = flat.filter(weak).withColumn("piece", F.explode(F.sequence(
        F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))))
    pieces = F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))
    others = flat.withColumn("piece", F.explode(pieces)).select(*[F.col(c).alias(f"o_{c}") for c in ("doc_id", "mark", "piece", "start", "kind", "end")])
    fit = F.lit(False)
    for k, kinds in COMPLEMENTS.items():
        fit = fit | ((F.col("kind") == KINDS.index(k)) & F.col("o_kind").isin([KINDS.index(x) for x in kinds]))
    near = (F.col("o_start") - F.col("end") <= scope) & (F.col("start") - F.col("o_end") <= scope)
    apart = (F.col("o_start") >= F.col("end")) | (F.col("start") >= F.col("o_end"))  # a part does not complete itself
    same = F.col("doc_id").eqNullSafe(F.col("o_doc_id")) & (F.col("mark") == F.col("o_mark")) & (F.col("piece") == F.col("o_piece"))
    joined = asking.join(others, same & fit & near & apart, "left_semi")
    return (joined.select("doc_id", "mark", F.struct("start", "kind", "end").alias("s")).distinct()
            .groupBy("doc_id", "mark").agg(F.collect_list("s").alias("linked")))


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, base, spans`` of every row: strong spans, and these with the linked weak ones.

    A span is ``start, kind, end`` in code points, ``end`` exclusive, ``kind`` an index of :data:`KINDS`; spans are in
    order of ``start``, then ``kind``. A null or empty text has none. Repeated rows get the same spans each; other
    columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text, F.length(text)).alias("mark"),
                       F.array_sort(F.concat(*[_spans(text, *k) for k in STRONG])).alias("base"),
                       F.concat(*[_spans(text, k, p, 0, 1) for k, p in WEAK]).alias("weak"))
    rows = B.checkpointed(rows)
    linked = _linked(rows.select("doc_id", "mark", F.concat("base", "weak").alias("parts")), scope)
    linked = linked.select(F.col("doc_id").alias("l_doc_id"), F.col("mark").alias("l_mark"), "linked")
    both = rows.join(linked, F.col("doc_id").eqNullSafe(F.col("l_doc_id")) & (F.col("mark") == F.col("l_mark")), "left")
    return both.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPAN)))).alias("spans"))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def write_spans(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return _written(spans)
