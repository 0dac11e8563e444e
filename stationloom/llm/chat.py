"""Chat formatting by prefix-target expansion, in DataFrame expressions alone.

Every assistant turn becomes an example: all turns before it as context, and its own
text the only part under the loss mask. A turn is written as
``<s>[INST]role[/INST]text</s>``. Inside roles and texts ``\\``, ``<`` and ``[`` get a
backslash behind them, so no control string can appear there, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def _head(role: Column) -> Column:
    return F.concat(F.lit("<s>[INST]"), escape(role), F.lit("[/INST]"))


def expand_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, example, n_examples, formatted, loss_start, loss_end`` of every assistant turn.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are not read. Turns go by ``turn``, missing ones
    first, and equal ones by role and text. Missing roles and texts are empty. ``loss_start`` and ``loss_end`` are code
    points of ``formatted``. Turns behind the last assistant turn, or all turns where there is none, follow in one more
    example whose mask is empty, so the last example of a conversation has all its turns. Rows without a ``conv_id``
    are one conversation. A conversation is one value and is built in one task; its examples repeat their contexts.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = turns.select("conv_id", F.transform("turns", lambda t: F.struct(
        _head(t["role"]).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("target"))).alias("written"))
    size = F.size("written")
    ends = F.filter(F.sequence(F.lit(1), size), lambda i: F.element_at("written", i)["target"] | (i == size))
    examples = (written.withColumn("ends", ends).select("conv_id", "written", F.size("ends").alias("n_examples"), F.posexplode("ends").alias("example", "last"))
                .select("conv_id", "example", "n_examples", F.slice("written", F.lit(1), F.col("last")).alias("shown")))
    own = F.element_at("shown", -1)
    parts = F.transform("shown", lambda t: F.concat(t["head"], t["body"], F.lit("</s>")))
    made = examples.select("conv_id", "example", "n_examples", F.array_join(parts, "").alias("formatted"), own["target"].alias("target"), F.length(own["body"]).alias("body"))
    stop = F.length("formatted") - len("</s>")
    return made.select("conv_id", "example", "n_examples", "formatted", F.when(F.col("target"), stop - F.col("body")).otherwise(stop).alias("loss_start"), stop.alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """Turns of a formatted example: an array of ``role, text``."""
    rows = F.filter(F.split(formatted, "</s>"), lambda t: t != "")
    return F.transform(rows, lambda t: F.struct(
        unescape(F.regexp_extract(t, r"(?s)^<s>\[INST\](.*?)\[/INST\]", 1)).alias("role"),
        unescape(F.regexp_replace(t, r"(?s)^<s>\[INST\].*?\[/INST\]", "")).alias("text")))


def masked_text(formatted: Column, loss_start: Column, loss_end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substring(formatted, loss_start + 1, loss_end - loss_start))
