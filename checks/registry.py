"""Every checked query with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def check(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL that gives the same rows."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, sf_dir: rounded(function(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 decimals, because the engines add up in different orders.

    Rounding to 12 first keeps the last bits from deciding a tie.
    """
    doubles = {
        f.name: F.round(F.round(F.col(f"`{f.name}`"), 12), DIGITS)
        for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)
    }
    return df.select(*[
        doubles[c].alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns
    ])


def r(expression: str, digits: int = DIGITS) -> str:
    """Rounded SQL expression without negative zero."""
    return f"(ROUND({expression}, {digits}) + 0.0)"


def half_up(expression: str, digits: int, noise: int = 9) -> str:
    """Half-up rounding in decimal arithmetic, after dropping summation noise."""
    return (f"CAST(CAST(CAST({expression} AS DECIMAL(30, {noise})) "
            f"AS DECIMAL(30, {digits})) AS DOUBLE)")


def with_tables(*parts: str) -> str:
    """``WITH`` clause from table expressions, last part being the query."""
    *tables, body = [p.strip() for p in parts]
    return f"WITH {', '.join(tables)} {body}"
