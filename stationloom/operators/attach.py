"""Joining per-group results back onto rows.

Adaptive execution broadcasts a small result by its measured size and splits the rows
of a huge group, so a plain join is all that is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def null_safe_equal(left: DataFrame, right: DataFrame,
                    pairs: Sequence[tuple[str, str]]) -> Column:
    """AND of ``<=>`` over pairs of column names; stays an equi-join for Spark."""
    condition = None
    for a, b in pairs:
        term = left[a].eqNullSafe(right[b])
        condition = term if condition is None else condition & term
    return condition


def attach(rows: DataFrame, stats: DataFrame, keys: Sequence[str],
           columns: Sequence[str], *, how: str = "left") -> DataFrame:
    """Add ``columns`` of ``stats`` (one row per ``keys``) to ``rows``; keys compare null-safe."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    kept = [c for c in rows.columns if c not in columns]
    wanted = stats.select(
        *[stats[k].alias(f"__their_{k}") for k in keys],
        *[stats[c].alias(f"__new_{c}") for c in columns],
    )
    joined = rows.join(
        wanted, null_safe_equal(rows, wanted, [(k, f"__their_{k}") for k in keys]), how
    )
    return joined.select(*kept, *[joined[f"__new_{c}"].alias(c) for c in columns])
