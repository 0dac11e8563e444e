"""Queries over the test tables, each with an independent SQL counterpart."""

from checks.registry import ORACLES, QUERIES  # noqa: F401
from checks import (  # noqa: F401
    basic_queries,
    missing_queries,
    outlier_queries,
    predict_queries,
    series_queries,
    source_queries,
    stats_queries,
    stored_queries,
)
