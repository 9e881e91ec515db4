"""Every named query with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.plans import composite, postings, relational, scalar  # noqa: F401  each registers its queries
from gleaner.plans.registry import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
