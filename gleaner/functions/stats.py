"""Statistics and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exclusive_quantile(values: Column, quarter: int) -> Column:
    """The quarter-th quartile of a sorted array by exclusive interpolation, whole; null under 3 values."""
    n = F.size(values)
    j = F.greatest(F.lit(1), F.least(F.floor(F.lit(quarter) * (n + 1) / 4).cast("int"), n - 1))
    d = quarter * (n + 1) - 4 * j
    at = lambda i: F.element_at(values, i.cast("int"))
    return F.when(n >= 3, ((at(j) * (4 - d) + at(j + 1) * d) / 4).cast("long"))


def clamp(c: Column, low: int = 0, high: int = 100) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def bucket(score: Column, width: int = 10) -> Column:
    return F.floor(score / width)


def days_since(posted: Column, first_seen: Column, as_of: Column) -> Column:
    """Whole days since the first of the two that is there, at least 0; null if it can't be read."""
    ref = F.coalesce(F.nullif(posted, F.lit("")), F.nullif(first_seen, F.lit("")))
    days = F.datediff(as_of, F.try_to_date(F.substring(ref, 1, 10)))
    return F.when(days.isNotNull(), F.greatest(F.lit(0), days))


def days_between(start: Column, end: Column) -> Column:
    """0 if either is missing, else at least 1."""
    return F.when(start.isNull() | end.isNull(), 0).otherwise(F.greatest(F.lit(1), F.datediff(end, start)))


def freshness(days: Column) -> Column:
    return F.when(days.isNull(), "unknown").when(days <= 3, "fresh").when(days <= 7, "recent").when(days <= 14, "aging").otherwise("old")


def freshness_label(posted: Column, first_seen: Column, as_of: Column) -> Column:
    """Text for the age of a row; that it was only seen, not posted, is said."""
    days = days_since(posted, first_seen, as_of)
    seen = F.when(F.nullif(posted, F.lit("")).isNull(), "Seen ").otherwise("")
    text = F.when(days == 0, "Today").when(days == 1, "1 day ago").otherwise(F.concat(days.cast("string"), F.lit(" days ago")))
    return F.when(days.isNull(), "Unknown").otherwise(F.concat(seen, text))


def freshness_order(days: Column) -> Column:
    """Sort key: unknown ages come last."""
    return F.coalesce(days, F.lit(99999))


def salary_order(low: Column) -> Column:
    return F.coalesce(low.cast("int"), F.lit(0))


def from_millis(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def is_monday(day: Column) -> Column:
    return F.weekday(day) == 0
