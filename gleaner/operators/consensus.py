"""Reliability-weighted voting over observations of a record's fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import config as C
from gleaner.functions.text import missing

OVERRIDE = 0.65


def prior(source: Column) -> Column:
    """Reliability of a source, by a literal map."""
    table = F.create_map(*[F.lit(x) for pair in C.SOURCE_PRIORS.items() for x in pair])
    return F.coalesce(table[source], F.lit(C.DEFAULT_PRIOR))


def observations(df: DataFrame, key: str, fields: tuple[str, ...] = C.PROVENANCE_FIELDS, source: str = "source_name") -> DataFrame:
    """(key, field, seq, source, value, confidence), a row for each field that says something."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), missing(F.col(f).cast("string")).alias("value")) for f in fields])
    return (
        df.select(key, F.col(source).alias("source"), F.posexplode(pairs).alias("seq", "o"))
        .select(key, F.col("o.field").alias("field"), "seq", "source", F.col("o.value").alias("value"), prior(F.col("source")).alias("confidence"))
        .where(F.col("value").isNotNull())
    )


def vote(obs: DataFrame, key: str, order: dict[str, int] = C.RESTRICTIVENESS) -> DataFrame:
    """(key, field, value, confidence, sources): most weight wins, ties to the more restrictive, then the earlier."""
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    per_value = (
        obs.where(missing(F.col("value")).isNotNull()).groupBy(key, "field", "value")
        .agg(F.sum("confidence").alias("w"), F.min("seq").alias("first"), F.sort_array(F.collect_list(F.struct("seq", "source"))).alias("by"))
    )
    by_weight = Window.partitionBy(key, "field")
    return (
        per_value.withColumn("total", F.sum("w").over(by_weight))
        .withColumn("rn", F.row_number().over(by_weight.orderBy(F.desc("w"), F.coalesce(rank[F.col("value")], F.lit(3)), "first", "value")))
        .where("rn = 1")
        .select(key, "field", "value", (F.col("w") / F.col("total")).alias("confidence"), F.transform("by", lambda b: b["source"]).alias("sources"))
    )


def applied(current: Column, value: Column, confidence: Column, least: float = OVERRIDE) -> Column:
    """struct<value, outcome>: tied where equal, override from ``least`` on, else below_threshold."""
    return (
        F.when(value.isNull(), F.struct(current.alias("value"), F.lit("none").alias("outcome")))
        .when(current.eqNullSafe(value), F.struct(current.alias("value"), F.lit("tied").alias("outcome")))
        .when(confidence >= least, F.struct(value.alias("value"), F.lit("override").alias("outcome")))
        .otherwise(F.struct(current.alias("value"), F.lit("below_threshold").alias("outcome")))
    )


def outcome_tallies(outcomes: DataFrame) -> DataFrame:
    """One row over ``outcomes(outcome)``: how many votes overrode, tied, fell short, or said nothing."""
    return outcomes.agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("override", "tied", "below_threshold", "none")], F.count(F.lit(1)).alias("total"))


def badge(confidence: Column) -> Column:
    return F.when(confidence == "confirmed", "✓").when(confidence == "inferred", "~").when(confidence == "aggregator_only", "?").otherwise("")


def tooltip(values: Column, agreeing: Column) -> Column:
    return F.when(agreeing >= 2, F.concat_ws(" | ", values))
