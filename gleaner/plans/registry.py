"""Named queries: each a function of (spark, folder) beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.runtime import ship, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its own name."""
    def add(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            small_batches(spark)
            return build(Tables(spark, folder))

        QUERIES[build.__name__] = run
        if sql:
            SQL[build.__name__] = sql
        return build
    return add


def whole_word(pattern: str) -> str:
    """The pattern with word boundaries that know letters of all scripts, for oracle SQL."""
    other = r"[^\pL\pN_]"
    if pattern.startswith(r"\b"):
        pattern = f"(^|{other}){pattern[2:]}"
    return f"{pattern[:-2]}($|{other})" if pattern.endswith(r"\b") else pattern


def case(text: str, rules, default: str) -> str:
    """CASE over regular expressions, in any case, for oracle SQL."""
    whens = " ".join(f"WHEN regexp_matches({text}, '{p}', 'i') THEN '{label}'" for p, label in rules)
    return f"CASE {whens} ELSE '{default}' END"
