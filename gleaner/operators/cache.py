"""Materialised results that end with the table they were made from, or with their time."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.operators.state import VersionedTable

HOUR_MS = 3_600_000


class Cache:
    """Results under ``path``, a folder each, named by the version of the source table and the time they were made.

    Only folders that Spark's writer has marked complete count. A result is fresh while its table
    has the same version and it is younger than its time to live; else it is made again. Old
    folders stay for readers that still have them open, until ``drop`` takes them.
    """

    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], float] = time.time):
        self.spark, self.path, self.clock = spark, path.rstrip("/"), clock

    def _entries(self, name: str) -> list[tuple[int, int, str]]:
        """(made, version, folder) of all complete results of a name, the newest last."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/v*-*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        folders = [s.getPath().getParent() for s in found or ()]
        parts = [(f.getName()[1:].split("-"), f.toString()) for f in folders]
        return sorted((int(made), int(version), folder) for (version, made), folder in parts)

    def _now(self) -> int:
        return int(self.clock() * 1000)

    def fresh(self, name: str, version: int, hours: float) -> DataFrame | None:
        for made, own, folder in reversed(self._entries(name)):
            if own == version and self._now() - made < hours * HOUR_MS:
                return self.spark.read.parquet(folder)
        return None

    def put(self, name: str, df: DataFrame, version: int = 0) -> DataFrame:
        """Store a result, such as a payload that was pushed, and read it back."""
        folder = f"{self.path}/{name}/v{version}-{self._now()}"
        df.write.mode("overwrite").parquet(folder)
        return self.spark.read.parquet(folder)

    def get(self, name: str, table: VersionedTable, build: Callable[[DataFrame], DataFrame], hours: float = 12) -> DataFrame:
        """``build`` of the table's current version, made only if there is no fresh result of it."""
        version = table.version()
        found = self.fresh(name, version, hours)
        return self.put(name, build(table.read()), version) if found is None else found

    def pushed(self, name: str, hours: float = 48) -> DataFrame | None:
        """The newest result that was put, if it is younger than ``hours``."""
        entries = self._entries(name)
        return self.spark.read.parquet(entries[-1][2]) if entries and self._now() - entries[-1][0] < hours * HOUR_MS else None

    def drop(self, name: str) -> None:
        """Forget all results of a name."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
