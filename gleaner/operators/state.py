"""Keyed state in Parquet: merges, versions, retry queue, negative cache."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def collapsed(source: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the last non-null of each column in order."""
    values = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in source.columns if c not in (key, order)]
    return source.groupBy(key).agg(*values)


def merge(target: DataFrame, source: DataFrame, key: str, as_of: Column, rules: dict[str, Callable] | None = None) -> DataFrame:
    """The table after an upsert of ``source``, one row per key on either side.

    A value of the source replaces the stored one unless it is null. first_seen_date never
    changes once there, last_seen_date is the day on a match, date_posted keeps the earliest,
    a row seen again is active and no longer archived. ``rules`` override by column:
    (target value, source value, matched) -> value. ``is_brand_new`` marks new keys.
    """
    rules = {
        "last_seen_date": lambda t, s, m: F.when(m, as_of).otherwise(t),
        "first_seen_date": lambda t, s, m: F.coalesce(t, as_of),
        "date_posted": lambda t, s, m: F.least(t, s),
        "is_active": lambda t, s, m: F.when(m, F.coalesce(s, F.lit(1))).otherwise(t),
        "lifecycle_status": lambda t, s, m: F.when(m, F.lit("active")).otherwise(t),
        "archived_date": lambda t, s, m: F.when(~m, t),
        "days_active": lambda t, s, m: F.when(~m, t),
    } | (rules or {})
    columns = list(dict.fromkeys([*target.columns, *source.columns]))
    t = target.select(F.col(key).alias("_tk"), F.struct(*[F.col(c) for c in target.columns]).alias("t"))
    s = source.select(F.col(key).alias("_sk"), F.struct(*[F.col(c) for c in source.columns]).alias("s"))
    both = t.join(s, F.col("_tk") == F.col("_sk"), "full_outer")
    matched = F.col("_sk").isNotNull()
    out = [F.coalesce("_tk", "_sk").alias(key)]
    for c in columns:
        if c == key:
            continue
        old = F.col("t").getField(c) if c in target.columns else F.lit(None)
        new = F.col("s").getField(c) if c in source.columns else F.lit(None)
        out.append((rules[c](old, new, matched) if c in rules else F.coalesce(new, old)).alias(c))
    return both.select(*out, F.col("_tk").isNull().alias("is_brand_new"))


def transitions(old: DataFrame, new: DataFrame, key: str, status: str) -> DataFrame:
    """(key, old, new) of the keys whose status changed; an unknown verdict changes nothing."""
    a = old.select(key, F.col(status).alias("old"))
    b = new.select(key, F.col(status).alias("new"))
    return a.join(b, key).where((F.col("new") != F.col("old")) & (F.col("new") != "unknown"))


def uncached(slugs: DataFrame, status: DataFrame, keys: list[str], as_of: Column, ttl: int = 30) -> DataFrame:
    """The slugs not known to be missing within the last ``ttl`` days."""
    fresh = status.where((F.col("status") == "not_found") & (F.datediff(as_of, F.col("last_checked")) < ttl))
    return slugs.join(fresh.select(*keys), keys, "left_anti")


def retried(queue: DataFrame, outcomes: DataFrame, key: str = "external_id", most: int = 3) -> DataFrame:
    """The queue after a replay: successes leave, failures count up and leave at ``most`` attempts."""
    seen = outcomes.select(key, F.col("ok").alias("_ok"))
    joined = queue.join(seen, key, "left").where(~F.coalesce("_ok", F.lit(False)))
    return joined.withColumn("attempts", F.col("attempts") + F.when(F.col("_ok").isNotNull(), 1).otherwise(0)).drop("_ok").where(F.col("attempts") < most)


def enqueued(queue: DataFrame, failed: DataFrame, key: str = "external_id") -> DataFrame:
    """The queue with new failures at attempt 0; keys already waiting stay as they are."""
    new = failed.join(queue.select(key), key, "left_anti").select(
        key, F.to_json(F.struct(*[F.col(c) for c in failed.columns])).alias("job_json"), F.lit(0).alias("attempts"))
    return queue.unionByName(new, allowMissingColumns=True)


def keep_first(df: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """Keyed distinct: the first row of each key in order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def assigned(table: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The table with ``columns`` of the rows that ``values`` names replaced; null and empty values change nothing."""
    new = values.select(key, F.struct(*[F.col(c).alias(c) for c in columns]).alias("_new"))
    out = table.join(new, key, "left")
    for c in columns:
        value = F.col("_new").getField(c)
        out = out.withColumn(c, F.when(value.isNotNull() & (value.cast("string") != ""), value).otherwise(F.col(c)))
    return out.select(*table.columns)


def pushed(table: DataFrame, keys: DataFrame, key: str = "external_id", columns: tuple[str, ...] = ("wp_post_id", "lifecycle_status", "last_lifecycle_verdict", "last_seen_date")) -> DataFrame:
    """The narrow payload of the rows with the given keys."""
    return table.join(keys.select(key).distinct(), key, "left_semi").select(key, *columns)


def slug_status(table: DataFrame, scans: DataFrame, as_of: Column, order: str = "checked_at") -> DataFrame:
    """The slug table after scans(ats, slug, status, jobs_found, checked_at): one row a slug, as its latest scan has it.

    Scans of the same time go by jobs found, null as none, then by status, so the result doesn't depend
    on the order of rows. Without a column ``order`` all scans are of one time.
    """
    at = F.col(order) if order in scans.columns else F.lit(0)
    new = scans.groupBy("ats", "slug").agg(F.max(F.struct(at.alias("at"), F.coalesce("jobs_found", F.lit(0)).alias("n"), "status", "jobs_found")).alias("_s"))
    new = new.select("ats", "slug", "_s.status", "_s.jobs_found")
    new = new.withColumn("last_checked", as_of.cast("date"))
    return table.join(new, ["ats", "slug"], "left_anti").unionByName(new.select(*table.columns))


def logged(log: DataFrame, run_ts: Column, by_source: DataFrame, published: int, errors: list[str], seconds: float) -> DataFrame:
    """The run log with one more run, its counts by source as a map."""
    counts = by_source.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("source_name", "n")))).alias("source_counts"))
    run = counts.select(
        run_ts.alias("run_ts"), "source_counts", F.lit(published).cast("long").alias("published"),
        F.lit(errors).cast("array<string>").alias("errors") if errors else F.array().cast("array<string>").alias("errors"), F.lit(float(seconds)).alias("duration_seconds"))
    return log.unionByName(run.select(*log.columns))


class VersionedTable:
    """A Parquet table whose versions are whole folders; the newest complete one is current.

    A version counts once Spark's writer has marked its folder complete, so a reader or a
    failed job never sees half of one, and there is no pointer that could be lost between two
    steps. A half-written folder is overwritten by the next write. Paths go through Hadoop's
    file system, so any store that Spark reads will do. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> int:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v*/_SUCCESS")
        done = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return max((int(s.getPath().getParent().getName()[1:]) for s in done or ()), default=0)

    def read(self) -> DataFrame | None:
        v = self.version()
        return self.spark.read.parquet(f"{self.path}/v{v}") if v else None

    def write(self, df: DataFrame) -> int:
        v = self.version() + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{v}")
        return v


def write_snapshot(stats: DataFrame, path: str) -> None:
    """Replace exactly the days that ``stats`` has, each as a whole."""
    stats.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stat_date").parquet(path)
