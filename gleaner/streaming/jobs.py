"""Event-time and stateful variants over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def events(spark: SparkSession, folder: str, name: str = "events.parquet", late: str = "1 hour") -> DataFrame:
    """The events table of a folder as a stream with a watermark."""
    read = spark.readStream.schema(EVENTS).option("pathGlobFilter", f"{name.removesuffix('.parquet')}*.parquet").option("recursiveFileLookup", True).parquet(folder)
    return read.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def tumbling(df: DataFrame, width: str = "1 day") -> DataFrame:
    """Counts and sums by window and type."""
    return df.groupBy(F.window("ts", width).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")
    ).select(F.col("w.start").alias("day"), "event_type", "n", "total")


def sessions(df: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of each user: a gap ends one."""
    return df.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select(
        "user_id", F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")


def deduplicated(df: DataFrame, key: str = "event_id") -> DataFrame:
    """First arrivals of each key within the watermark."""
    return df.dropDuplicatesWithinWatermark([key])


def drained(df: DataFrame, checkpoint: str, out: str, mode: str = "append") -> None:
    """Run the stream over all that is there, exactly once, into Parquet."""
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start().awaitTermination()


def drained_batches(df: DataFrame, checkpoint: str, apply, mode: str = "update") -> None:
    """Run the stream over all that is there, each micro-batch through ``apply(frame, id)``."""
    df.writeStream.foreachBatch(apply).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def breaker_state(trip: int = 5):
    """A function for applyInPandasWithState: consecutive failures per key, reset by success."""
    import pandas as pd

    def run(key, frames, state):
        fails = state.get[0] if state.exists else 0
        for frame in frames:
            for failed in frame.sort_values(["ts", "event_id"]).failed:
                fails = fails + 1 if failed else 0
        state.update((fails,))
        yield pd.DataFrame({"user_id": [key[0]], "fails": [fails], "open": [fails >= trip]})

    return run


def breakers(df: DataFrame, trip: int = 5) -> DataFrame:
    """Breaker state per user after each micro-batch."""
    return df.withColumn("failed", F.col("event_type") == "error").groupBy("user_id").applyInPandasWithState(
        breaker_state(trip), "user_id long, fails int, open boolean", "fails int", "update", "NoTimeout")
