"""Shared plumbing: durable intermediate tables and column helpers."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.runtime import ship

#: Bytes of a record batch that a worker reads at once.
SLICE = 4 << 20
#: ASCII white space as the word rules of this package see it.
SPACE = r"\x20\x09-\x0D"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is read from ``spark.checkpoint.dir``; only where that is unset in a session of one
    machine (tests, a laptop) does this set a folder of its own. A cluster without it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gleaner-"))
        current = spark._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


def batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """mapInArrow with this package at hand on the executors.

    ``run`` maps an iterator of record batches; Arrow keeps 64-bit ids exact beside nulls.
    Batches are held to about ``SLICE`` bytes in the session, whose default of 64 MB would be
    held several times over by JVM and worker; where a session's batches are larger all the
    same, they are read in slices.
    """
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE))

    def sliced(frames):
        for frame in frames:
            step = max(1, frame.num_rows * SLICE // max(frame.nbytes, 1))
            for i in range(0, frame.num_rows, step):
                yield frame.slice(i, step)

    def task(frames):
        yield from run(sliced(frames))
        give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Return what a finished task has freed to the machine; workers live on and would keep it beside the next stage's JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    This cuts lineage as a checkpoint does, but plans after it see the true size; a
    checkpoint keeps the estimate, which a loop of joins squares in every round.
    """
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for the rows no label may be learned from: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled (doc_id, text, label) rows outside the held-out fold.

    The choice is by a hash of the id, so it is the same on every run. The chosen ids
    are at most ``rows``, so broadcasting them is bounded whatever the corpus holds. Of rows
    that share an id the one of the least text is taken.
    """
    picked = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(target).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return text.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def spread_join(rows: DataFrame, small: DataFrame, on: list[str], by: Column, parts: int = 16, how: str = "inner") -> DataFrame:
    """rows joined with a far smaller table on keys of which one may hold a large share of rows.

    Rows of a key are dealt over ``parts`` tasks by ``by``; the small side, unique in its
    keys, is repeated for each. Repeats compress well, so adaptive execution would take them
    for small enough to broadcast when they aren't; hence the hint.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(parts)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


#: Most keys that are broadcast to filter a wide table: 64-bit keys, some 70 bytes each when hashed.
FEW = 500_000


def matching(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi", few: int = FEW) -> DataFrame:
    """rows joined with ``keys``, unique in ``on``, without shuffling rows where the keys are few.

    The keys are counted first; beyond ``few`` both sides are shuffled.
    """
    keys = table(keys)
    return rows.join(F.broadcast(keys) if keys.limit(few + 1).count() <= few else keys, on, how)


def dealt_join(rows: DataFrame, wide: DataFrame, key: str, by: Column, most: int = 1000) -> DataFrame:
    """Inner join of narrow ``rows``, in which one key may be very frequent, with ``wide``, unique in ``key``.

    Only wide rows whose key is frequent are repeated, once for every ``most`` rows, and the
    rows of that key are dealt over the repeats by ``by``.
    """
    hot = table(rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / most).alias("_deals")).where("_deals > 1"))
    deals = F.coalesce("_deals", F.lit(1).cast("long"))
    dealt = spread_join(rows, hot, [key], by, how="left").withColumn("_deal", F.pmod(F.xxhash64(by), deals)).drop("_deals")
    copies = wide.join(hot, key, "left").withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), deals - 1))).drop("_deals")
    return dealt.join(copies, [key, "_deal"]).drop("_deal")
