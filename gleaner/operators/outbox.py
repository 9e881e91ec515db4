"""Sending rows in numbered batches that are written before they go out, so that no run sends one twice.

A run has a folder: ``batches`` holds its rows with their numbers, ``intents`` the batches that a
wave is about to send, ``answers`` what came back. Each is written as a whole or not at all. A
batch with an intent and no answer belongs to a wave that broke off: whether it arrived is
not known, so it isn't sent again but put into the retry queue with the failed ones. Every
call carries the run and the batch number, by which a receiver can tell a repeated task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.aggregates import chunked
from gleaner.operators.state import assigned, enqueued, retried
from gleaner.runtime import ship

SIZE, WAVE = 20, 1000
#: Answers that a task puts out at a time.
FRAME = 2000
_ANSWERS = "batch long, {key} string, ok boolean, post_id long, error string"


def _whole(frames: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """(number, rows) of every batch in frames that are sorted by it, also of those that lie across frames."""
    number, rows = None, []
    for frame in frames:
        for row in frame.to_pylist():
            if row["batch"] != number and rows:
                yield number, rows
                rows = []
            number = row.pop("batch")
            rows.append(row)
    if rows:
        yield number, rows


class Outbox:
    """The runs under ``path``. ``key`` is the column that rows are told by and answers name."""

    def __init__(self, spark: SparkSession, path: str, key: str = "external_id"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _done(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _waves(self, run: str, kind: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{run}/{kind}/wave=*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return [s.getPath().getParent().toString() for s in found or ()]

    def _read(self, run: str, kind: str, schema: str) -> DataFrame:
        waves = self._waves(run, kind)
        return self.spark.read.schema(schema).parquet(*waves) if waves else self.spark.createDataFrame([], schema)

    def prepare(self, run: str, rows: DataFrame, order: list[str], size: int = SIZE) -> DataFrame:
        """The run's rows with their batch number; those that a former call of the same run wrote, if there are any.

        Of rows that share a key the first in order goes out. Null keys are not sent. Files hold
        ranges of batches in order, so that a wave reads little else than its own rows.
        """
        folder = f"{self.path}/{run}/batches"
        if not self._done(folder):
            first = rows.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("r")).select("r.*")
            chunked(first, order, size).repartitionByRange("batch").sortWithinPartitions("batch").write.mode("overwrite").parquet(folder)
        return self.spark.read.parquet(folder)

    def send(self, run: str, send: Callable[[str, int, list[dict]], Iterable[dict]], wave: int = WAVE) -> DataFrame:
        """Send what the run has not tried yet, ``wave`` batches at a time; (batch, key, ok, post_id, error) of all that is answered.

        ``send`` gets run, batch number and rows, and gives the accepted keys with their post ids;
        a batch for which it raises OSError or ValueError fails as a whole.
        """
        key, schema = self.key, _ANSWERS.format(key=self.key)
        batches = self.spark.read.parquet(f"{self.path}/{run}/batches")
        tasks = self.spark.sparkContext.defaultParallelism
        ship(self.spark)

        def one(number: int, rows: list[dict]) -> list[dict]:
            keys, got, why = [str(r[key]) for r in rows], {}, None
            try:
                got = {str(r[key]): r.get("post_id") for r in send(run, number, rows)}
            except (OSError, ValueError) as error:
                why = f"{type(error).__name__}: {error}"[:500]
            return [{"batch": number, key: k, "ok": k in got, "post_id": got.get(k), "error": why} for k in keys]

        def task(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            to = pa.schema([("batch", pa.int64()), (key, pa.string()), ("ok", pa.bool_()), ("post_id", pa.int64()), ("error", pa.string())])
            answers: list[dict] = []
            for number, rows in _whole(frames):
                answers += one(number, rows)
                if len(answers) >= FRAME:
                    yield pa.RecordBatch.from_pylist(answers, to)
                    answers = []
            yield pa.RecordBatch.from_pylist(answers, to)

        last = batches.agg(F.max("batch")).first()[0]
        for first in range(0, 0 if last is None else last + 1, wave):
            part = batches.where((F.col("batch") >= first) & (F.col("batch") < first + wave))  # numbers have no gaps
            folder = f"wave={first}"
            if self._done(f"{self.path}/{run}/intents/{folder}"):
                continue
            self.spark.range(first, min(first + wave, last + 1), 1, 1).toDF("batch").write.mode("overwrite").parquet(f"{self.path}/{run}/intents/{folder}")
            part.repartition(tasks, "batch").sortWithinPartitions("batch").mapInArrow(task, schema).write.mode("overwrite").parquet(f"{self.path}/{run}/answers/{folder}")
        return self.answers(run)

    def answers(self, run: str) -> DataFrame:
        return self._read(run, "answers", _ANSWERS.format(key=self.key))

    def outcomes(self, run: str) -> DataFrame:
        """(batch, key, ok, post_id, error) of every row that was tried; those of a wave that broke off are not ok."""
        batches = self.spark.read.parquet(f"{self.path}/{run}/batches").select("batch", F.col(self.key).cast("string").alias(self.key))
        tried = batches.join(self._read(run, "intents", "batch long"), "batch", "left_semi")
        return tried.join(self.answers(run), ["batch", self.key], "left").select(
            "batch", self.key, F.coalesce("ok", F.lit(False)).alias("ok"), "post_id", F.when(F.col("ok").isNull(), "broke off").otherwise(F.col("error")).alias("error"))

    def written_back(self, run: str, table: DataFrame, column: str = "wp_post_id") -> DataFrame:
        """The stored table with the ids that the receiver gave."""
        given = self.answers(run).where("ok and post_id is not null").select(self.key, F.col("post_id").alias(column))
        return assigned(table, given, self.key, [column])

    def queued(self, run: str, queue: DataFrame) -> DataFrame:
        """The retry queue with the whole rows that failed or are in doubt."""
        rows = self.spark.read.parquet(f"{self.path}/{run}/batches").drop("batch")
        failed = self.outcomes(run).where("not ok").select(self.key)
        return enqueued(queue, rows.withColumn(self.key, F.col(self.key).cast("string")).join(failed, self.key, "left_semi"), self.key)

    def replayed(self, run: str, queue: DataFrame, most: int = 3) -> DataFrame:
        """The queue after a run that sent it again."""
        return retried(queue, self.outcomes(run).select(self.key, "ok"), self.key, most)

    def totals(self, run: str) -> DataFrame:
        """One row: batches, rows sent, accepted and failed."""
        return self.outcomes(run).agg(
            F.count_distinct("batch").alias("batches"), F.count(F.lit(1)).alias("rows"), F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("failed"))
