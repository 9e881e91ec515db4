"""Batches that are written before they go out."""

import os

import pytest
from pyspark.sql import functions as F

from gleaner.operators.outbox import Outbox


def posted(log, failing=()):
    """A receiver that notes every call in a file of its own."""
    def send(run, batch, rows):
        path = f"{log}/{run}-{batch}"
        with open(path, "a") as f:
            f.write("x")
        if batch in failing:
            raise OSError("no answer")
        return [{"external_id": r["external_id"], "post_id": int(r["external_id"]) + 1000} for r in rows if int(r["external_id"]) % 10]
    return send


def calls(log):
    return {name: os.path.getsize(f"{log}/{name}") for name in os.listdir(log)}


def test_a_rerun_sends_nothing_twice(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    rows = spark.range(1, 96).select(F.col("id").cast("string").alias("external_id"), F.concat(F.lit("t"), "id").alias("title"), "id")
    rows = rows.unionByName(rows.limit(3)).unionByName(spark.createDataFrame([(None, "none", 0)], "external_id string, title string, id long"))
    box = Outbox(spark, f"file://{tmp_path}/box")
    batches = box.prepare("one", rows, ["id"])
    assert {r.batch: r["count"] for r in batches.groupBy("batch").count().collect()} == {0: 20, 1: 20, 2: 20, 3: 20, 4: 15}
    got = box.send("one", posted(str(log), failing={2}), wave=2)
    assert got.count() == 95 and calls(log) == {f"one-{i}": 1 for i in range(5)}
    box.prepare("one", rows.limit(1), ["id"])
    box.send("one", posted(str(log)))
    assert calls(log) == {f"one-{i}": 1 for i in range(5)}
    t = box.totals("one").first()
    assert (t.batches, t.rows, t.failed) == (5, 95, 20 + 2 + 2 + 2 + 1) and t.accepted == 95 - t.failed
    table = rows.where("external_id is not null").dropDuplicates(["external_id"]).select("external_id", F.lit(None).cast("long").alias("wp_post_id"))
    back = {r.external_id: r.wp_post_id for r in box.written_back("one", table).collect()}
    assert back["1"] == 1001 and back["10"] is None and back["45"] is None
    queue = spark.createDataFrame([("7777", "{}", 2), ("45", "{}", 1)], "external_id string, job_json string, attempts int")
    queue = box.queued("one", queue)
    assert queue.count() == 1 + t.failed and queue.where("external_id = '45' and attempts = 1").count() == 1
    # The queue goes out as a run of its own: what is accepted leaves, the rest counts up.
    box.prepare("again", queue, ["external_id"])
    box.send("again", posted(str(log)))
    left = {r.external_id: r.attempts for r in box.replayed("again", queue).collect()}
    assert left == {str(i): 1 for i in range(10, 96, 10)}


def test_a_wave_that_broke_off_is_not_sent_again(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    box = Outbox(spark, f"file://{tmp_path}/box")
    box.prepare("one", spark.range(1, 61).select(F.col("id").cast("string").alias("external_id"), "id"), ["id"])

    def breaks(run, batch, rows, inner=posted(str(log))):
        out = inner(run, batch, rows)
        if batch == 1:
            raise KeyError("a task dies")
        return out

    with pytest.raises(Exception):  # noqa: B017  whatever Spark makes of it
        box.send("one", breaks, wave=1)
    before = calls(log)
    box.send("one", posted(str(log)), wave=1)
    assert calls(log) == before | {"one-2": 1} and before["one-0"] == 1
    t = box.totals("one").first()
    assert (t.batches, t.accepted, t.failed) == (3, 36, 20 + 2 + 2)
    assert box.outcomes("one").where("error = 'broke off'").count() == 20


def test_nothing_to_send(spark, tmp_path):
    box = Outbox(spark, f"file://{tmp_path}/box")
    box.prepare("none", spark.createDataFrame([], "external_id string, id long"), ["id"])
    assert box.send("none", posted("nowhere")).count() == 0 and box.totals("none").first().rows == 0


def test_receivers_get_whole_batches_of_exact_values(spark, tmp_path):
    def send(run, batch, rows):
        with open(f"{tmp_path}/{batch}", "a") as f:
            f.write(f"{len(rows)} {sorted((r['id'], repr(r['n'])) for r in rows)}\n")
        return []

    rows = spark.range(100, 2600).select(F.col("id").cast("string").alias("external_id"), "id", F.when(F.col("id") % 2 == 0, (1 << 60) + 1).alias("n"))
    box = Outbox(spark, f"file://{tmp_path}/box")
    batches = box.prepare("one", rows, ["id"])
    spans = sorted(tuple(r) for r in batches.groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b")).select("a", "b").collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # batches lie across frames
    try:
        box.send("one", send, wave=60)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for b in range(125):
        want = sorted((i, repr((1 << 60) + 1 if i % 2 == 0 else None)) for i in range(100 + 20 * b, 120 + 20 * b))
        assert (tmp_path / str(b)).read_text() == f"20 {want}\n"
