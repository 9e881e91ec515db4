"""Streams whose state expires, against plain loops and the batch forms."""

import datetime
import random

from pyspark.sql import functions as F

from gleaner.operators import lifecycle
from gleaner.streaming import expiry, jobs

START = datetime.datetime(2024, 1, 1)
HOUR = datetime.timedelta(hours=1)


def streamed(spark, tmp_path, files):
    """Events in files that are read one a micro-batch: (key, ts, value, tie)."""
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "key string, ts timestamp, value string, tie long").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    read = spark.readStream.schema("key string, ts timestamp, value string, tie long").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
    return read.parquet(str(tmp_path / "in")).withWatermark("ts", "1 hour")


def drained(spark, tmp_path, df):
    out = str(tmp_path / "out")
    jobs.drained_batches(df, str(tmp_path / "check"), lambda frame, batch: frame.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
    return [tuple(r)[: len(df.columns)] for r in spark.read.parquet(out).select(*df.columns).collect()]


def events(seed, n=200, keys="abcd", step=12):
    rng = random.Random(seed)
    at, rows = START, []
    for i in range(n):
        at += HOUR * rng.randint(1, step)
        rows.append((rng.choice(keys), at, rng.choice(["ok", "bad", "bad"]), i))
    return [rows[:70], rows[70:150], rows[150:]]


def ms(at):
    return int(at.timestamp() * 1000)


def test_idle_keys_close_and_are_archived_as_in_the_batch_form(spark, tmp_path):
    files = events(1, keys="aaabbbcde", step=30)
    files[2].append(("z", max(r[1] for r in files[2]) + HOUR * 24 * 9, "ok", 999))  # time goes on
    got = drained(spark, tmp_path, expiry.idle(streamed(spark, tmp_path, files), 3, 8))
    day, rows = 24 * HOUR, sorted(r for f in files for r in f)
    mark, want, last = max(r[1] for r in rows) - HOUR, [], {}
    for key in sorted({r[0] for r in rows}):
        times = [r[1] for r in rows if r[0] == key]
        for before, at, after in zip([None, *times], times, [*times[1:], None]):
            if before is None or at - before >= 3 * day:
                want.append((key, ms(at), "active"))
            gap = (after or mark) - at
            want += [(key, ms(at + n * day), s) for n, s in ((3, "likely_closed"), (8, "archived")) if gap >= n * day]
        last[key] = times[-1]
    assert sorted(got) == sorted(want) and {s for *_, s in want} == {"active", "likely_closed", "archived"}
    # The last state of every key is the one of the archival of stored rows.
    jobs_ = spark.createDataFrame([(k, 1, "active", None, t.date(), t.date()) for k, t in last.items()],
                                  "external_id string, is_active int, lifecycle_status string, last_lifecycle_verdict string, first_seen_date date, last_seen_date date")
    jobs_ = jobs_.withColumns({"archived_date": F.lit(None).cast("date"), "days_active": F.lit(None).cast("int")})
    old = (lifecycle.CLOSE_AFTER, lifecycle.ARCHIVE_AFTER)
    lifecycle.CLOSE_AFTER, lifecycle.ARCHIVE_AFTER = 3, 8
    try:
        state = {r.external_id: "archived" if not r.is_active else r.lifecycle_status for r in lifecycle.archived(jobs_, F.lit(mark.date())).collect()}
    finally:
        lifecycle.CLOSE_AFTER, lifecycle.ARCHIVE_AFTER = old
    final = {k: max((m, s) for key, m, s in got if key == k)[1] for k in last}
    off = [k for k in last if state[k] != final[k]]
    assert all((mark - last[k]) % day != datetime.timedelta() for k in off) and len(off) <= 1  # dates round where times don't


def test_gates(spark, tmp_path):
    files = events(2)
    got = drained(spark, tmp_path / "a", expiry.gated(streamed(spark, tmp_path / "a", files), 2))
    last, want = {}, []
    for key, at, _, _ in [r for f in files for r in f]:
        passed = key not in last or at - last[key] >= 48 * HOUR
        last[key] = at if passed else last[key]
        want.append((key, ms(at), passed))
    assert sorted(got) == sorted(want) and {p for *_, p in want} == {True, False}
    got = drained(spark, tmp_path / "b", expiry.gated(streamed(spark, tmp_path / "b", files), 2, "bad"))
    missed, want = {}, []
    for key, at, value, _ in [r for f in files for r in f]:
        if value == "bad":
            missed[key] = at
        else:
            want.append((key, ms(at), key not in missed or at - missed[key] >= 48 * HOUR))
    assert sorted(got) == sorted(want)


def test_streaks_and_retries(spark, tmp_path):
    files = events(3)
    got = drained(spark, tmp_path / "a", expiry.streaked(streamed(spark, tmp_path / "a", files), "bad", 2))
    run, want = {}, []
    for key, at, value, _ in [r for f in files for r in f]:
        run[key] = run.get(key, 0) + 1 if value == "bad" else 0
        want.append((key, ms(at), run[key], run[key] >= 2))
    assert sorted(got) == sorted(want)
    got = drained(spark, tmp_path / "b", expiry.retried(streamed(spark, tmp_path / "b", files), "ok", 3))
    tries, want = {}, []
    for key, at, value, _ in [r for f in files for r in f]:
        n = tries.get(key, 0) + (value != "ok")
        outcome = "done" if value == "ok" else "dropped" if n >= 3 else "waiting"
        tries[key] = n if outcome == "waiting" else 0
        want.append((key, ms(at), n, outcome))
    assert sorted(got) == sorted(want)
