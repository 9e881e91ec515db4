"""Results that end, sources that fail, and checks of settings and boards."""

import datetime

from pyspark.sql import functions as F

from gleaner import config
from gleaner.functions import text
from gleaner.operators import lifecycle, state
from gleaner.operators.cache import Cache
from gleaner.sources import feeds, http


def test_a_result_is_made_once_a_version(spark, tmp_path):
    table = state.VersionedTable(spark, f"file://{tmp_path}/t")
    table.write(spark.range(5))
    now, made = [1000.0], []
    kept = Cache(spark, f"file://{tmp_path}/cache", clock=lambda: now[0])

    def build(df):
        made.append(now[0])
        return df.agg(F.count(F.lit(1)).alias("n"))

    read = lambda: kept.get("n", table, build, hours=12).first().n
    assert [read(), read()] == [5, 5] and len(made) == 1
    table.write(spark.range(7))
    assert [read(), read()] == [7, 7] and len(made) == 2
    now[0] += 13 * 3600
    assert read() == 7 and len(made) == 3
    kept.drop("n")
    assert read() == 7 and len(made) == 4
    assert kept.pushed("payload") is None
    kept.put("payload", spark.range(3))
    now[0] += 47 * 3600
    assert kept.pushed("payload").count() == 3
    now[0] += 2 * 3600
    assert kept.pushed("payload") is None


def test_a_source_that_fails_in_its_last_partition_is_named(spark):
    def rows(source, n=8, bad=None):
        df = spark.range(0, n, 1, 4).select(F.concat(F.lit(source), F.col("id").cast("string")).alias("external_id"), F.lit("t").alias("title"), "id")
        return df.withColumn("company", F.when(F.col("id") == (-1 if bad is None else bad), F.raise_error(F.lit("no answer"))).otherwise("c")).drop("id")

    got, errors = feeds.gathered(spark, {"a": lambda: rows("a"), "b": lambda: rows("b", bad=7), "c": lambda: rows("c", 2)}, day=datetime.date(2024, 6, 25))
    assert [r.external_id for r in got.orderBy("arrival").collect()] == [f"a{i}" for i in range(8)] + ["c0", "c1"]
    assert errors.keys() == {"b"} and "no answer" in errors["b"]


def test_requests_fail_one_by_one(spark):
    specs = [{"url": "nonsense"}, {"url": "https://x.example", "headers": 7}, {}]
    reader = http.HttpReader(specs)
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    assert [r[1] for r in rows] == [0, 0, 0] and rows[0][3].startswith("ValueError")
    pages = spark.createDataFrame([*rows[:1], ("https://ok", 200, "https://ok", "<p>"), ("https://gone", 404, "https://gone", "")], "url string, status int, final_url string, html string")
    assert {(r.url, r.status, r.error is None) for r in feeds.failed_requests(pages).collect()} == {("nonsense", 0, False), ("https://gone", 404, True)}


def test_settings():
    settings = {"KEY": " ", "URL": "http://x", "PING": "HTTPS://y", "OTHER": None}
    assert config.missing_settings(settings, ("KEY", "URL", "NONE")) == ["KEY", "NONE"]
    assert config.insecure_settings(settings, ("URL", "PING", "OTHER")) == ["URL"]


def test_jobs_of_boards_that_can_be_trusted(spark):
    rows = [("gh", "a", True, False, "x", "1"), ("gh", "a", False, True, "y", "2"), ("gh", "b", False, True, "x", "3"), ("gh", "c", False, False, None, None)]
    scans = spark.createDataFrame(rows, "ats string, slug string, ok boolean, error boolean, raw string, jid string").withColumn("raw", F.col("raw").isNotNull())
    assert {(r.slug) for r in lifecycle.board_snapshot(scans).collect()} == {"a", "c"}
    assert [tuple(r) for r in lifecycle.board_jobs(scans).collect()] == [("gh", "a", "1")]


def test_the_latest_scan_of_a_slug_counts(spark):
    day = lambda d: datetime.date(2024, 6, d)
    rows = [("gh", "a", "ok", 9, day(1)), ("gh", "a", "not_found", 0, day(2)), ("gh", "b", "ok", 3, day(2)), ("gh", "b", "empty", 3, day(2)), ("gh", "b", "error", None, day(2))]
    scans = spark.createDataFrame(rows, "ats string, slug string, status string, jobs_found int, checked_at date")
    old = spark.createDataFrame([("gh", "z", "ok", day(1), 5)], "ats string, slug string, status string, last_checked date, jobs_found int")
    for df in (scans, scans.orderBy(F.desc("status"))):
        got = {r.slug: (r.status, r.jobs_found) for r in state.slug_status(old, df, F.lit(day(3))).collect()}
        assert got == {"a": ("not_found", 0), "b": ("ok", 3), "z": ("ok", 5)}


def test_previews_show_five_keys(spark):
    long = '{"id":1,"text":"%s","a":null,"b":{"c":[1,2]},"e":"q\\"uote","f":"left out"}' % ("x" * 300)
    rows = spark.createDataFrame([(long,), ("[1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16,17,18,19,20]",), ('{"a":1}',)], "j string")
    got = [r.m for r in rows.select(text.capped_json(F.col("j"), 40).alias("m")).collect()]
    shown = spark.createDataFrame([(got[0],)], "m string").select(F.get_json_object("m", "$._preview").alias("p")).first().p
    assert shown == '{"id": "1", "text": "%s", "a": "null", "b": "{\\"c\\":[1,2]}", "e": "q\\"uote"}' % ("x" * 100)
    assert '"_preview":""' in got[1] and got[2] == '{"a":1}'
