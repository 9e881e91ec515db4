"""Connectors on literal payloads, and streams on the events table."""

import datetime

import io
import json
from urllib import error

import duckdb
from pyspark.sql import functions as F

from gleaner.operators import lifecycle, state
from gleaner.sources import feeds, http
from gleaner.streaming import jobs


def read(spark, tmp_path, payload, schema, key):
    path = tmp_path / "feed.json"
    path.write_text(json.dumps(payload))
    return feeds.items(spark, str(path), schema, key)


def test_jsearch(spark, tmp_path):
    d = read(spark, tmp_path, {"data": [
        {"job_id": "1", "job_title": " Analyst ", "employer_name": "Acme", "job_city": "Austin", "job_state": "TX", "job_is_remote": True, "job_apply_link": "https://a", "job_min_salary": 120000},
        {"job_id": "2", "job_title": "", "employer_name": "Acme"}]}, feeds.JSEARCH, "data")
    rows = feeds.jsearch(d).collect()
    assert len(rows) == 1 and (rows[0].external_id, rows[0].title, rows[0].location, rows[0].is_remote, rows[0].location_country, rows[0].salary_range) == (
        "jsearch_1", "Analyst", "Austin, TX", "remote", "US", "$120K+")


def test_jooble_adzuna_usajobs(spark, tmp_path):
    d = read(spark, tmp_path, {"jobs": [{"id": 5, "title": "T", "company": "C", "salary": "$120.000 - $180.000", "link": "https://x", "snippet": "<b>hi</b>"}]}, feeds.JOOBLE, "jobs")
    r = feeds.jooble(d, "uk").first()
    assert (r.salary_min, r.salary_max, r.location_country, r.description, r.description_is_snippet, r.apply_url) == (120000, 180000, "GB", "hi", True, "https://x")
    d = read(spark, tmp_path, {"results": [{"id": "a", "title": "T", "company": {"display_name": "C"}, "location": {"display_name": "L"}, "redirect_url": "u"}]}, feeds.ADZUNA, "results")
    assert feeds.adzuna(d).first().company == "C"
    item = {"MatchedObjectId": "9", "MatchedObjectDescriptor": {"PositionTitle": "T", "OrganizationName": "O", "TeleworkEligible": True, "PositionRemuneration": [
        {"MinimumRange": "90", "MaximumRange": "100"}, {"MinimumRange": "80", "MaximumRange": "120"}]}}
    r = feeds.usajobs(read(spark, tmp_path, [item], feeds.USAJOBS, None)).first()
    assert (r.salary_min, r.salary_max, r.is_remote) == (80, 120, "hybrid")


def test_boards(spark, tmp_path):
    slug = F.lit("acme-corp")
    d = read(spark, tmp_path, {"jobs": [{"id": 1, "title": "T", "content": "<p>x</p>", "location": {"name": "L"}}]}, feeds.GREENHOUSE, "jobs")
    r = feeds.greenhouse(d, slug).first()
    assert (r.external_id, r.company, r.description) == ("gh_acme-corp_1", "Acme Corp", "x")
    d = read(spark, tmp_path, [{"id": "z", "text": "T", "createdAt": 1700000000000, "salaryDescription": "90,000 to 110,000"}], feeds.LEVER, None)
    r = feeds.lever(d, slug).first()
    assert (r.date_posted, r.salary_min, r.salary_max) == ("2023-11-14", 90000, 110000)
    d = read(spark, tmp_path, {"jobs": [{"id": "q", "title": "T", "location": {"name": "Oslo"}, "workplaceType": " Hybrid "}, {"id": "s", "title": "T", "location": "Rome"}]}, feeds.ASHBY, "jobs")
    assert {(r.location, r.is_remote) for r in feeds.ashby(d, slug).collect()} == {("Oslo", "hybrid"), ("Rome", "unknown")}
    scans = spark.createDataFrame([("gh", "a", True, False, True), ("gh", "b", False, True, True), ("gh", "c", False, False, False)], "ats string, slug string, ok boolean, error boolean, raw boolean")
    assert {r.slug for r in lifecycle.board_snapshot(scans).collect()} == {"a", "c"}


def test_scraped_and_rss(spark, tmp_path):
    d = spark.createDataFrame([("T", "C", "https://x", None, "indeed", None, None, 1.0, None, True, None), ("T", "C", "", None, "indeed", None, None, None, None, None, None)], feeds.SCRAPED)
    rows = feeds.scraped(d).collect()
    assert len(rows) == 1 and rows[0].source_name == "jobspy_indeed" and len(rows[0].external_id) == len("jobspy_indeed_") + 16
    path = tmp_path / "feed.xml"
    path.write_text("<rss><channel>" + "".join(f"<item><title>Analyst {i % 23} - Acme</title><link>https://l/{i % 23}</link><pubDate>Mon, 01 Jan 2024 00:00:00 +0000</pubDate></item>" for i in range(30))
                    + "<item><title>How to hire</title><link>https://l/z</link></item></channel></rss>")
    items = feeds.rss_items(spark, str(path), "f1")
    rows = feeds.rss(items).collect()
    assert len(rows) == 20 and {r.company for r in rows} == {"Acme"}
    assert feeds.stale_feeds(items, F.lit("2024-02-01").cast("timestamp")).first().stale


def test_html_board_and_page_hashes(spark):
    html = '<a href="https://b/1">Analyst — Acme</a><a href="/rel">Lead at Beta</a><a href="https://b/2"> plain </a><a href="https://b/3"><b>Lead</b> at Beta</a>'
    pages = spark.createDataFrame([("one", html)], "board string, html string")
    assert {(r.title, r.company) for r in feeds.board(pages, "onemodel").collect()} == {("Analyst", "Acme"), ("Lead", "Beta")}
    seen = pages.select(F.lit("page").alias("ats"), F.col("board").alias("slug"), feeds.hash_id(F.col("html")).alias("status"))
    assert feeds.changed_pages(pages, seen).count() == 0 and feeds.changed_pages(pages, seen.limit(0)).count() == 1


def test_union_and_negative_cache(spark):
    a = spark.createDataFrame([("x", "not_found", "2024-06-20")], "slug string, status string, last_checked string").withColumn("last_checked", F.to_date("last_checked"))
    slugs = spark.createDataFrame([("x",), ("y",)], "slug string")
    left = state.uncached(slugs, a, ["slug"], F.lit("2024-06-30").cast("date"))
    assert [r.slug for r in left.collect()] == ["y"]
    assert state.uncached(slugs, a, ["slug"], F.lit("2024-08-30").cast("date")).count() == 2
    assert feeds.union([slugs, slugs.withColumn("more", F.lit(1))]).count() == 4


def test_http_retries():
    calls = []

    class Page(io.BytesIO):
        status = 200

        def geturl(self):
            return "https://final"

    def flaky(request, timeout):
        calls.append(request.full_url)
        if len(calls) < 3:
            raise error.HTTPError(request.full_url, 503, "busy", {}, None)
        return Page(b"ok")

    assert http.fetch("https://a", waits=(0, 0, 0), opener=flaky) == (200, "https://final", "ok") and len(calls) == 3

    def missing(request, timeout):
        raise error.HTTPError(request.full_url, 404, "no", {}, None)

    assert http.fetch("https://a", waits=(0,), opener=missing)[0] == 404

    def dead(request, timeout):
        raise OSError("down")

    assert http.fetch("https://a", waits=(0,), opener=dead)[0] == 0


def test_breaker_stream(spark, sf_dir, tmp_path):
    out = str(tmp_path / "out")

    def keep(frame, batch):
        frame.write.mode("append").parquet(out)

    jobs.drained_batches(jobs.breakers(jobs.events(spark, sf_dir), 2), str(tmp_path / "check"), keep)
    got = {r.user_id: r.fails for r in spark.read.parquet(out).collect()}
    want = {}
    for user, kind in duckdb.sql(f"SELECT user_id, event_type FROM '{sf_dir}/events.parquet' ORDER BY ts, event_id").fetchall():
        want[user] = want.get(user, 0) + 1 if kind == "error" else 0
    assert got == want


def test_foreach_batch_merge(spark, sf_dir, tmp_path):
    table = state.VersionedTable(spark, f"file://{tmp_path}/state")
    day = F.lit("2024-02-01").cast("date")

    def upsert(frame, batch):
        source = state.collapsed(frame.select(F.col("user_id").cast("string").alias("external_id"), "event_type", "event_id"), "external_id", "event_id")
        old = table.read() if table.version() else source.limit(0)
        table.write(state.merge(old, source, "external_id", day).drop("is_brand_new"))

    jobs.drained_batches(jobs.events(spark, sf_dir), str(tmp_path / "check"), upsert, "append")
    users = duckdb.sql(f"SELECT count(DISTINCT user_id) FROM '{sf_dir}/events.parquet'").fetchall()[0][0]
    assert table.read().count() == users


def test_sources_are_gathered_apart(spark, tmp_path):
    from gleaner.sources import feeds

    one = lambda i: lambda: spark.createDataFrame([(f"{i}",)], "external_id string").selectExpr("external_id", "'t' AS title", "'c' AS company")

    def broken():
        raise ValueError("no answer")

    reads = {"lever": one("a"), "adzuna": broken, "usajobs": one("b"), "jooble": one("c")}
    df, errors = feeds.gathered(spark, reads, day=datetime.date(2024, 6, 25))  # a Tuesday
    assert [r.external_id for r in df.orderBy("arrival").collect()] == ["a", "c"] and errors == {"adzuna": "ValueError: no answer"}
    assert feeds.gathered(spark, reads, day=datetime.date(2024, 6, 24))[0].count() == 3
    assert feeds.gathered(spark, {"adzuna": broken})[0].count() == 0
    assert feeds.first_filled(lambda: spark.range(0), lambda: spark.range(2), lambda: spark.range(9)).count() == 2
    assert feeds.first_filled(lambda: spark.range(0), lambda: spark.range(0)).count() == 0
    assert feeds.requests_of(["x", "y"], country=["us", "ca"]) == [
        {"country": "us", "query": "x"}, {"country": "us", "query": "y"}, {"country": "ca", "query": "x"}, {"country": "ca", "query": "y"}]
    path = str(tmp_path / "slugs.json")
    assert feeds.known_slugs(path) == {} and feeds.known_slugs(path, {"lever": ["b", "a"]}) == {"lever": ["a", "b"]}
    assert feeds.known_slugs(path, {"lever": ["a", "c"], "ashby": ["z"]}) == {"lever": ["a", "b", "c"], "ashby": ["z"]} == feeds.known_slugs(path)
