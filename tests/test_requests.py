"""Requests by host, within breaker and budget, and the runs that make them."""

import datetime
import random

from pyspark.sql import functions as F

from gleaner.operators import aggregates, enrich, lifecycle
from gleaner.sources import chain
from gleaner.sources.chain import Answer

DAY = datetime.date(2024, 6, 30)


def scripted(answers, calls):
    """Answers by (method, url); what is not there breaks off."""
    def asking(method, url, timeout):
        calls.append((method, url, timeout))
        return answers.get((method, url), Answer(None, url))
    return asking


def test_head_then_get():
    calls = []
    answers = {("HEAD", "ok"): Answer(200, "ok"), ("HEAD", "gone"): Answer(404, "gone"), ("HEAD", "busy"): Answer(503, "busy"), ("HEAD", "shy"): Answer(403, "shy"),
               ("GET", "shy"): Answer(200, "shy"), ("HEAD", "late"): Answer(None, "late", late=True), ("GET", "late"): Answer(None, "late", late=True)}
    asking = scripted(answers, calls)
    assert [chain.status_answer(asking, u).status for u in ("ok", "gone", "busy", "shy")] == [200, 404, 503, 200]
    assert [(m, u) for m, u, _ in calls] == [("HEAD", "ok"), ("HEAD", "gone"), ("HEAD", "busy"), ("HEAD", "shy"), ("GET", "shy")]
    calls.clear()
    assert chain.status_answer(asking, "late").status is None and [m for m, *_ in calls] == ["HEAD", "GET"]
    calls.clear()
    assert chain.status_answer(asking, "dead").status is None
    assert calls == [("HEAD", "dead", 10.0), ("HEAD", "dead", 5.0), ("GET", "dead", 10.0), ("GET", "dead", 5.0)]


def test_nothing_answers_at_a_closed_port():
    got = chain.ask("GET", "http://127.0.0.1:9/", 1.0)
    assert got.status is None and not got.late
    assert chain.ask("GET", "not a url", 1.0).status is None


def in_order(rows, answers, budget, trip):
    fails, left, out = {}, budget, {}
    for key, url in rows:
        name = url.split("/")[2] if "//" in url else ""
        if name and fails.get(name, 0) >= trip:
            out[key] = ("breaker", None)
        elif not left:
            out[key] = ("budget", None)
        else:
            left -= 1
            status = answers.get(url)
            fails[name] = 0 if status == 200 else fails.get(name, 0) + 1
            out[key] = ("fetched", status)
    return out


def test_breaker_and_budget_as_one_after_the_other(spark):
    rng = random.Random(5)
    for trip, budget, n in ((3, 20, 60), (2, 500, 80), (2, 15, 60), (2, 0, 5)):
        rows = [(f"k{i:03}", rng.choice(["https://a.example/", "https://b.example/", "https://c.example/", ""]) + str(i)) for i in range(n)]
        rows = [(k, u if "//" in u else "") for k, u in rows]
        answers = {u: (200 if rng.random() < (0.2 if "a.example" in u else 0.6) else 500) for _, u in rows if u}

        def asking(method, url, timeout, answers=answers):
            return Answer(answers[url], url, "<p>x</p>")

        df = spark.createDataFrame(rows, "external_id string, apply_url string").repartition(3)
        want = in_order(rows, answers, budget, trip)
        got = chain.fetched(df, "external_id", "apply_url", ["external_id"], budget, trip, asking, gap=0)
        assert {r.external_id: (r.outcome, r.status) for r in got.collect()} == want
        plain = df.withColumn("host", F.regexp_extract("apply_url", "//([^/]+)", 1)).join(
            spark.createDataFrame(list(answers.items()) or [("", 0)], "apply_url string, status int"), "apply_url", "left")
        failed = F.coalesce(F.col("status") != 200, F.lit(True))
        done = aggregates.guarded(plain, "host", ["external_id"], failed, trip, budget)
        assert {r.external_id: r.outcome for r in done.collect()} == {k: v[0] for k, v in want.items()}
    assert chain.fetched(df.limit(0), "external_id", "apply_url", ["external_id"], 5).count() == 0


def test_streaks_are_carried_over_spans(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.random() < 0.7) for i in range(400)]
    got = {r.i: r.fails for r in aggregates.streaks(spark.createDataFrame(rows, "i long, k string, bad boolean"), "k", ["i"], F.col("bad"), span=7).collect()}
    fails, want = {}, {}
    for i, k, bad in rows:
        fails[k] = fails.get(k, 0) + 1 if bad else 0
        want[i] = fails[k]
    assert got == want


def test_links_lead_off_the_aggregators(spark):
    pages = {("GET", "https://jooble.org/1"): Answer(200, "https://acme.com/job"), ("GET", "https://jooble.org/2"): Answer(200, "https://jooble.org/2", '<meta http-equiv="refresh" content="0; url=https://beta.com/x">'),
             ("GET", "https://jooble.org/3"): Answer(403, "https://jooble.org/3"), ("HEAD", "https://jooble.org/3"): Answer(200, "https://gamma.com/y")}

    def asking(method, url, timeout):
        return pages.get((method, url), Answer(None, url))

    rows = [(str(i), f"https://jooble.org/{i}") for i in range(1, 5)] + [("5", "https://acme.com/1"), ("6", ""), ("7", None)]
    df = spark.createDataFrame(rows, "external_id string, apply_url string")
    got = {r.external_id: r.target for r in chain.landed(df, "external_id", "apply_url", asking, 0).collect()}
    assert got == {"1": "https://acme.com/job", "2": "https://beta.com/x", "3": "https://gamma.com/y", "4": None}
    jobs = df.withColumn("is_active", F.when(F.col("external_id") == "2", 0).otherwise(1))
    assert sorted(r.external_id for r in enrich.backfill_candidates(jobs).collect()) == ["1", "3", "4"]
    new, links = enrich.backfilled(jobs, asking, gap=0)
    assert {r.external_id: r.apply_url for r in new.collect()} == dict(rows) | {"1": "https://acme.com/job", "3": "https://gamma.com/y"}
    assert links.where("target is null").count() == 1


def test_a_lifecycle_run(spark):
    old = datetime.date(2024, 6, 1)
    rows = [("lever_acme_1", "https://a", "active", None), ("lever_acme_2", "https://a", "active", old), ("gh_other_3", "https://gone.com/3", "active", old),
            ("x4", "https://ok.com/4", "likely_closed", old), ("x5", "https://jooble.org/5", "active", old), ("x6", "", "active", old), ("x7", "https://slow.com/7", "active", old),
            ("x8", "https://ok.com/8", "active", DAY)]
    jobs = spark.createDataFrame([(k, u, None, s, c, None, 1) for k, u, s, c in rows],
                                 "external_id string, apply_url string, source_url string, lifecycle_status string, last_lifecycle_check date, last_lifecycle_verdict string, is_active int")
    boards = spark.createDataFrame([("lever", "acme")], "ats string, slug string")
    listed = spark.createDataFrame([("lever", "acme", "1")], "ats string, slug string, jid string")
    answers = {"https://gone.com/3": 404, "https://ok.com/4": 200, "https://slow.com/7": 200}

    def asking(method, url, timeout):
        return Answer(answers.get(url), url)

    def statuses(rows):
        return chain.visited(rows, "external_id", "apply_url", asking=asking, gap=0).select("external_id", "status")

    day = F.lit(DAY)
    boards = boards.withColumn("ats", F.lit("lever"))
    done = lifecycle.checked(jobs, boards, listed, day, statuses, calls=2).cache()
    got = {r.external_id: (r.verdict, r.deferred, r.new_status) for r in done.collect()}
    assert got == {"lever_acme_1": ("active", False, "active"), "lever_acme_2": ("likely_closed", False, "likely_closed"), "gh_other_3": ("likely_closed", False, "likely_closed"),
                   "x4": ("active", False, "active"), "x5": ("unknown", False, "active"), "x6": ("unknown", False, "active"), "x7": (None, True, "active")}
    t = lifecycle.tallies(done).first()
    assert (t.candidates, t.checked, t.deferred, t.active, t.closed, t.unknown) == (7, 6, 1, 2, 2, 2)
    assert (t.newly_closed, t.reopened) == (2, 1)
    new = {r.external_id: r for r in lifecycle.rechecked(jobs, done, day).collect()}
    assert new["x4"].lifecycle_status == "active" and new["x4"].last_lifecycle_check == DAY and new["x7"].last_lifecycle_check == old and new["x8"].last_lifecycle_verdict is None


def test_slugs_whose_board_answers(spark):
    from gleaner.sources import feeds

    rows = [("lever", "a", "https://x/a"), ("lever", "b", "https://x/b"), ("gh", "c", "https://y/c"), ("gh", "d", "")]

    def asking(method, url, timeout):
        return Answer({"https://x/a": 200, "https://x/b": 404, "https://y/c": 200}.get(url), url)

    assert feeds.discovered(spark.createDataFrame(rows, "ats string, slug string, url string"), asking, 0) == {"lever": ["a"], "gh": ["c"]}
