"""Composite operators on small tables."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from gleaner.config import Gate, Lexicon
from gleaner.operators import aggregates, consensus, enrich, jsonld, lifecycle, publish, resolve, scoring, state

DAY = datetime.date(2024, 6, 30)
LEXICON = Lexicon(
    title={"people analytics": 50, "people analytics manager": 50, "analyst": 7, "xm scientist": 25},
    description={"people analytics": 30, "employee listening": 30, "survey": 10, "dashboard": 10}, capped=frozenset({"survey", "dashboard"}),
    negative=("barista",), reducers={"HRIS analyst": -40}, gates={"xm scientist": Gate(("employee", "EX"), 25)},
    cosignals=("python",), cosignal_terms=frozenset({"analyst"}), boost_companies=frozenset({"acme"}),
)


def scored(spark, title, description="", company="Other", source="jsearch"):
    df = spark.createDataFrame([(title, description, company, source)], "title string, description string, company string, source_name string")
    r = scoring.score_records(df, LEXICON).first()
    return r.decision, r.keyword_score


def test_scoring_rules(spark):
    assert scored(spark, "People Analytics Manager") == ("auto_include", 50)
    assert scored(spark, "People Analytics Lead", company="Acme, Inc.") == ("auto_include", 60)
    assert scored(spark, "Analyst") == ("low_score", 0)
    assert scored(spark, "Analyst", "uses Python") == ("low_score", 7)
    assert scored(spark, "Clerk", "survey dashboard")[1] == 16
    assert scored(spark, "Clerk", "people analytics and employee listening") == ("llm_review", 60)
    assert scored(spark, "Clerk", "people analytics", "Acme") == ("low_score", 14)
    assert scored(spark, "Barista") == ("auto_reject", -100)
    assert scored(spark, "Barista", "people analytics")[0] == "llm_review"
    assert scored(spark, "Baker", source="google_alerts")[0] == "llm_review"
    assert scored(spark, "XM Scientist") == ("low_score", 0) and scored(spark, "XM Scientist, Employee Research")[1] == 25
    assert scored(spark, "HRIS Analyst People Analytics", "python")[1] == 17
    assert scored(spark, None, None) == ("low_score", 0)


def test_native_pruning_equals_the_sweep(spark):
    hits = [("a", "title", 5, 0, 3, False), ("a b", "title", 9, 0, 6, False), ("c", "title", 1, 4, 5, False), ("a", "desc", 7, 0, 3, True), ("d", "desc", 2, 0, 3, False)]
    df = spark.createDataFrame([(hits,)], f"h array<{scoring.HIT}>")
    r = df.select(scoring.pruned(F.col("h")).alias("p"), scoring.one_per_term(F.col("h")).alias("o")).first()
    assert sorted(map(tuple, r.p)) == sorted(scoring.munched(hits))
    assert sorted(map(tuple, r.o)) == sorted(scoring.best_of(hits))


def test_weights_beat_counts_and_ties_are_restrictive(spark):
    rows = [
        ("a", "is_remote", 0, "x", "remote", .55), ("a", "is_remote", 1, "y", "hybrid", .90), ("a", "is_remote", 2, "z", "hybrid", .85),
        ("b", "is_remote", 0, "x", "remote", .50), ("b", "is_remote", 1, "y", "remote", .50), ("b", "is_remote", 2, "z", "hybrid", .90),
        ("c", "is_remote", 0, "x", "remote", .50), ("c", "is_remote", 1, "y", "onsite", .50), ("d", "is_remote", 0, "x", "unknown", .9),
    ]
    obs = spark.createDataFrame(rows, "external_id string, field string, seq int, source string, value string, confidence double")
    got = {r.external_id: r for r in consensus.vote(obs, "external_id").collect()}
    assert (got["a"].value, round(got["a"].confidence, 2), got["a"].sources) == ("hybrid", .76, ["y", "z"])
    assert got["b"].value == "remote" and got["c"].value == "onsite" and "d" not in got


def records(spark, rows):
    full = [(str(i), t, c, loc, u, i) for i, (t, c, loc, u) in enumerate(rows)]
    return spark.createDataFrame(full, "external_id string, title string, company string, location string, apply_url string, arrival int")


def test_clusters_of_cities(spark):
    cities = ["Austin, TX", "Boston, MA", "Chicago, IL", "Denver, CO"]
    df = records(spark, [("People Analyst", "Deloitte", c, "https://jooble.org/1" if i else "") for i, c in enumerate(cities)])
    out = resolve.cluster(df).collect()
    assert [r.outcome for r in sorted(out, key=lambda r: r.key)] == ["kept", "duplicate", "duplicate", "duplicate"]
    assert {r.location for r in out} == {"Multiple Locations (4)"} and {r.primary for r in out} == {"1"}
    two = resolve.cluster(records(spark, [("People Analyst", "Deloitte", c, "") for c in cities[:2]])).collect()
    assert {r.location for r in two} == {"Austin, TX; Boston, MA"}
    apart = resolve.cluster(records(spark, [("People Analyst", "Deloitte", "A", ""), ("Truck Driver", "Deloitte", "B", "")])).collect()
    assert len({r.primary for r in apart}) == 2


def test_blocked_pairs_find_the_best_match(spark):
    left = records(spark, [("Senior Analyst", "Acme Inc", "Austin, TX", "https://acme.com/1")])
    right = records(spark, [("x", "y", "z", ""), ("Sr Analyst", "Acme", "Austin, TX", "http://acme.com/2"), ("Driver", "Acme", "Austin, TX", "")])
    best = resolve.best_match(resolve.scored_pairs(left, right)).collect()
    assert [(r.a_external_id, r.b_external_id, r.outcome) for r in best] == [("0", "1", "duplicate")]
    assert resolve.url_upgrades(resolve.scored_pairs(left, right)).count() >= 1


def test_merge_rules(spark):
    schema = "external_id string, title string, date_posted string, first_seen_date date, last_seen_date date, is_active int, lifecycle_status string, archived_date date, days_active int"
    old = datetime.date(2024, 1, 1)
    target = spark.createDataFrame([("a", "Old", "2024-01-05", old, old, 0, "likely_closed", old, 9), ("b", "Stay", None, old, old, 1, "active", None, None)], schema)
    source = spark.createDataFrame([("a", None, "2024-01-03"), ("c", "New", None)], "external_id string, title string, date_posted string")
    got = {r.external_id: r for r in state.merge(target, source, "external_id", F.lit(DAY)).collect()}
    a = got["a"]
    assert (a.title, a.date_posted, a.first_seen_date, a.last_seen_date, a.is_active, a.lifecycle_status, a.archived_date, a.is_brand_new) == (
        "Old", "2024-01-03", old, DAY, 1, "active", None, False)
    assert got["b"].last_seen_date == old and got["c"].is_brand_new and got["c"].first_seen_date == DAY
    again = state.merge(state.merge(target, source, "external_id", F.lit(DAY)).drop("is_brand_new"), source, "external_id", F.lit(DAY))
    assert sorted(map(str, again.drop("is_brand_new").collect())) == sorted(map(str, state.merge(target, source, "external_id", F.lit(DAY)).drop("is_brand_new").collect()))


def test_versions(spark, tmp_path):
    table = state.VersionedTable(spark, f"file://{tmp_path}/t")
    assert table.read() is None
    table.write(spark.range(3))
    assert table.write(table.read().unionByName(spark.range(5))) == 2
    assert table.read().count() == 8


def test_daily_slices_are_replaced(spark, tmp_path):
    path = str(tmp_path / "stats")
    schema = "stat_type string, stat_key string, stat_value long, stat_date date"
    other = datetime.date(2024, 6, 29)
    state.write_snapshot(spark.createDataFrame([("c", "x", 1, DAY), ("c", "y", 2, DAY), ("c", "x", 5, other)], schema), path)
    state.write_snapshot(spark.createDataFrame([("c", "x", 3, DAY)], schema), path)
    assert sorted((str(r.stat_date), r.stat_key, r.stat_value) for r in spark.read.parquet(path).collect()) == [("2024-06-29", "x", 5), ("2024-06-30", "x", 3)]


def test_retry_queue(spark):
    queue = spark.createDataFrame([("a", 0), ("b", 2), ("c", 1), ("d", 2)], "external_id string, attempts int")
    done = spark.createDataFrame([("a", True), ("b", False), ("c", False)], "external_id string, ok boolean")
    assert sorted((r.external_id, r.attempts) for r in state.retried(queue, done).collect()) == [("c", 2), ("d", 2)]


def test_lifecycle(spark):
    schema = "external_id string, last_seen_date date, first_seen_date date, lifecycle_status string, last_lifecycle_verdict string, is_active int, archived_date date, days_active int"
    ago = lambda n: DAY - datetime.timedelta(n)
    rows = [("fresh", ago(3), ago(9), "active", None), ("week", ago(7), ago(9), "active", None), ("old", ago(21), ago(30), "active", None),
            ("closed", ago(0), ago(4), "likely_closed", "likely_closed"), ("open", ago(0), ago(4), "likely_closed", "unknown")]
    got = {r.external_id: r for r in lifecycle.archived(spark.createDataFrame([(*r, 1, None, None) for r in rows], schema), F.lit(DAY)).collect()}
    assert {k: (r.lifecycle_status, r.is_active, r.days_active) for k, r in got.items()} == {
        "fresh": ("active", 1, None), "week": ("likely_closed", 1, None), "old": ("likely_closed", 0, 30), "closed": ("likely_closed", 0, 4), "open": ("likely_closed", 1, None)}
    boards = spark.createDataFrame([("gh", "acme")], "ats string, slug string")
    jobs = spark.createDataFrame([("gh", "acme", "1")], "ats string, slug string, jid string")
    ids = spark.createDataFrame([("gh_acme_1",), ("gh_acme_2",), ("gh_beta_co_1",), ("jsearch_1",)], "external_id string")
    keyed = ids.withColumn("b", lifecycle.board_key(F.col("external_id"))).select("external_id", "b.*")
    out = {r.external_id: r.verdict for r in lifecycle.membership(keyed, boards, jobs, ["ats", "slug"], ["ats", "slug", "jid"]).collect()}
    assert out == {"gh_acme_1": "active", "gh_acme_2": "likely_closed", "gh_beta_co_1": None, "jsearch_1": None}
    assert keyed.where("external_id = 'gh_beta_co_1'").first().slug == "beta_co"


def test_streak_breaker_budget(spark):
    runs = spark.createDataFrame([(i, t) for i, t in enumerate([5, 0, 3, 0, 0])], "at int, total int")
    assert aggregates.zero_streak(runs, "at", "total").first().streak == 2
    assert aggregates.zero_streak(runs.where("total = 0"), "at", "total").first().streak == 3
    events = spark.createDataFrame([("h", i, f) for i, f in enumerate([1, 1, 1, 0, 1, 1])], "host string, at int, failed int")
    out = aggregates.breaker(events, "host", ["at"], F.col("failed") == 1, 3).orderBy("at").collect()
    assert [r.fails for r in out] == [1, 2, 3, 0, 1, 2] and [r.open for r in out] == [False, False, True, False, False, False]


def test_quartiles_agree_and_snapshot(spark):
    rows = [(f"{i}", "Cat" if i % 2 else None, ["IC", "VP"][i % 2], "", f"co{i % 3}", "SQL, R", float(1000 * (i * 7 % 11))) for i in range(24)]
    active = spark.createDataFrame(rows, "external_id string, category string, seniority string, is_remote string, company string, vendors_mentioned string, salary_min double")
    a = sorted(map(tuple, aggregates.quartiles(active, F.col("seniority"), F.col("salary_min")).collect()))
    assert a == sorted(map(tuple, aggregates.quartiles_at_scale(active, F.col("seniority"), F.col("salary_min")).collect()))
    stats = {(r.stat_type, r.stat_key): r.stat_value for r in aggregates.snapshot(active, F.lit(DAY)).collect()}
    assert stats["category_count", "General PA"] == 12 and stats["remote_count", "unknown"] == 24 and stats["vendor_count", "SQL"] == 24 and stats["total_active", "all"] == 24


def test_enrichment(spark):
    schema = ("external_id string, apply_url string, description string, is_remote string, remote_confidence string, location string, location_confidence string, "
              "salary_min double, salary_max double, salary_confidence string")
    rows = [("a", "https://acme.com/1", "fully remote, pay $90,000 - $100,000", "unknown", "unverified", "", "unverified", None, None, "unverified"),
            ("b", "https://jooble.org/2", "x", "hybrid", "unverified", "Austin, TX", "unverified", None, None, "unverified")]
    first = enrich.from_description(spark.createDataFrame(rows, schema))
    a = first.where("external_id = 'a'").first()
    assert (a.is_remote, a.remote_confidence, a.salary_min, a.salary_max, a.salary_confidence) == ("remote", "inferred", 90000.0, 100000.0, "inferred")
    pages = spark.createDataFrame([("https://acme.com/1", "https://acme.com/1", "<p>fully remote in Austin, TX</p>")], "apply_url string, final_url string, html string")
    out = {r.external_id: r for r in enrich.from_pages(first, pages).collect()}
    assert out["a"].remote_confidence == "confirmed" and out["a"].location == "Austin, TX" and out["a"].location_confidence == "confirmed"
    assert out["b"].enrichment_source == "aggregator" and out["b"].remote_confidence == "unverified"
    assert enrich.assumed(spark.createDataFrame([("unknown", "unverified")], "is_remote string, remote_confidence string")).first() == ("onsite", "assumed")


def test_jsonld(spark):
    from gleaner.plans.composite import FIXTURE

    got = {r.id: r for r in jsonld.extracted(spark.createDataFrame(list(FIXTURE), "id int, html string"), "id").collect()}
    assert got.keys() == {1, 2, 3}
    assert (got[1].location, got[1].location_country, got[1].salary_min, got[1].salary_max, got[1].is_remote, got[1].date_posted) == (
        "Austin, TX", "US", 100000.0, 150000.0, "remote", "2024-03-01")
    assert got[2].location == "Paris" and got[2].salary_min == 90000.0 and got[3].date_posted is None


def test_publishing(spark):
    df = spark.createDataFrame([("a", True, 3, None)], "external_id string, flag boolean, n int, gone string")
    assert df.select(publish.payload(df, ["external_id", "flag", "n", "gone", "absent"]).alias("p")).first().p == '{"external_id":"a","flag":1,"n":3}'
    report = publish.ping(spark.createDataFrame([(2,), (3,)], "n int"), spark.createDataFrame([(f"e{i:03}",) for i in range(60)], "e string"))
    assert report.total == 5 and len(report.errors) == 50 and report.n_errors == 60 and report.truncated
    posts = spark.createDataFrame([("a", "t", "c", "2024-01-02", "archived")], "external_id string, title string, content string, first_seen string, status string")
    new = spark.createDataFrame([("a", "x" * 300, None, "2024-01-05"), ("b", "y", "z", "2024-02-01")], "external_id string, title string, content string, first_seen string")
    out = {r.external_id: r for r in publish.received(posts, new).collect()}
    assert len(out["a"].title) == 200 and out["a"].first_seen == "2024-01-02" and out["a"].status == "publish" and out["b"].content == "z"
    sent = publish.sent(spark.createDataFrame([(f"{i}", "{}") for i in range(5)], "external_id string, payload string"), lambda b: [{"external_id": b[0]["external_id"], "post_id": 7}], "external_id", 2)
    assert sent.where("ok").count() >= 1


def test_lexicon_reads_the_published_layout(tmp_path):
    k = tmp_path / "k.yaml"
    k.write_text("tier1_title:\n  score: 50\n  terms: [people analytics]\ntier2_description:\n  score: 10\n  terms: [survey]\nnegative_auto_reject:\n  terms: [barista]\nnegative_score_reducers:\n  hard:\n    score: -40\n    terms: [hris admin]\n")
    c = tmp_path / "c.yaml"
    c.write_text("tier1:\n  - name: Acme\ntier3:\n  - name: Beta\n")
    lex = Lexicon.load(k, c)
    assert lex.title == {"people analytics": 50} and lex.capped == {"survey"} and lex.reducers == {"hris admin": -40}
    assert lex.boost_companies == {"acme"} and lex.negative == ("barista",)
    with pytest.raises(FileNotFoundError):
        Lexicon.load(tmp_path / "none.yaml")


def compared_with_all(batch, pool=()):
    """The rule row by row: each against the whole pool and all that is kept. Rows are (key, company, title, location, url)."""
    from gleaner.functions.similarity import folded, token_sort, weighted_ratio

    def quality(url):
        return 0 if not url else 1 if "jooble" in url else 2 if url.startswith("http:") else 3

    def city(where):
        return where.split(",")[0].strip().lower()

    kept, out = [], {}
    for nth, (key, c, n, where, url) in enumerate(batch):
        best, high, like = None, 0.0, 0.0
        for other in [*pool, *kept]:
            if other[0] == key:
                continue
            company, title = weighted_ratio(c, other[1]), token_sort(folded(n), folded(other[2]))
            here, there = city(where), city(other[3])
            score = 0.4 * company + 0.4 * title + 20 * (here == there) if here and there else 0.5 * company + 0.5 * title
            if score > high:
                best, high, like = other, score, company
        if best is not None and high >= (75 if like >= 95 else 85):
            at = next((i for i, k in enumerate(kept) if k[0] == best[0]), None)
            if at is None:
                out[nth] = (key, best[0], "duplicate", where, True)
                continue
            k = kept[at]
            k[3] = resolve.merge_locations(k[3], where)
            out[nth] = (key, None, "duplicate", None, False)
            k[5].append(nth)
            if quality(url) > quality(k[4]):
                kept[at] = [key, c, n, *k[3:4], url, k[5]]
        else:
            kept.append([key, c, n, where, url, [nth]])
            out[nth] = (key, None, "flagged" if high >= 70 else "kept", None, False)
    for k in kept:
        for m in k[5]:
            out[m] = (out[m][0], k[0], out[m][2], k[3], False)
    return sorted(out.values())


def as_records(spark, rows):
    full = [(k, c, n, where, url, i) for i, (k, c, n, where, url) in enumerate(rows)]
    return spark.createDataFrame(full, "external_id string, company string, title string, location string, apply_url string, arrival int")


def clustered(spark, batch, pool=None, **more):
    got = resolve.cluster(as_records(spark, batch), None if pool is None else as_records(spark, pool), **more).collect()
    return sorted((r.key, r.primary, r.outcome, r.location, r.stored) for r in got)


def postings(seed, n, start=0):
    rng = random.Random(seed)
    companies = ["acme", "acme labs", "deloitte", "deloitte consulting", "globex", "initech", "the acme"]
    titles = ["people analyst", "senior people analyst", "data analyst", "people data analyst", "truck driver", "hr data scientist", "analyst people", "aaaa bbbb cccc dddd", "cccc dddd eeee ffff", "eeee ffff gggg hhhh"]
    places = ["Austin, TX", "Austin, Texas", "Boston, MA", "Remote", "", "Chicago, IL", "Denver, CO", "Multiple Locations (4)", "Remote; Austin", "Reno, NV"]
    urls = ["", "https://jooble.org/1", "http://acme.com/1", "https://acme.com/1"]
    return [(f"k{start + i}", rng.choice(companies), rng.choice(titles), rng.choice(places), rng.choice(urls)) for i in range(n)]


@pytest.mark.parametrize("seed,chunk", [(1, 4096), (2, 40), (3, 25)])
def test_clusters_of_a_batch_and_what_is_stored_equal_comparing_all(spark, seed, chunk):
    batch = postings(seed, 90)
    pool = postings(seed + 100, 25, start=1000) + [(k, c, n, where, "") for k, c, n, where, _ in batch[5:60:9]]  # seen before under the same id
    assert clustered(spark, batch, chunk=chunk) == compared_with_all(batch)
    assert clustered(spark, batch, pool, chunk=chunk) == compared_with_all(batch, sorted(pool, key=lambda r: pool.index(r)))


def test_later_records_are_compared_with_the_new_primary(spark):
    batch = [("a", "acme", "aaaa bbbb cccc dddd", "Austin, TX", "https://jooble.org/1"), ("b", "acme", "cccc dddd eeee ffff", "Austin, TX", "https://acme.com/1"),
             ("c", "acme", "eeee ffff gggg hhhh", "Austin, TX", "")]
    got = clustered(spark, batch)
    assert got == compared_with_all(batch) and {r[1] for r in got} == {"b"}
    assert clustered(spark, []) == [] and clustered(spark, [], batch) == []


def test_parts_are_clustered_as_by_comparing_all(spark, sf_dir):
    from gleaner.plans import catalogue

    parts = spark.read.parquet(f"{sf_dir}/part.parquet").orderBy("p_partkey").collect()
    got = sorted((r.key, r.primary, r.outcome, r.location, r.stored) for r in catalogue.queries()["dedup_clusters"](spark, sf_dir).collect())
    assert got == compared_with_all([(str(r.p_partkey), r.p_brand.lower(), r.p_name.lower(), f"{r.p_type}, XX", "https://x.example") for r in parts])
    two = [("a", "acme", "data analyst", "Austin, TX", ""), ("b", "the acme", "data analyst", "Austin, TX", "")]
    assert {r[1] for r in clustered(spark, two)} == {"a"}


def test_bounds_lose_no_similar_pair():
    from gleaner.functions.similarity import folded, similar, token_sort, weighted_ratio

    rng = random.Random(8)
    words = ["data", "people", "a", "é", "R&D", "analyst", "senior", "x-y", "--", "labs", "日本"]
    text = lambda: (" " * rng.randint(1, 3)).join(rng.choice(words) for _ in range(rng.randint(0, 5)))
    left, right = ([(text(), text()) for _ in range(60)] for _ in range(2))
    for least in (60, 125, 175):
        want = {(i, j): (c, t) for i, (a, x) in enumerate(left) for j, (b, y) in enumerate(right)
                if (c := weighted_ratio(a, b)) + (t := token_sort(folded(x), folded(y))) >= least}
        i, j, c, t = similar(left, right, least)
        assert {(p, q): (u, v) for p, q, u, v in zip(i.tolist(), j.tolist(), c.tolist(), t.tolist())} == want and want


def test_fuzzy_pairs_equal_all_pairs(spark, sf_dir):
    from gleaner.functions.similarity import folded, token_sort, weighted_ratio
    from gleaner.plans import catalogue

    texts = {}
    for r in spark.read.parquet(f"{sf_dir}/part.parquet").collect():
        texts.setdefault((r.p_brand, r.p_name, r.p_type), []).append(str(r.p_partkey))
    want = {}
    for (brand, name, kind), a in texts.items():
        scored = []
        for (brand2, name2, kind2), b in texts.items():
            score = 0.4 * weighted_ratio(brand, brand2) + 0.4 * token_sort(folded(name), folded(name2)) + 20 * (kind == kind2)
            if a != b and score >= 70:
                scored.append((-score, min(b)))
                want[min(a), min(b)] = [round(score, 4), False]
        if scored:
            want[min(a), min(scored)[1]][1] = True
        want |= {(x, min(a)): [100.0, False] for x in a if x != min(a)}
    got = {(r.left_id, r.right_id): [r.score, r.best] for r in catalogue.queries()["fuzzy_pairs"](spark, sf_dir).collect()}
    assert len(want) > 1000 and got.keys() == want.keys()
    assert all(abs(got[k][0] - v[0]) < 1e-3 and got[k][1] == v[1] for k, v in want.items())


def test_versions_survive_a_half_written_one(spark, tmp_path):
    table = state.VersionedTable(spark, f"file://{tmp_path}/h")
    table.write(spark.range(3))
    spark.range(9).write.parquet(f"file://{tmp_path}/h/v2")
    (tmp_path / "h" / "v2" / "_SUCCESS").unlink()
    assert table.version() == 1 and table.read().count() == 3
    assert table.write(spark.range(4)) == 2 and table.read().count() == 4


def test_run_log_and_narrow_payload(spark):
    from gleaner.schema import RUN_LOG

    log = spark.createDataFrame([], RUN_LOG)
    by_source = spark.createDataFrame([("lever", 3), ("adzuna", 1)], "source_name string, n long")
    now = F.lit("2024-06-30 01:02:03").cast("timestamp")
    got = state.logged(state.logged(log, now, by_source, 2, ["x"], 1.5), now, by_source.limit(0), 0, [], 0).collect()
    assert sorted(r.published for r in got) == [0, 2] and {r.published: r.source_counts for r in got} == {2: {"lever": 3, "adzuna": 1}, 0: {}}
    jobs = spark.createDataFrame([("a", 1, "active", "active", DAY), ("b", 2, "active", "active", DAY)], "external_id string, wp_post_id int, lifecycle_status string, last_lifecycle_verdict string, last_seen_date date")
    assert [r.external_id for r in state.pushed(jobs, spark.createDataFrame([("b",), ("b",), ("z",)], "external_id string")).collect()] == ["b"]


def test_refused_heads_are_asked_again_by_get(spark):
    rows = [("HEAD", 403), ("HEAD", 405), ("HEAD", 501), ("HEAD", 404), ("GET", 403), ("HEAD", None)]
    got = [r.m for r in spark.createDataFrame(rows, "method string, status int").select(lifecycle.method_after(F.col("method"), F.col("status")).alias("m")).collect()]
    assert got == ["GET", "GET", "GET", None, None, None]


def test_hints_fill_only_what_is_empty(spark):
    from gleaner.operators import enrich

    schema = "is_remote string, llm_remote string, salary_min double, salary_max double, llm_salary_hint string, remote_confidence string, salary_confidence string"
    rows = [("unknown", "remote", None, None, "$100,000 - $120,000", "unverified", "unverified"), ("onsite", "remote", 5.0, 6.0, "$100,000 - $120,000", "unverified", "unverified"), (None, None, None, None, None, "unverified", "unverified")]
    got = [tuple(r) for r in enrich.from_hints(spark.createDataFrame(rows, schema)).select("is_remote", "salary_min", "remote_confidence", "salary_confidence").collect()]
    assert got == [("remote", 100000.0, "inferred", "inferred"), ("onsite", 5.0, "unverified", "unverified"), (None, None, "unverified", "unverified")]


def test_tallies(spark):
    from gleaner.operators import aggregates

    df = spark.createDataFrame([("groq", "page"), ("groq", "aggregator"), (None, None)], "llm_provider string, enrichment_source string")
    assert {r.provider: r.n for r in aggregates.provider_counts(df).collect()} == {"groq": 2, "none": 1}
    assert tuple(aggregates.enrichment_tallies(df).first()) == (1, 1, 3)


def test_locations_add_up():
    merge = resolve.merge_locations
    assert merge("", "Austin") == "Austin" and merge("Austin", None) == "Austin" and merge(" Austin ", "Austin") == "Austin"
    assert merge("A; B", "C") == "A; B; C" and merge("A; B; C", "B") == "A; B; C" and merge("A; B; C", "D") == "Multiple Locations (4)"
    assert merge("Multiple Locations (4)", "A") == "Multiple Locations (5)" and merge("Multiple Locations (4)", " ") == "Multiple Locations (4)"


def test_rows_are_numbered_over_partitions(spark):
    from gleaner.operators import aggregates

    wide = spark.range(0, 60_000, numPartitions=7).withColumns({"k": F.xxhash64("id"), "text": F.repeat(F.lit("x"), 50), "more": F.col("id") + 1})
    every = aggregates.numbered(wide, ["k", "id"], "n")
    assert every.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 60_000, 60_000)
    batches = aggregates.chunked(wide, ["k", "id"], 20).groupBy("batch").count()
    assert batches.where("count <> 20").isEmpty() and batches.count() == 3000
    assert every.alias("a").join(every.alias("b"), F.expr("a.n + 1 = b.n and (a.k > b.k or a.k = b.k and a.id >= b.id)")).isEmpty()
    df = spark.range(1000).withColumn("k", F.xxhash64("id")).repartition(7)
    got = aggregates.numbered(df, ["k", "id"], "n").collect()
    assert [r.id for r in sorted(got, key=lambda r: r.n)] == [r.id for r in sorted(got, key=lambda r: (r.k, r.id))]
    assert sorted(r.n for r in got) == list(range(1, 1001))
    assert aggregates.numbered(df.limit(0), ["k"], "n").count() == 0


def test_display_names(spark):
    from gleaner.operators import publish

    rows = [(None, None), ("", "RELEVANT"), ("jobspy_linkedin", "PARTIALLY_RELEVANT"), ("jobspy_monster", "NOT_RELEVANT"), ("siop", None), ("lever", None), ("else", None)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "s string, k string").select(publish.source_label(F.col("s")), publish.relevance(F.col("k"))).collect()]
    assert [a for a, _ in got] == ["Unknown", "Unknown", "LinkedIn", "Monster", "Niche Board", "Lever", "else"]
    assert [b for _, b in got] == ["Auto", "Relevant", "Partial", "Auto", "Auto", "Auto", "Auto"]


def test_ages_in_words_and_in_order(spark):
    from gleaner.functions import stats

    rows = [("2024-06-30", None), (None, "2024-06-29"), ("2024-06-01", "2024-06-02"), (None, None), ("never", None)]
    df = spark.createDataFrame(rows, "p string, f string")
    day = F.lit(DAY)
    got = [tuple(r) for r in df.select(stats.freshness_label(F.col("p"), F.col("f"), day), stats.freshness_order(stats.days_since(F.col("p"), F.col("f"), day))).collect()]
    assert got == [("Today", 0), ("Seen 1 day ago", 1), ("29 days ago", 29), ("Unknown", 99999), ("Unknown", 99999)]
    assert [r[0] for r in spark.createDataFrame([(5.9,), (None,)], "x double").select(stats.salary_order(F.col("x"))).collect()] == [5, 0]


def test_receiver_statements(spark):
    from gleaner.operators import publish

    posts = spark.createDataFrame([(1, "publish"), (2, "archived"), (3, "draft")], "post_id long, status string")
    jobs = spark.createDataFrame([(1, "a" * 600, "2024-01-01"), (2, "b", None), (3, "c", "2023-01-01")], "post_id long, external_id string, last_seen_active string")
    metas = publish.meta(jobs, ["external_id", "last_seen_active", "none"], "post_id")
    assert {(r.post_id, r.meta_key, len(r.meta_value)) for r in metas.collect()} == {
        (1, "external_id", 500), (1, "last_seen_active", 10), (2, "external_id", 1), (3, "external_id", 1), (3, "last_seen_active", 10)}
    assert [r.post_id for r in publish.holders(posts, metas, "external_id", ["b", "c"]).collect()] == [2]
    assert [r.post_id for r in publish.due(posts, metas, "last_seen_active", "2024-02-01").collect()] == [1]
    assert tuple(publish.status_counts(posts).first()) == (1, 1, 3)


def test_all_checked_is_no_filter(spark):
    from gleaner.operators import publish

    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "f string, title string")
    assert publish.filtered(df, {"f": ["a", "b"]}).count() == 3 and publish.filtered(df, {"f": ["a"]}).count() == 1 and publish.filtered(df, {"f": []}, "Z").count() == 1


def test_unresolved_urls_and_logs(spark, tmp_path):
    from gleaner.operators import publish

    df = spark.createDataFrame([("a", "jooble", "https://jooble.org/1"), ("b", "jobspy_linkedin", "https://www.linkedin.com/jobs/view/1"), ("c", "jooble", "https://acme.com"), ("d", None, None)],
                               "external_id string, source_name string, apply_url string")
    assert [r.external_id for r in publish.unresolved(df).collect()] == ["a"]
    publish.shadowed(df.select("external_id"), "keyword", f"{tmp_path}/log")
    publish.shadowed(df.select("external_id"), "final", f"{tmp_path}/log")
    assert sorted(r.stage for r in spark.read.json(f"{tmp_path}/log").collect()) == ["final"] * 4 + ["keyword"] * 4
    series = spark.createDataFrame([("s", 2, "b", 1), ("s", 1, "a", 5), ("t", 1, "c", 2)], "series string, place int, stat_key string, stat_value long")
    assert publish.dashboard(series).first().payload == '{"s":[{"key":"a","value":5},{"key":"b","value":1}],"t":[{"key":"c","value":2}]}'


def test_postings_deep_in_lists_and_graphs(spark):
    from gleaner.operators import jsonld

    html = '<script type="application/ld+json">[[{"@graph":[{"@type":"WebPage"},{"@graph":[{"@type":"JobPosting","datePosted":"2024-03-02"}]}]}]]</script>'
    got = jsonld.extracted(spark.createDataFrame([(1, html), (2, "none")], "id int, html string"), "id").collect()
    assert [(r.id, r.date_posted) for r in got] == [(1, "2024-03-02")]
    made = spark.range(1).select(jsonld.posting_json(F.lit("t"), F.lit("d"), F.lit("c"), F.lit(DAY), F.lit("Intern")).alias("j")).first().j
    assert '"employmentType":"INTERN"' in made and '"validThrough":"2024-07-30"' in made


def test_rounds_are_of_texts_however_many_records_share_them(spark, monkeypatch):
    rounds, met = [], resolve._met
    monkeypatch.setattr(resolve, "_met", lambda *a: rounds.append(1) or met(*a))
    some = postings(7, 12)
    batch = [(f"{k}-{i}", *rest) for i in range(20) for k, *rest in some]
    batch[100] = batch[3]  # ids that are equal are not compared
    assert clustered(spark, batch, chunk=12) == compared_with_all(batch)
    assert len(rounds) == 1
    monkeypatch.setattr(resolve, "ROWS", 90)
    assert clustered(spark, batch, chunk=12) == compared_with_all(batch)
    assert len(rounds) == 1 + 3
