"""A day end to end, and the classifier answers."""

import datetime

from pyspark.sql import functions as F

from gleaner.config import Lexicon
from gleaner.operators.classifier import classified, parsed
from gleaner.plans import daily
from gleaner.schema import JOBS
from gleaner.sources.feeds import RECORD

LEXICON = Lexicon(title={"people analytics": 50}, description={"people analytics": 30})
DAY = datetime.date(2024, 6, 30)


def batch(spark, rows):
    data = [(i, t, c, loc, "US", d, False, None, None, None, f"https://{c.lower()}.com/{i}", f"https://{c.lower()}.com/{i}", s, r, "", None, None) for i, t, c, loc, d, s, r in rows]
    return spark.createDataFrame(data, RECORD)


def test_answers(spark):
    rows = [('{"classification":"RELEVANT","confidence":150,"seniority":"VP","remote":"moon"}',), ("```json\n{\"classification\":\"not_relevant\",\"confidence\":40}\n```",),
            ('{"classification":"MAYBE","confidence":1}',), ('{"classification":"RELEVANT","confidence":"high"}',), ("nonsense",), (None,)]
    got = [r.a for r in spark.createDataFrame(rows, "raw string").select(parsed(F.col("raw")).alias("a")).collect()]
    assert (got[0].kind, got[0].confidence, got[0].seniority, got[0].remote) == ("RELEVANT", 100, "VP", None)
    assert (got[1].kind, got[1].confidence) == ("NOT_RELEVANT", 40) and got[2:] == [None] * 4
    df = spark.createDataFrame([("a", 60, False), ("b", 30, True), ("c", 0, False)], "external_id string, keyword_score int, description_is_snippet boolean")
    answers = spark.createDataFrame([("b", "openai", '{"classification":"RELEVANT","confidence":80}'), ("b", "groq", "bad"), ("b", "gemini", '{"classification":"PARTIALLY_RELEVANT","confidence":60}')],
                                    "external_id string, provider string, raw string")
    out = {r.external_id: (r.llm_classification, r.llm_confidence, r.llm_provider) for r in classified(df, answers).collect()}
    assert out == {"a": ("RELEVANT", 70, "keyword_only"), "b": ("PARTIALLY_RELEVANT", 50, "gemini"), "c": ("NOT_RELEVANT", 50, "keyword_only")}


def test_a_day(spark):
    rows = [
        ("lever_acme_1", "People Analytics Manager", "Acme", "Austin, TX", "fully remote work with SQL", "lever", "unknown"),
        ("jooble_2", "People Analytics Manager", "Acme", "Boston, MA", "", "jooble", "unknown"),
        ("jsearch_3", "Truck Driver", "Haul", "Reno, NV", "drive", "jsearch", "unknown"),
    ]
    old = datetime.date(2024, 6, 1)
    stored = spark.createDataFrame([("gone", "T", old), ("lever_acme_1", "Old title", old)], "external_id string, title string, first_seen_date date")
    names = [c.split()[0] for c in JOBS.split(", ")]
    kinds = dict(c.split() for c in JOBS.split(", "))
    filled = {"last_seen_date": F.lit(old), "is_active": F.lit(1), "lifecycle_status": F.lit("active")}
    jobs = stored.select(*[F.col(c) if c in stored.columns else filled.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in names])
    out = daily.run(batch(spark, rows), jobs, LEXICON, DAY)
    state = {r.external_id: r for r in out.jobs.collect()}
    primary = {"lever_acme_1", "jooble_2"} & set(state)
    assert [r.external_id for r in out.rejected.collect()] == ["jsearch_3"]
    assert out.duplicates.count() == 1 and len(state) in (2, 3)
    assert state["gone"].is_active == 0 and state["gone"].days_active == 29
    kept = state[min(primary, key=lambda k: state[k].last_seen_date != DAY)]
    assert kept.last_seen_date == DAY and kept.seniority == "Manager" and kept.category == "People Analytics"
    stats = {(r.stat_type, r.stat_key): r.stat_value for r in out.stats.collect()}
    assert stats["category_count", "People Analytics"] >= 1
    assert out.published.where("payload like '%people%' or payload like '%People%'").count() == 1
    assert sum(r.n for r in out.by_source.collect()) == 3


def test_a_posting_already_stored_under_another_id_is_not_new(spark):
    rows = [("lever_acme_9", "People Analytics Manager", "Acme", "Austin, TX", "people analytics", "lever", "unknown"),
            ("lever_beta_1", "People Analytics Lead", "Beta", "Reno, NV", "people analytics", "lever", "unknown")]
    names = [c.split()[0] for c in JOBS.split(", ")]
    kinds = dict(c.split() for c in JOBS.split(", "))
    old = datetime.date(2024, 6, 28)
    filled = {"external_id": "jooble_5", "title": "People Analytics Manager", "company": "Acme", "location": "Austin, TX", "apply_url": "https://jooble.org/5",
              "first_seen_date": old, "last_seen_date": old, "is_active": 1, "lifecycle_status": "active"}
    jobs = spark.range(1).select(*[F.lit(filled.get(c)).cast(kinds[c]).alias(c) for c in names])
    out = daily.run(batch(spark, rows), jobs, LEXICON, DAY)
    state = {r.external_id: r for r in out.jobs.collect()}
    assert state.keys() == {"jooble_5", "lever_beta_1"} and state["jooble_5"].apply_url == "https://acme.com/lever_acme_9"
    assert [(r.key, r.primary) for r in out.duplicates.collect()] == [("lever_acme_9", "jooble_5")]
    assert [r.external_id for r in out.published.collect()] == ["lever_beta_1"]


def stored_jobs(spark, *rows):
    names = [c.split()[0] for c in JOBS.split(", ")]
    kinds = dict(c.split() for c in JOBS.split(", "))
    if not rows:
        return spark.createDataFrame([], JOBS)
    return spark.range(len(rows)).select(*[F.element_at(F.array(*[F.lit(r.get(c)).cast(kinds[c]) for r in rows]), (F.col("id") + 1).cast("int")).alias(c) for c in names])


def test_pages_vote_and_fresh_rows_are_left(spark, tmp_path):
    rows = [("lever_acme_1", "People Analytics Manager", "Acme", "Austin, TX", "people analytics", "lever", "onsite"),
            ("lever_beta_1", "People Analytics Lead", "Beta", "Reno, NV", "people analytics hybrid schedule", "lever", "unknown")]
    posting = '<script type="application/ld+json">{"@type":"JobPosting","jobLocationType":"TELECOMMUTE"}</script>'
    pages = spark.createDataFrame([(f"https://{c}.com/lever_{c}_1", f"https://{c}.com/lever_{c}_1", posting) for c in ("acme", "beta")], "apply_url string, final_url string, html string")
    lately = {"external_id": "lever_beta_1", "title": "x", "company": "Beta", "location": "Reno, NV", "is_active": 1, "enrichment_date": "2024-06-28", "enrichment_source": "aggregator",
              "first_seen_date": datetime.date(2024, 6, 1), "last_seen_date": datetime.date(2024, 6, 28)}
    out = daily.run(batch(spark, rows), stored_jobs(spark, lately), LEXICON, DAY, pages=pages, log=str(tmp_path / "log"))
    state = {r.external_id: r for r in out.jobs.collect()}
    assert state["lever_acme_1"].enrichment_source == "page" and state["lever_acme_1"].enrichment_date == "2024-06-30"
    assert state["lever_beta_1"].enrichment_date == "2024-06-28" and state["lever_beta_1"].enrichment_source == "aggregator"
    assert state["lever_beta_1"].work_arrangement in ("hybrid", "remote")
    assert spark.read.json(str(tmp_path / "log")).groupBy("stage").count().count() >= 1


def test_a_sweep_without_a_batch(spark, tmp_path):
    from gleaner.operators.state import VersionedTable

    day = lambda d: datetime.date(2024, 6, d)
    row = lambda key, seen: {"external_id": key, "is_active": 1, "lifecycle_status": "active", "first_seen_date": day(1), "last_seen_date": day(seen)}
    table = VersionedTable(spark, f"file://{tmp_path}/jobs")
    table.write(stored_jobs(spark, row("fresh", 29), row("quiet", 20), row("gone", 2)))
    assert sorted((r.external_id, r.old, r.new) for r in daily.sweep(table, DAY).collect()) == [("gone", "active", "likely_closed"), ("quiet", "active", "likely_closed")]
    assert {r.external_id: r.is_active for r in table.read().collect()} == {"fresh": 1, "quiet": 1, "gone": 0} and table.version() == 2
