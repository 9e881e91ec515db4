"""Scalar operators on literal inputs."""

import datetime
import random
import statistics

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions import rules, similarity, stats, text, urls


def values(spark, rows, schema, expression):
    df = spark.createDataFrame([(i, *r) if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)], f"_i int, {schema}")
    return [r.v for r in df.select("_i", expression.alias("v")).orderBy("_i").collect()]


def test_preprocessing(spark):
    rows = ["Voice &amp; Tone", "&lt;b&gt;People&lt;/b&gt; Analytics", "“Quoted” – dash", "the company's  plan", "ﬁne", None, "a<br/>b"]
    assert values(spark, rows, "t string", text.preprocess(F.col("t"))) == ["Voice & Tone", "People Analytics", '"Quoted" - dash', "the company plan", "fine", "", "a b"]


def test_term_boundaries(spark):
    rows = [("Senior SQL dev",), ("MySQLish",), ("ÉTÉ",), (None,)]
    assert values(spark, rows, "t string", text.has_term(F.col("t"), "sql")) == [True, False, False, None]
    assert values(spark, rows, "t string", text.has_term(F.col("t"), "été"))[2] is True


def test_salary_formats(spark):
    rows = [(120000.0, 180000.0), (120000.0, None), (None, 180000.0), (None, None), (0.0, 90000.0), (100500.0, 101500.0)]
    assert values(spark, rows, "a double, b double", text.salary_range(F.col("a"), F.col("b"))) == [
        "$120K-$180K", "$120K+", "Up to $180K", None, "Up to $90K", "$100K-$102K"]


@pytest.mark.parametrize("line,want", [
    ("Salary: $120,000 - $180,000", (120000, 180000)), ("$120K - $180K", (120000, 180000)), ("pay 120,000 to 180,000", (120000, 180000)),
    ("$180,000 – $120,000", (120000, 180000)), ("compensation: $120k–$180k", (120000, 180000)), ("$120,000 - 180,000", (120000, 180000)),
    ("we pay well", None), ("$5 - $7", None),
])
def test_salary_extraction(spark, line, want):
    got = values(spark, [(line,)], "t string", text.extract_salary(F.col("t")))[0]
    assert (got and (got["min"], got["max"])) == want


def test_remote_and_location(spark):
    rows = [("Fully remote role",), ("hybrid schedule, remote eligible",), ("3 days in the office",), ("on-site work",), ("no remote option",), ("remote",), (None,)]
    assert values(spark, rows, "t string", text.remote_status(F.col("t"))) == ["remote", "hybrid", "hybrid", "onsite", "onsite", None, None]
    rows = [("Multiple locations available",), ("Location: Austin, TX here",), ("join us in San Jose, CA today",), ("nowhere",)]
    assert values(spark, rows, "t string", text.extract_location(F.col("t"))) == ["Multiple Locations", "Austin, TX", "San Jose, CA", None]


def test_normalisers(spark):
    assert values(spark, [("Acme, Inc.",), ("  Beta LLC",), ("Gamma Company",), (None,)], "t string", text.normalize_company(F.col("t"))) == ["acme", "beta", "gamma", ""]
    assert values(spark, [("Sr. Mgr,  People",), ("VP of Ops",)], "t string", text.normalize_title(F.col("t")))[1] == "vice president of ops"
    assert values(spark, [("Mercer LLC Inc",), ("Bain & Company",)], "t string", text.normalize_consulting(F.col("t"))) == ["mercer", "bain"]
    assert values(spark, [("Los Gatos, CA",), (None,)], "t string", text.city(F.col("t"))) == ["los gatos", ""]


def test_title_split(spark):
    rows = [("Analyst — Acme",), ("Data - Lead at Beta",), ("Plain title",)]
    got = values(spark, rows, "t string", text.split_title(F.col("t")))
    assert [g and (g.title, g.company) for g in got] == [("Analyst", "Acme"), ("Data", "Lead at Beta"), None]


def test_urls(spark):
    rows = [("https://us.jooble.org/x",), ("http://acme.com/job",), ("https://acme.com:8443/a",), ("",), ("https://notjooble.org/",), (None,)]
    assert values(spark, rows, "u string", urls.apply_score(F.col("u"))) == [1, 2, 3, 0, 3, 0]
    assert values(spark, rows, "u string", urls.host(F.col("u")))[2] == "acme.com:8443"
    assert values(spark, [("a.com/x",), (" http://b.c ",), ("",)], "u string", urls.with_scheme(F.col("u"))) == ["https://a.com/x", "http://b.c", ""]


def test_redirects(spark):
    rows = [
        ('<meta http-equiv="refresh" content="0; url=https://jobs.acme.com/1">', "https://jooble.org/a"),
        ("<script>window.location = '/local'</script><script>location.replace('//x.org/2')</script>", "https://jooble.org/a"),
        ("<script>location.href='https://jooble.org/b'</script>", "https://jooble.org/a"), ("", "https://jooble.org/a"),
    ]
    assert values(spark, rows, "h string, u string", urls.body_redirect(F.col("h"), F.col("u"))) == ["https://jobs.acme.com/1", "https://x.org/2", "", ""]


def test_verdicts(spark):
    assert values(spark, [(200,), (204,), (301,), (404,), (410,), (500,), (None,)], "c int", urls.verdict(F.col("c"))) == [
        "active", "active", "unknown", "likely_closed", "likely_closed", "unknown", "unknown"]


def test_seniority(spark):
    rows = ["Managing Director", "Sr. Director, People", "VP People", "Head of HR", "Global Head of HR", "Senior Manager", "Lead Analyst", "Data Analyst", "Internship", "Baker", None]
    want = ["Executive", "Senior Director", "VP", "Director", "Senior Director", "Senior Manager", "Senior IC", "IC", "Intern", "Unknown", "Unknown"]
    assert values(spark, rows, "t string", rules.seniority(F.col("t"))) == want
    pay = [None, 0.0, -5.0, 50000.0, 60000.0, 100000.0, 150000.0, 500000.0, 120.0, 200.0]
    assert values(spark, pay, "s double", rules.salary_seniority(F.col("s"))) == [
        None, None, None, "Intern", "IC", "Manager", "Senior Manager", "Director", "Manager", "Director"]


def test_category_and_tools(spark):
    rows = [("HRIS & People Analytics Lead", "x", ""), ("People Analytics Manager", "x", ""), ("Advisor", "Mercer LLC", ""), ("Advisor", "Acme", "employee listening strategy")]
    assert values(spark, rows, "t string, c string, d string", rules.category(F.col("t"), F.col("c"), F.col("d"))) == [
        "HRIS & Systems", "People Analytics", "Consulting", "Employee Listening"]
    rows = [("Workday Peakon and Python",), ("R&D with SQL",), ("R, SAS",), ("Workday and workday peakon",)]
    assert values(spark, rows, "t string", rules.multi_label(F.col("t"))) == [["Workday Peakon", "Python"], ["SQL"], ["R", "SAS"], ["Workday Peakon", "Workday"]]


def test_arrangement(spark):
    rows = ["This is not a remote role", "2-3 days per week in office, hybrid", "fully remote", "hybrid role; remote position", "x" * 2000 + " fully remote", "nothing", None]
    got = values(spark, rows, "t string", rules.best_confidence(F.col("t")))
    assert [(g["value"], g["confidence"]) for g in got] == [
        ("onsite", 0.9), ("hybrid", 0.85), ("remote", 0.9), ("hybrid", 0.85), (None, 0.0), (None, 0.0), (None, 0.0)]


def test_publish_routing(spark):
    rows = [("RELEVANT", 70), ("RELEVANT", 69), ("PARTIALLY_RELEVANT", 70), ("PARTIALLY_RELEVANT", 40), ("PARTIALLY_RELEVANT", 39), ("NOT_RELEVANT", 99)]
    assert values(spark, rows, "k string, c int", rules.publish_decision(F.col("k"), F.col("c"))) == ["publish", "reject", "publish", "publish_flag", "reject", "reject"]


def test_exclusive_quantiles(spark):
    rng = random.Random(1)
    rows = [[1.0, 2.0, 3.0, 4.0], [1.0, 2.0], [5.0, 5.0, 9.0], sorted(rng.random() * 1e5 for _ in range(37))]
    for q in (1, 2, 3):
        got = values(spark, [(r,) for r in rows], "a array<double>", stats.exclusive_quantile(F.col("a"), q))
        assert got == [int(statistics.quantiles(r, n=4)[q - 1]) if len(r) > 2 else None for r in rows]


def test_dates(spark):
    day = F.lit(datetime.date(2024, 3, 10))
    rows = [("2024-03-01T10:00:00Z", None), (None, "2024-03-09"), ("soon", "2024-03-09"), ("2025-01-01", None), ("", None)]
    assert values(spark, rows[:3], "p string, f string", stats.days_since(F.col("p"), F.col("f"), day)) == [9, 1, None]


def test_payload_cap_and_redaction(spark):
    assert values(spark, [('{"a":1}',)], "j string", text.capped_json(F.col("j"))) == ['{"a":1}']
    assert '"_truncated":true' in values(spark, [("x" * 60000,)], "j string", text.capped_json(F.col("j")))[0]
    assert values(spark, [("failed: api_key=abcdef123456 now",)], "m string", text.redact(F.col("m"))) == ["failed: api_key=<redacted> now"]


@given(st.text(alphabet="abc d", max_size=12), st.text(alphabet="abc d", max_size=12))
def test_indel_is_symmetric_and_bounded(a, b):
    assert similarity.indel(a, b) == similarity.indel(b, a)
    assert 0 <= similarity.indel(a, b) <= 100 and similarity.indel(a, a) == 100


def test_ratios():
    assert similarity.token_sort("people analyst senior", "senior people analyst") == 100
    assert similarity.weighted_ratio("Acme", "acme") == 100
    assert similarity.weighted_ratio("deloitte", "deloitte consulting group") >= 85
    assert similarity.weighted_ratio("", "x") == 0


def test_native_indel_equals_bit_parallel(spark):
    rng = random.Random(2)
    rows = [("".join(rng.choice("abcd ") for _ in range(rng.randint(0, 9))), "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 9)))) for _ in range(40)]
    got = values(spark, rows, "a string, b string", similarity.native_indel(F.col("a"), F.col("b")))
    assert got == pytest.approx([similarity.indel(a, b) for a, b in rows])
