"""Queries over composite operators: scoring, resolution, enrichment, JSON-LD, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.config import Gate, Lexicon
from gleaner.operators import enrich, jsonld, resolve, scoring
from gleaner.plans.registry import Tables, query, whole_word
from gleaner.runtime import shared_dir
from gleaner.streaming import expiry, jobs

# A substitute lexicon; the test documents hold no postings.
LEXICON = Lexicon(
    title={"license": 50, "released": 25}, description={"license": 30, "the": 10, "rights reserved": 10, "with": 10}, capped=frozenset({"the", "with", "rights reserved"}),
    negative=("idiot", "moron"), reducers={"token": -20, "scum": -40}, boost_companies=frozenset({"src3", "src5"}),
)
SPANS = Lexicon(
    title={"the": 7, "of the": 25, "in": 7}, description={"license": 30, "public license": 30, "general public license": 30, "the": 10}, capped=frozenset({"the"}),
    gates={"of the": Gate(("and", "in"), 50, 60, 25)}, negative=("moron",), reducers={"token": -20},
)
FIXTURE = (
    (1, '<script type="application/ld+json">{"@type":"JobPosting","title":"A","jobLocationType":"TELECOMMUTE","datePosted":"2024-03-01T00:00:00Z","baseSalary":{"value":{"minValue":100000,"maxValue":150000}},"jobLocation":{"address":{"addressLocality":"Austin","addressRegion":"TX","addressCountry":"USA"}}}</script>'),
    (2, '<script type="application/ld+json">{"@graph":[{"@type":"Organization"},{"@type":["JobPosting"],"baseSalary":{"value":{"value":90000}},"jobLocation":[{"address":{"addressLocality":"Paris","addressCountry":{"name":"France"}}}]}]}</script>'),
    (3, '<script type="application/ld+json">[{"@type":"JobPosting","datePosted":"soon"}]</script>'),
    (4, '<script type="application/ld+json">{broken</script><p>none</p>'),
)


def _records(t: Tables) -> DataFrame:
    title = F.substring_index("text", "\n", 1)  # the first line, whole
    return t.documents.select("doc_id", title.alias("title"), F.col("text").alias("description"), F.col("source").alias("company"), F.lit("x").alias("source_name"))


def _m(column: str, term: str) -> str:
    return f"regexp_matches({column}, '{whole_word(rf'\b{term}\b')}', 'i')"


@query(rf"""
WITH r AS (SELECT doc_id, source, split_part(text, chr(10), 1) AS t, text AS d FROM documents),
b AS (SELECT *, t || chr(10) || d AS b FROM r),
m AS (SELECT *, {_m('t', 'license')} AS tl, {_m('t', 'released')} AS tr, {_m('d', 'license')} AS dl, {_m('d', 'the')} AS dt, {_m('d', 'rights reserved')} AS dr, {_m('d', 'with')} AS dw,
 {_m('b', 'idiot')} OR {_m('b', 'moron')} AS neg, CASE WHEN {_m('b', 'token')} THEN -20 ELSE 0 END + CASE WHEN {_m('b', 'scum')} THEN -40 ELSE 0 END AS pen FROM b),
s AS (SELECT *, tl OR tr AS titled, source IN ('src3', 'src5') AS boost, CASE WHEN tl THEN 50 WHEN dl THEN 30 ELSE 0 END + CASE WHEN tr THEN 25 ELSE 0 END
 + least(16, 10 * (dt::INT + dr::INT + dw::INT)) + pen AS raw FROM m),
c AS (SELECT *, CASE WHEN titled AND boost THEN raw + 10 WHEN NOT titled AND boost AND raw > 14 THEN 14 ELSE raw END AS r2 FROM s),
k AS (SELECT *, least(100, r2) AS sc FROM c)
SELECT doc_id, (CASE WHEN neg AND sc < 15 THEN -100 ELSE sc END)::BIGINT AS keyword_score,
 CASE WHEN neg AND sc < 15 THEN 'auto_reject' WHEN neg THEN 'llm_review' WHEN sc >= 50 AND titled THEN 'auto_include' WHEN sc >= 15 THEN 'llm_review' ELSE 'low_score' END AS decision FROM k
""")
def keyword_score_native(t: Tables) -> DataFrame:
    return scoring.score_records(_records(t), LEXICON, native=True).select("doc_id", F.col("keyword_score").cast("long").alias("keyword_score"), "decision")


@query()
def keyword_score_spans(t: Tables) -> DataFrame:
    return scoring.score_records(_records(t), SPANS).select("doc_id", "keyword_score", "fit_score", "decision", "keywords_matched")


def _parts(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").cast("string").alias("external_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("company"),
                         F.concat("p_type", F.lit(", XX")).alias("location"), F.lit("https://x.example").alias("apply_url"), F.col("p_partkey").alias("arrival"))


@query()
def fuzzy_pairs(t: Tables) -> DataFrame:
    """Pairs of unlike texts that score 70 or more, one record standing for all of a text, and the membership of the others."""
    texts = ["title", "company", "location", "apply_url"]
    first = _parts(t).withColumn("text_id", F.min("external_id").over(Window.partitionBy(*texts)))
    stands = first.where("external_id = text_id")
    pairs = resolve.scored_pairs(stands, stands)
    best = resolve.best_match(pairs).select("a_external_id", F.col("b_external_id").alias("best_id"))
    scored = pairs.join(best, "a_external_id").select(
        F.col("a_external_id").alias("left_id"), F.col("b_external_id").alias("right_id"), F.round("company_similarity", 4).alias("company_similarity"),
        F.round("title_similarity", 4).alias("title_similarity"), F.round("score", 4).alias("score"), "outcome", (F.col("b_external_id") == F.col("best_id")).alias("best"))
    return scored.unionByName(first.where("external_id <> text_id").select(
        F.col("external_id").alias("left_id"), F.col("text_id").alias("right_id"), *[F.lit(100.0).alias(c) for c in ("company_similarity", "title_similarity", "score")],
        F.lit("copy").alias("outcome"), F.lit(False).alias("best")))


@query()
def dedup_clusters(t: Tables) -> DataFrame:
    return resolve.cluster(_parts(t))


#: A page's posting as JSON, of its number; pages of a seventh have one that doesn't parse.
_NODE = """'{"@type":' || CASE page_id % 3 WHEN 0 THEN '"JobPosting"' WHEN 1 THEN '["Thing","jobposting"]' ELSE '"WebPage"' END || ',"datePosted":"20' || (page_id % 90 + 10) || '-03-01T00:00:00Z",'
 || '"baseSalary":{"value":{"minValue":' || page_id * 100 || CASE WHEN page_id % 2 = 0 THEN ',"maxValue":' || page_id * 150 ELSE '' END || '}},"jobLocationType":"'
 || CASE WHEN page_id % 4 = 0 THEN 'TELECOMMUTE' ELSE 'x' END || '","jobLocation":[{"address":{"addressLocality":"Town ' || page_id % 11 || '","addressCountry":"' || CASE WHEN page_id % 5 = 0 THEN 'United States' ELSE 'de' END || '"}}]}'
 || CASE WHEN page_id % 7 = 6 THEN '}' ELSE '' END"""
#: It lies as many lists deep, and as many graphs in these, as its number says.
_PAGE = f"""html || '<script type="application/ld+json">' || repeat('[', page_id % 13) || repeat('{{"@graph":[{{"@type":"Organization"}},', page_id % 4) || {_NODE} || repeat(']}}', page_id % 4) || repeat(']', page_id % 13) || '</script>'"""


@query(f"""
WITH h AS (SELECT page_id, CAST(page_id AS BIGINT) AS n, {_PAGE} AS html FROM pages),
b AS (SELECT page_id, TRY_CAST(nullif(regexp_extract(html, 'ld\\+json">(.*?)</script>', 1), '') AS JSON) AS j FROM h),
a AS (WITH RECURSIVE r(page_id, path, j) AS (SELECT page_id, [0], j FROM b WHERE j IS NOT NULL
  UNION ALL SELECT page_id, list_append(path, i), l[i + 1] FROM (SELECT page_id, path, l, unnest(range(len(l))) AS i FROM (
   SELECT page_id, path, CASE WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[]) WHEN json_type(j->'$."@graph"') = 'ARRAY' THEN CAST(j->'$."@graph"' AS JSON[]) ELSE [] END AS l FROM r
   WHERE NOT (lower(coalesce(j->>'$."@type"', '')) = 'jobposting' OR coalesce(list_contains(list_transform(TRY_CAST(j->'$."@type"' AS VARCHAR[]), lambda x: lower(x)), 'jobposting'), false)))))
 SELECT * FROM r),
p AS (SELECT page_id, arg_min(j, path) AS n FROM a
 WHERE lower(coalesce(j->>'$."@type"', '')) = 'jobposting' OR coalesce(list_contains(list_transform(TRY_CAST(j->'$."@type"' AS VARCHAR[]), lambda x: lower(x)), 'jobposting'), false) GROUP BY 1),
c AS (SELECT *, n->'$.jobLocation[0].address' AS d, TRY_CAST(n->>'$.baseSalary.value.minValue' AS DOUBLE) AS low FROM p)
SELECT page_id, nullif(concat_ws(', ', d->>'$.addressLocality', d->>'$.addressRegion'), '') AS location,
 CASE WHEN lower(d->>'$.addressCountry') = 'united states' THEN 'US' WHEN length(d->>'$.addressCountry') = 2 THEN upper(d->>'$.addressCountry') END AS location_country, low AS salary_min,
 coalesce(TRY_CAST(n->>'$.baseSalary.value.maxValue' AS DOUBLE), low) AS salary_max, CASE WHEN n->>'$.jobLocationType' = 'TELECOMMUTE' THEN 'remote' END AS is_remote,
 nullif(regexp_extract(coalesce(n->>'$.datePosted', ''), '^(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '') AS date_posted FROM c
""")
def jsonld_extract(t: Tables) -> DataFrame:
    pages = t.pages.withColumn("page_id", F.col("page_id").cast("int")).selectExpr("page_id", f"{_PAGE} AS html")
    return jsonld.extracted(pages.withColumn("page_id", F.col("page_id").cast("long")), "page_id")


@query("""
WITH j AS (SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE 'v' END AS present, CASE WHEN d.doc_id % 2 = 0 THEN 'inferred' ELSE 'unverified' END AS conf,
 l.doc_id IS NOT NULL AND quality = 1 AS found, l.doc_id IS NOT NULL AS page FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, CASE WHEN NOT page THEN conf WHEN found AND present IS NULL THEN 'confirmed' WHEN found AND conf = 'inferred' THEN 'confirmed' WHEN found THEN 'aggregator_only'
 WHEN present IS NOT NULL AND conf <> 'inferred' THEN 'aggregator_only' ELSE conf END AS confidence FROM j
""")
def enrich_confidence(t: Tables) -> DataFrame:
    j = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    present, conf = F.col("doc_id") % 3 != 0, F.when(F.col("doc_id") % 2 == 0, "inferred").otherwise("unverified")
    found = F.coalesce(F.col("quality") == 1, F.lit(False))
    return j.select("doc_id", F.when(F.col("quality").isNotNull(), enrich.lattice(found, present, conf)).otherwise(conf).alias("confidence"))


def _drained(t: Tables, df: DataFrame) -> DataFrame:
    base = f"{shared_dir(t.spark)}/streams/{uuid.uuid4().hex}"
    jobs.drained(df, f"{base}/checkpoint", f"{base}/out")
    return t.spark.read.schema(df.schema).parquet(f"{base}/out")


def _updated(t: Tables, df: DataFrame) -> DataFrame:
    """All rows that a stateful stream puts out until it has read everything; each micro-batch has a folder of its own, so a batch that is run again replaces it."""
    base = f"{shared_dir(t.spark)}/streams/{uuid.uuid4().hex}"
    jobs.drained_batches(df, f"{base}/checkpoint", lambda frame, batch: frame.write.mode("overwrite").parquet(f"{base}/out/batch={batch}"))
    return t.spark.read.schema(df.schema).parquet(f"{base}/out").select(*df.columns)


@query("""
WITH w AS (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2), m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)
SELECT CAST(day AS DATE) AS day, event_type, n, total FROM w, m WHERE day + INTERVAL 1 DAY <= mark
""")
def stream_tumbling(t: Tables) -> DataFrame:
    return _drained(t, jobs.tumbling(jobs.events(t.spark, t.folder))).withColumn("day", F.to_date("day"))


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g),
a AS (SELECT user_id, k, max(ts) + INTERVAL 30 MINUTE AS e, count(*) AS n FROM s GROUP BY 1, 2), m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)
SELECT user_id, count(*) AS sessions, CAST(sum(n) AS BIGINT) AS events FROM a, m WHERE e <= mark GROUP BY 1
""")
def stream_session(t: Tables) -> DataFrame:
    done = _drained(t, jobs.sessions(jobs.events(t.spark, t.folder)))
    return done.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("events"))


@query("SELECT DISTINCT event_id FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    return _drained(t, jobs.deduplicated(jobs.events(t.spark, t.folder)).select("event_id"))


def _keyed(t: Tables) -> DataFrame:
    return jobs.events(t.spark, t.folder).select(F.col("user_id").cast("string").alias("key"), "ts", F.col("event_type").alias("value"), F.col("event_id").alias("tie"))


_E = "WITH e AS (SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(ts) // 1000 AS ms, event_type AS value, event_id FROM events), m AS (SELECT max(ms) - 3600000 AS mark FROM e)"


@query(_E + """, n AS (SELECT *, lag(ms) OVER o AS before, lead(ms) OVER o AS after FROM e WINDOW o AS (PARTITION BY key ORDER BY ms, event_id)),
s AS (SELECT key, ms + 43200000 AS ms, 'likely_closed' AS status FROM n, m WHERE coalesce(after, mark) - ms >= 43200000
 UNION ALL SELECT key, ms + 129600000, 'archived' FROM n, m WHERE coalesce(after, mark) - ms >= 129600000
 UNION ALL SELECT key, ms, 'active' FROM n WHERE before IS NULL OR ms - before >= 43200000) SELECT * FROM s
""")
def stream_inactivity(t: Tables) -> DataFrame:
    return _updated(t, expiry.idle(_keyed(t), 0.5, 1.5))


@query(_E + """, f AS (SELECT key, min(ms) AS ms FROM e GROUP BY 1),
p AS (WITH RECURSIVE p(key, ms) AS (SELECT key, ms FROM f UNION ALL SELECT p.key, (SELECT min(e.ms) FROM e WHERE e.key = p.key AND e.ms >= p.ms + 172800000) FROM p WHERE p.ms IS NOT NULL)
 SELECT key, ms FROM p WHERE ms IS NOT NULL)
SELECT e.key, count(*) AS asked, (SELECT count(*) FROM p WHERE p.key = e.key) AS passed FROM e GROUP BY 1
""")
def stream_freshness(t: Tables) -> DataFrame:
    return _updated(t, expiry.gated(_keyed(t), 2)).groupBy("key").agg(F.count(F.lit(1)).alias("asked"), F.count_if("passed").alias("passed"))


@query(_E + """, n AS (SELECT *, max(CASE WHEN value = 'error' THEN ms END) OVER (PARTITION BY key ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS missed FROM e)
SELECT key, ms, count(*) AS asked, count_if(missed IS NULL OR ms >= missed + 2592000000)::BIGINT AS passed FROM n WHERE value <> 'error' GROUP BY 1, 2
""")
def stream_negative_cache(t: Tables) -> DataFrame:
    return _updated(t, expiry.gated(_keyed(t), 30, "error")).groupBy("key", "ms").agg(F.count(F.lit(1)).alias("asked"), F.count_if("passed").alias("passed"))


_ISLANDS = _E + """, i AS (SELECT *, sum(CASE WHEN value = '{reset}' THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS g FROM e),
k AS (SELECT *, count(*) FILTER (value <> '{reset}') OVER (PARTITION BY key, g ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS fails FROM i)
"""


@query(_ISLANDS.format(reset="purchase") + """, l AS (SELECT *, coalesce(lag(fails) OVER (PARTITION BY key ORDER BY ms, event_id), 0) AS earlier FROM k)
SELECT key, ms, CASE WHEN value = 'purchase' THEN earlier % 3 ELSE (fails - 1) % 3 + 1 END AS n,
 CASE WHEN value = 'purchase' THEN 'done' WHEN fails % 3 = 0 THEN 'dropped' ELSE 'waiting' END AS outcome FROM l
""")
def stream_retries(t: Tables) -> DataFrame:
    return _updated(t, expiry.retried(_keyed(t), "purchase", 3))


@query(_E + """, i AS (SELECT *, sum(CASE WHEN value = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY key ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS g FROM e),
k AS (SELECT *, count(*) FILTER (value = 'error') OVER (PARTITION BY key, g ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS n FROM i) SELECT key, ms, n, n >= 2 AS alert FROM k
""")
def stream_canary(t: Tables) -> DataFrame:
    return _updated(t, expiry.streaked(_keyed(t), "error", 2))
