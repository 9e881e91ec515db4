"""Queries over scalar operators: projection, text, URLs, HTML, JSON, dates, rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner import config as C
from gleaner.functions import rules, stats, text, urls
from gleaner.operators import consensus, enrich
from gleaner.plans.registry import Tables, case, query, whole_word
from gleaner.sources.feeds import anchors

# Substitute vocabularies: the test tables hold no postings.
P_TYPE_RULES = ((r"\beconomy\b", "Low"), (r"\b(promo|standard)\b", "Mid"), (r"\blarge\b", "High"))
DOC_RULES = ((r"licen[cs]ed?\b", "License"), (r"rights\s+reserved", "Rights"), (r"\b(idiot|moron|scum)\b", "Abuse"), (r"[$%&#]{3}", "Noise"), (r"\bthe\b", "English"))
LABELS = (("the", r"(?i)\bthe\b"), ("of", r"(?i)\bof\b"), ("license", r"(?i)licen[cs]e"), ("und", r"(?i)\bund\b"), ("les", r"(?i)\bles\b"), ("token", r"(?i)\btoken\b"))
CONFIDENCES = ((r"\bno\s+the\b", "onsite", 0.90), (r"\bof\s+the\b", "remote", 0.85), (r"\bin\s+the\b", "hybrid", 0.85), (r"\bthe\b", "remote", 0.60), (r"\bde\b", "onsite", 0.60))


@query("SELECT l_orderkey, l_quantity, l_shipmode FROM (SELECT l_orderkey, l_quantity, l_returnflag AS l_shipmode, l_shipdate FROM lineitem) WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity < 5")
def scan_project_filter(t: Tables) -> DataFrame:
    return t.lineitem.where((F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") < 5)).select(
        "l_orderkey", "l_quantity", F.col("l_returnflag").alias("l_shipmode"))


@query("""
SELECT 'part_' || p_partkey AS external_id, trim(p_name) AS title, p_brand AS company, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS title_key,
 '$' || CAST(CAST(round_even(p_retailprice * 100 / 1000, 0) AS BIGINT) AS VARCHAR) || 'K-$' || CAST(CAST(round_even(p_retailprice * 150 / 1000, 0) AS BIGINT) AS VARCHAR) || 'K' AS salary_range,
 'unknown' AS is_remote FROM part
""")
def record_build(t: Tables) -> DataFrame:
    low, high = F.col("p_retailprice") * 100, F.col("p_retailprice") * 150
    return t.part.select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("external_id"), F.trim("p_name").alias("title"), F.col("p_brand").alias("company"),
        text.dedup_key(F.col("p_name")).alias("title_key"), text.salary_range(low, high).alias("salary_range"), F.lit("unknown").alias("is_remote"))


_TEXT = "CAST(to_json({}) AS VARCHAR)"


@query(f"""
WITH p AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(n_chars, 0) AS n FROM documents),
j AS (SELECT *, '{{"id":' || doc_id || ',"text":' || {_TEXT.format("text")} || ',"lang":' || {_TEXT.format("lang")} || ',"source":' || {_TEXT.format("source")} || ',"n":' || n || ',"more":"no"}}' AS j FROM p)
SELECT doc_id, strlen(j) > 2000 AS truncated, CASE WHEN strlen(j) > 2000 THEN strlen(j) ELSE 0 END::BIGINT AS original_bytes,
 CASE WHEN strlen(j) > 2000 THEN substr('{{"id": "' || doc_id || '", "text": ' || {_TEXT.format("substr(text, 1, 100)")} || ', "lang": ' || {_TEXT.format("substr(lang, 1, 100)")}
  || ', "source": ' || {_TEXT.format("substr(source, 1, 100)")} || ', "n": "' || n || '"}}', 1, 400) ELSE md5(j) END AS preview FROM j
""")
def raw_payload_cap(t: Tables) -> DataFrame:
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    whole = F.to_json(F.struct(F.col("doc_id").alias("id"), blank("text"), blank("lang"), blank("source"), F.coalesce("n_chars", F.lit(0)).alias("n"), F.lit("no").alias("more")))
    marked = text.capped_json(whole, 2000)
    over = F.coalesce(F.get_json_object("_m", "$._truncated") == "true", F.lit(False))
    return t.documents.withColumn("_m", marked).select(
        "doc_id", over.alias("truncated"), F.when(over, F.get_json_object("_m", "$._original_bytes")).otherwise("0").cast("long").alias("original_bytes"),
        F.when(over, F.get_json_object("_m", "$._preview")).otherwise(F.md5(F.col("_m").cast("binary"))).alias("preview"))


@query("""
WITH p AS (SELECT p_partkey, p_brand, p_type, p_size FROM part),
o AS (SELECT p_partkey, 'p_brand' AS field, 0 AS seq, p_brand AS value, p_brand AS source FROM p UNION ALL SELECT p_partkey, 'p_type', 1, p_type, p_brand FROM p
 UNION ALL SELECT p_partkey, 'p_size', 2, CAST(p_size AS VARCHAR), p_brand FROM p)
SELECT p_partkey, field, seq, value, source, CAST(0.5 AS DOUBLE) AS confidence FROM o WHERE value IS NOT NULL AND value NOT IN ('', 'unknown')
""")
def provenance_unpivot(t: Tables) -> DataFrame:
    return consensus.observations(t.part, "p_partkey", ("p_brand", "p_type", "p_size"), "p_brand").select(
        "p_partkey", "field", "seq", "value", "source", "confidence")


_PRIORS = ", ".join(f"('src{i}', {v})" for i, v in enumerate(C.SOURCE_PRIORS.values()))


@query(f"SELECT doc_id, source, CAST(coalesce(p.prior, 0.5) AS DOUBLE) AS prior FROM documents LEFT JOIN (VALUES {_PRIORS}) p(s, prior) ON source = p.s")
def prior_broadcast_join(t: Tables) -> DataFrame:
    rows = [(f"src{i}", float(v)) for i, v in enumerate(C.SOURCE_PRIORS.values())]  # a fixed list of 17
    dims = t.spark.createDataFrame(rows, "source string, prior double")
    return t.documents.join(F.broadcast(dims), "source", "left").select("doc_id", "source", F.coalesce("prior", F.lit(C.DEFAULT_PRIOR)).alias("prior"))


@query(r"""
WITH h AS (SELECT page_id, lower(url) AS u, lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)) AS host FROM pages)
SELECT page_id, host, (host = 'example.net' OR host LIKE '%.example.net') AS aggregator,
 CASE WHEN host = '' THEN 0 WHEN host = 'example.net' OR host LIKE '%.example.net' THEN 1 WHEN u LIKE 'https://%' THEN 3 ELSE 2 END AS score FROM h
""")
def host_extract_score(t: Tables) -> DataFrame:
    u, roots = F.col("url"), ("example.net",)
    return t.pages.select("page_id", urls.host(u).alias("host"), urls.is_aggregator(urls.host(u), roots).alias("aggregator"), urls.apply_score(u, roots).alias("score"))


@query("""
WITH u AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE '  ' || substr(url, strpos(url, '://') + 3) END AS url FROM pages)
SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN trim(url) ELSE 'https://' || trim(url) END AS url FROM u
""")
def url_scheme_normalize(t: Tables) -> DataFrame:
    bare = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("  "), F.substring("url", F.instr("url", "://") + 3, F.length("url"))))
    return t.pages.select("page_id", urls.with_scheme(bare).alias("url"))


@query(r"""
SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS body,
 length(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')))::BIGINT AS tag_stripped FROM pages
""")
def html_to_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(text.html_to_text(F.col("html")).cast("binary")).alias("body"), F.length(text.strip_tags(F.col("html"))).cast("long").alias("tag_stripped"))


@query(r"""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS href,
 unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2)) AS label FROM pages)
SELECT page_id, href, trim(regexp_replace(regexp_replace(label, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS label FROM a WHERE trim(regexp_replace(label, '<[^>]+>', ' ', 'g')) <> ''
""")
def anchor_table_fn(t: Tables) -> DataFrame:
    return anchors(t.pages, "html", ("page_id",)).select("page_id", "href", F.col("text").alias("label"))


@query("SELECT p_partkey, p_name AS title, p_brand AS company, p_brand AS last_segment FROM part")
def title_split(t: Tables) -> DataFrame:
    joined = F.concat("p_name", F.lit(" @ "), "p_brand")
    s = text.split_title(joined)
    return t.part.select("p_partkey", s["title"].alias("title"), s["company"].alias("company"), text.last_segment(F.concat("p_name", F.lit(" - "), "p_brand")).alias("last_segment"))


_AT = [f"position('{sep}' IN x)" for sep in C.TITLE_SEPARATORS]
_FIRST = " ".join(f"WHEN {at} > 0 THEN trim(substr(x, 1, {at} - 1))" for at in _AT)
_REST = " ".join(f"WHEN {at} > 0 THEN trim(substr(x, {at} + {len(sep)}))" for at, sep in zip(_AT, C.TITLE_SEPARATORS))
_SEPARATORS = ", ".join(f"'{sep}'" for sep in C.TITLE_SEPARATORS)


@query(f"""
WITH t AS (SELECT p_partkey, p_name || list_extract([{_SEPARATORS}], p_partkey % 6 + 1) || p_brand || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE list_extract([{_SEPARATORS}], p_partkey // 6 % 6 + 1) || p_type END AS x FROM part)
SELECT p_partkey, CASE {_FIRST} END AS title, CASE {_REST} END AS company FROM t
""")
def title_separators(t: Tables) -> DataFrame:
    """Texts with one or two separators, split at the first by priority."""
    at = lambda i: F.element_at(F.array(*[F.lit(sep) for sep in C.TITLE_SEPARATORS]), (i % 6 + 1).cast("int"))
    key = F.col("p_partkey")
    more = F.when(key % 5 == 0, "").otherwise(F.concat(at(F.floor(key / 6)), "p_type"))
    parts = t.part.select("p_partkey", F.concat("p_name", at(key), "p_brand", more).alias("x"))
    s = text.split_title(F.col("x"))
    return parts.select("p_partkey", s["title"].alias("title"), s["company"].alias("company"))


@query(r"""
SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'),
 '[‐-―−­]', '-', 'g'), '[‘’]', '''', 'g'), '[“”]', '"', 'g'), '''s\b', '', 'g'), '\s+', ' ', 'g'))) AS clean FROM documents
""")
def text_preprocess_native(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(text.preprocess_native(F.col("text")).cast("binary")).alias("clean"))


@query()
def text_preprocess_full(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(text.preprocess(F.col("html")).cast("binary")).alias("clean"))


_HAS = ", ".join(f"regexp_matches(text, '{whole_word(rf'\b{w}\b')}', 'i') AS has_{w.lower()}" for w in ("the", "with", "License"))


@query(f"SELECT doc_id, {_HAS} FROM documents")
def word_boundary_match(t: Tables) -> DataFrame:
    c = F.col("text")
    return t.documents.select("doc_id", text.has_term(c, "the").alias("has_the"), text.has_term(c, "with").alias("has_with"), text.has_term(c, "License").alias("has_license"))


@query(f"SELECT p_partkey, {case('p_type', P_TYPE_RULES, 'Other')} AS level FROM part")
def part_levels(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", rules.first_match(F.col("p_type"), P_TYPE_RULES, "Other").alias("level"))


@query(f"SELECT lang, {case('text', DOC_RULES, 'General')} AS category, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1, 2")
def first_match_rules(t: Tables) -> DataFrame:
    return t.documents.withColumn("category", rules.first_match(F.col("text"), DOC_RULES, "General")).groupBy("lang", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


_LABEL_SQL = ", ".join(f"CASE WHEN regexp_matches(text, '{whole_word(p.replace('(?i)', ''))}', 'i') THEN '{n}' END" for n, p in LABELS)


@query(f"SELECT doc_id, array_to_string(list_filter([{_LABEL_SQL}], lambda x: x IS NOT NULL), ',') AS labels FROM documents")
def multi_label_array(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.array_join(rules.multi_label(F.col("text"), LABELS), ",").alias("labels"))


_CONFIDENCE_SQL = " ".join(
    f"WHEN regexp_matches(substr(text, 1, 2000), '{p}', 'i') THEN '{v}:{c}'" for p, v, c in sorted(CONFIDENCES, key=lambda x: (-x[2], C.RESTRICTIVENESS[x[1]])))


@query(f"WITH b AS (SELECT doc_id, CASE {_CONFIDENCE_SQL} END AS b FROM documents) SELECT doc_id, split_part(b, ':', 1) AS value, CAST(split_part(b, ':', 2) AS DOUBLE) AS confidence FROM b WHERE b IS NOT NULL")
def max_confidence_rule(t: Tables) -> DataFrame:
    best = rules.best_confidence(F.col("text"), CONFIDENCES)
    return t.documents.select("doc_id", best.alias("b")).where("b.value is not null").select("doc_id", F.col("b.value").alias("value"), F.col("b.confidence").alias("confidence"))


@query("""
WITH s AS (SELECT p_partkey, p_retailprice * 120 AS s FROM part), b AS (SELECT p_partkey, CASE WHEN s < 1000 THEN s * 1000 ELSE s END AS s FROM s)
SELECT p_partkey, CASE WHEN s >= 200000 THEN 'Director' WHEN s >= 150000 THEN 'Senior Manager' WHEN s >= 100000 THEN 'Manager' WHEN s >= 60000 THEN 'IC' ELSE 'Intern' END AS level FROM b
""")
def banded_inference(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", rules.merged_seniority(F.lit("Unknown"), F.lit(None).cast("string"), F.col("p_retailprice") * 120).alias("level"))


@query(r"""
SELECT doc_id, md5(substr(regexp_replace(text, '(?i)(bearer|api[_-]?key|token|authorization|secret|password)(\s*[:=]?\s*)[A-Za-z0-9._\-]{6,}', '\1\2<redacted>', 'g'), 1, 500)) AS message
FROM documents
""")
def secret_redact(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(text.redact(F.col("text")).cast("binary")).alias("message"))


@query(r"""
WITH n AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '(\d[\d,]*)', 1), lambda s: TRY_CAST(replace(s, ',', '') AS DOUBLE)), lambda v: v IS NOT NULL) AS v FROM documents),
k AS (SELECT doc_id, list_filter(list_transform(v, lambda x: CASE WHEN x < 1000 THEN x * 1000 ELSE x END), lambda x: x BETWEEN 10000 AND 1000000) AS v FROM n)
SELECT doc_id, list_min(v) AS low, CASE WHEN len(v) > 1 THEN list_max(v) END AS high FROM k WHERE len(v) > 0
""")
def number_sweep(t: Tables) -> DataFrame:
    s = text.sweep_amounts(F.col("text"))
    return t.documents.select("doc_id", s["min"].alias("low"), s["max"].alias("high")).where("low is not null")


def _salary_try(p: str) -> str:
    p = p.replace("'", "''")
    v = lambda g: f"TRY_CAST(replace(regexp_extract(s, '{p}', {g}), ',', '') AS DOUBLE)"
    k = lambda x: f"CASE WHEN {x} < 1000 THEN {x} * 1000 ELSE {x} END"
    return f"SELECT id, {k(v(1))} AS a, {k(v(2))} AS b FROM t"


#: How a line of an order names two amounts, by its key.
PHRASES = ("Salary: $%s - $%s a year", "pay $%sK to $%sK", "from $%s – %s", "compensation: %s to %s", "range $%s to %s and more", "no money here (%s, %s)", "$ %sk-$%sk plus")
_LINES = " ".join(f"WHEN {i} THEN '{a}' || lo || '{b}' || hi || '{c}'" for i, (a, b, c) in enumerate(p.split("%s") for p in PHRASES))


@query(f"""
WITH o AS (SELECT o_orderkey AS id, CAST(CAST(floor(o_totalprice) AS BIGINT) % 900 AS VARCHAR) AS small, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS big FROM orders),
a AS (SELECT id, CASE WHEN id % 7 IN (1, 6) THEN small WHEN id % 2 = 0 AND length(big) > 3 THEN substr(big, 1, length(big) - 3) || ',' || substr(big, length(big) - 2) ELSE big END AS lo,
 CASE WHEN id % 7 IN (1, 6) THEN '1' || small ELSE '120,000' END AS hi FROM o),
t AS (SELECT id, CASE id % 7 {_LINES} END AS s FROM a),
c AS ({' UNION ALL '.join(f"SELECT {i} AS o, * FROM ({_salary_try(p)})" for i, p in enumerate(C.SALARY_PATTERNS))}),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY o) AS rn FROM c WHERE a BETWEEN 10000 AND 1000000 AND b BETWEEN 10000 AND 1000000)
SELECT t.id, least(a, b) AS low, greatest(a, b) AS high FROM t LEFT JOIN r ON t.id = r.id AND rn = 1
""")
def salary_regex_coalesce(t: Tables) -> DataFrame:
    key, whole = F.col("o_orderkey"), F.floor("o_totalprice").cast("long")
    thousands, big = (key % 7).isin(1, 6), whole.cast("string")
    small = (whole % 900).cast("string")
    comma = F.regexp_replace(big, r"(\d)(\d{3})$", "$1,$2")
    low = F.when(thousands, small).when(key % 2 == 0, comma).otherwise(big)
    high = F.when(thousands, F.concat(F.lit("1"), small)).otherwise("120,000")
    line = F.coalesce(*[F.when(key % 7 == i, F.format_string(p, low, high)) for i, p in enumerate(PHRASES)])
    s = text.extract_salary(F.col("s"))
    return t.orders.select(key.alias("id"), line.alias("s")).select("id", s["min"].alias("low"), s["max"].alias("high"))


@query(f"""
WITH v AS (SELECT split_part(CASE {_CONFIDENCE_SQL} END, ':', 1) AS v FROM documents)
SELECT count(v) AS classified, count_if(v = 'remote')::BIGINT AS remote, count_if(v = 'hybrid')::BIGINT AS hybrid, count_if(v = 'onsite')::BIGINT AS onsite, count_if(v IS NULL)::BIGINT AS no_signal FROM v
""")
def text_classifier_tallies(t: Tables) -> DataFrame:
    return enrich.heard_tallies(t.documents, "text", CONFIDENCES)


@query("""
SELECT CAST(page_id AS VARCHAR) AS external_id, CASE WHEN page_id % 3 = 0 THEN 'https://us.jooble.org/' || page_id ELSE url END AS apply_url FROM pages WHERE page_id % 3 = 0 AND page_id % 2 = 1
""")
def backfill_scan(t: Tables) -> DataFrame:
    key = F.col("page_id")
    link = F.when(key % 3 == 0, F.concat(F.lit("https://us.jooble.org/"), key.cast("string"))).otherwise(F.col("url"))
    return enrich.backfill_candidates(t.pages.select(key.cast("string").alias("external_id"), link.alias("apply_url"), (key % 2).alias("is_active")))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) > 50 THEN 'high' ELSE 'low' END AS band FROM events")
def json_props_extract(t: Tables) -> DataFrame:
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return t.events.select("event_id", k.alias("k")).withColumn("band", F.when(F.col("k") > 50, "high").otherwise("low"))


@query("SELECT page_id, substr(sha256(url), 1, 16) AS id16, substr(sha256('pages|' || url), 1, 12) AS id12 FROM pages")
def sha_prefix_id(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.hash_id(F.col("url")).alias("id16"), text.hash_id(F.concat_ws("|", F.lit("pages"), "url"), 12).alias("id12"))


@query("""
SELECT o_orderkey, greatest(0, date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-06-30'))::BIGINT AS since,
 greatest(1, date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-06-30'))::BIGINT AS active_days, dayofweek(o_orderdate) = 1 AS monday FROM orders
""")
def days_since(t: Tables) -> DataFrame:
    day, as_of = F.to_date("o_orderdate"), F.lit("2000-06-30").cast("date")
    return t.orders.select("o_orderkey", stats.days_since(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(None).cast("string"), as_of).cast("long").alias("since"),
                           stats.days_between(day, as_of).cast("long").alias("active_days"), stats.is_monday(day).alias("monday"))


@query("""
WITH d AS (SELECT o_orderkey, greatest(0, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01')) AS days FROM orders)
SELECT o_orderkey, CASE WHEN days <= 3 THEN 'fresh' WHEN days <= 7 THEN 'recent' WHEN days <= 14 THEN 'aging' ELSE 'old' END AS band FROM d ORDER BY days, o_orderkey LIMIT 500
""")
def freshness_band(t: Tables) -> DataFrame:
    days = stats.days_since(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(None).cast("string"), F.lit("2001-08-01").cast("date"))
    return t.orders.withColumn("days", days).orderBy(F.coalesce("days", F.lit(99999)), "o_orderkey").limit(500).select("o_orderkey", stats.freshness(F.col("days")).alias("band"))


@query("SELECT s_suppkey, regexp_replace(replace(lower(trim(s_name || ', Inc.')), ',', ''), '[.]| inc[.]?$', '', 'g') AS company, 'senior manager ' || lower(s_name) AS title FROM supplier")
def company_normalize(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", text.normalize_company(F.concat("s_name", F.lit(", Inc."))).alias("company"),
                             text.normalize_title(F.concat(F.lit("Sr. Mgr,  "), "s_name")).alias("title"))
