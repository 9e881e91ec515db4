"""Queries over feeds, listings, routing and outgoing documents, on postings derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.config import Lexicon
from gleaner.functions import rules, stats, text, urls
from gleaner.operators import aggregates as A
from gleaner.operators import classifier, consensus, enrich, jsonld, lifecycle, publish, scoring, state
from gleaner.plans.registry import Tables, query
from gleaner.sources import feeds

SHOWN = ("external_id", "title", "company", "location", "location_country", "description", "salary_min", "salary_max", "source_url", "apply_url", "is_remote", "date_posted")


def _key(name: str = "o_orderkey") -> Column:
    return F.col(name)


def _s(c: Column) -> Column:
    return c.cast("string")


def _shown(df: DataFrame) -> DataFrame:
    return df.select(*SHOWN)


def _case(c: Column, *values: object) -> Column:
    """The value at ``c`` modulo their number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (c % len(values) + 1).cast("int"))


_COMPANY = "'Customer ' || o_custkey AS company"
_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


@query(f"""
SELECT 'jsearch_' || o_orderkey AS external_id, o_orderpriority AS title, {_COMPANY}, CASE o_orderkey % 3 WHEN 0 THEN 'Austin, TX' WHEN 1 THEN 'Boston' ELSE 'Anywhere' END AS location,
 CASE WHEN o_orderkey % 2 = 0 THEN 'DE' ELSE 'US' END AS location_country, 'about ' || o_orderkey AS description, o_totalprice AS salary_min, o_totalprice + 1 AS salary_max,
 'https://g/' || o_orderkey AS source_url, CASE WHEN o_orderkey % 4 = 0 THEN 'https://g/' || o_orderkey ELSE 'https://a/' || o_orderkey END AS apply_url,
 CASE WHEN o_orderkey % 5 = 0 THEN 'remote' ELSE 'unknown' END AS is_remote, {_DAY} AS date_posted FROM orders WHERE o_orderkey % 10 <> 3
""")
def feed_jsearch(t: Tables) -> DataFrame:
    k = _key()
    return _shown(feeds.jsearch(t.orders.select(
        F.when(k % 10 != 3, _s(k)).alias("job_id"), F.concat(F.lit(" "), "o_orderpriority").alias("job_title"), F.concat(F.lit("Customer "), _s(F.col("o_custkey"))).alias("employer_name"),
        _case(k, "Austin", "Boston", "").alias("job_city"), F.when(k % 3 == 0, "TX").alias("job_state"), F.lit("us").alias("_"), F.when(k % 2 == 0, "de").alias("job_country"),
        F.lit("Anywhere").alias("job_location"), F.concat(F.lit("about "), _s(k)).alias("job_description"), F.col("o_totalprice").alias("job_min_salary"), (F.col("o_totalprice") + 1).alias("job_max_salary"),
        F.when(k % 4 != 0, F.concat(F.lit("https://a/"), _s(k))).alias("job_apply_link"), F.concat(F.lit("https://g/"), _s(k)).alias("job_google_link"), (k % 5 == 0).alias("job_is_remote"),
        F.lit("x").alias("job_employment_type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("job_posted_at_datetime_utc"))))


@query(f"""
SELECT 'jooble_' || o_orderkey AS external_id, o_orderpriority AS title, {_COMPANY}, 'Leeds' AS location, 'GB' AS location_country, 'a bold word' AS description,
 CAST((o_orderkey % 50 + 40) * 1000 AS DOUBLE) AS salary_min, CAST((o_orderkey % 50 + 90) * 1000 AS DOUBLE) AS salary_max, 'https://l/' || o_orderkey AS source_url, 'https://l/' || o_orderkey AS apply_url, 'unknown' AS is_remote,
 {_DAY} AS date_posted FROM orders WHERE o_orderkey % 10 <> 4
""")
def feed_jooble(t: Tables) -> DataFrame:
    k = _key()
    pay = F.concat(F.lit("£"), _s(k % 50 + 40), F.lit("K - £"), _s(k % 50 + 90), F.lit("K"))
    return _shown(feeds.jooble(t.orders.select(
        F.when(k % 10 != 4, k).alias("id"), F.col("o_orderpriority").alias("title"), F.concat(F.lit("Customer "), _s(F.col("o_custkey"))).alias("company"), F.lit("Leeds").alias("location"),
        F.lit("a <b>bold</b> word").alias("snippet"), pay.alias("salary"), F.concat(F.lit("https://l/"), _s(k)).alias("link"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated")), "uk"))


@query(f"""
SELECT 'adzuna_' || o_orderkey AS external_id, 'senior ' || lower(o_orderpriority) AS title, {_COMPANY}, 'Berlin' AS location, 'DE' AS location_country, 'text' AS description, o_totalprice AS salary_min,
 NULL::DOUBLE AS salary_max, 'https://r/' || o_orderkey AS source_url, 'https://r/' || o_orderkey AS apply_url, 'unknown' AS is_remote, {_DAY} AS date_posted FROM orders
""")
def feed_adzuna(t: Tables) -> DataFrame:
    k = _key()
    return _shown(feeds.adzuna(t.orders.select(
        _s(k).alias("id"), F.concat(F.lit("<strong>senior</strong> "), F.lower("o_orderpriority")).alias("title"), F.struct(F.concat(F.lit("Customer "), _s(F.col("o_custkey"))).alias("display_name")).alias("company"),
        F.struct(F.lit("Berlin").alias("display_name")).alias("location"), F.lit("<p>text</p>").alias("description"), F.col("o_totalprice").alias("salary_min"), F.lit(None).cast("double").alias("salary_max"),
        F.concat(F.lit("https://r/"), _s(k)).alias("redirect_url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created")), "de"))


@query(f"""
SELECT 'usajobs_' || o_orderkey AS external_id, o_orderpriority AS title, CASE WHEN o_orderkey % 2 = 0 THEN 'Customer ' || o_custkey ELSE 'Department' END AS company, CASE WHEN o_orderkey % 3 = 0 THEN 'Reno' ELSE '' END AS location,
 'US' AS location_country, 'sum' AS description, CAST(100 + o_orderkey % 7 AS DOUBLE) AS salary_min, CAST(900 + o_orderkey % 7 AS DOUBLE) AS salary_max, 'https://u/' || o_orderkey AS source_url, 'https://u/' || o_orderkey AS apply_url,
 CASE o_orderkey % 4 WHEN 0 THEN 'remote' WHEN 1 THEN 'hybrid' ELSE 'onsite' END AS is_remote, {_DAY} AS date_posted FROM orders
""")
def feed_usajobs(t: Tables) -> DataFrame:
    k = _key()
    pay = lambda low, high: F.struct(_s(low).alias("MinimumRange"), _s(high).alias("MaximumRange"))
    return _shown(feeds.usajobs(t.orders.select(_s(k).alias("MatchedObjectId"), F.struct(
        F.col("o_orderpriority").alias("PositionTitle"), F.when(k % 2 == 0, F.concat(F.lit("Customer "), _s(F.col("o_custkey")))).alias("OrganizationName"), F.lit("Department").alias("DepartmentName"),
        F.when(k % 3 == 0, F.array(F.struct(F.lit("Reno").alias("LocationName")), F.struct(F.lit("Ely").alias("LocationName")))).alias("PositionLocation"), F.lit("sum").alias("QualificationSummary"),
        F.array(pay(k % 7 + 500, k % 7 + 900), pay(k % 7 + 100, k % 7 + 600), pay(F.lit("n/a"), F.lit("n/a"))).alias("PositionRemuneration"), F.concat(F.lit("https://u/"), _s(k)).alias("PositionURI"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("PublicationStartDate"), (k % 4 < 2).alias("TeleworkEligible"), (k % 4 == 0).alias("RemoteIndicator")).alias("MatchedObjectDescriptor"))))


_SLUG = "'acme-' || (p_partkey % 5)"


@query(f"""
SELECT 'gh_' || {_SLUG} || '_' || p_partkey AS external_id, p_name AS title, 'Acme ' || (p_partkey % 5) AS company, p_type AS location, 'hello there' AS description, 'https://b/' || p_partkey AS source_url FROM part
UNION ALL SELECT 'lever_' || {_SLUG} || '_' || p_partkey, p_name, 'Acme ' || (p_partkey % 5), p_type, 'plain', 'https://b/' || p_partkey FROM part
UNION ALL SELECT 'ashby_' || {_SLUG} || '_' || p_partkey, p_name, 'Acme ' || (p_partkey % 5), p_type, 'hello', 'https://b/' || p_partkey FROM part
""")
def feed_boards(t: Tables) -> DataFrame:
    """The three board systems' postings in one schema."""
    k = _key("p_partkey")
    slug, url = F.concat(F.lit("acme-"), _s(k % 5)), F.concat(F.lit("https://b/"), _s(k))
    parts = t.part.withColumn("slug", slug)
    place = F.col("p_type")
    green = feeds.greenhouse(parts.select("slug", k.alias("id"), F.col("p_name").alias("title"), F.struct(place.alias("name")).alias("location"), F.lit("<p>hello</p><p>there</p>").alias("content"),
                                          F.lit("2024-01-01").alias("updated_at"), url.alias("absolute_url")), F.col("slug"))
    salary = "struct<min:double,max:double,currency:string,text:string>"
    lever = feeds.lever(parts.select("slug", _s(k).alias("id"), F.col("p_name").alias("text"), F.struct(place.alias("location"), F.lit("t").alias("team")).alias("categories"), F.lit("plain").alias("descriptionPlain"),
                                     url.alias("hostedUrl"), F.lit(0).cast("long").alias("createdAt"), F.lit(None).cast(salary).alias("salaryRange"), F.lit("$1K").alias("salaryDescription")), F.col("slug"))
    tier = "struct<compensationTierSummary:struct<minValue:double,maxValue:double,min:double,max:double>>"
    ashby = feeds.ashby(parts.select("slug", _s(k).alias("id"), F.col("p_name").alias("title"), F.parse_json(F.when(k % 2 == 0, F.to_json(F.struct(place.alias("name")))).otherwise(F.concat(F.lit('"'), place, F.lit('"')))).alias("location"),
                                     F.lit("Remote").alias("workplaceType"), F.lit(None).cast(tier).alias("compensation"), F.lit("<p>hello</p>").alias("descriptionHtml"), F.lit(None).cast("string").alias("descriptionPlain"),
                                     url.alias("jobUrl"), F.lit(None).cast("string").alias("applyUrl"), F.lit("2024").alias("publishedAt")), F.col("slug"))
    return feeds.union([green, lever, ashby]).select("external_id", "title", "company", "location", "description", "source_url")


@query("""
WITH s AS (SELECT *, CASE page_id % 3 WHEN 0 THEN 'indeed' WHEN 1 THEN 'linkedin' ELSE 'glassdoor' END AS site FROM pages)
SELECT 'jobspy_' || site || '_' || substr(sha256(site || '|' || url), 1, 16) AS external_id, 'Page ' || page_id AS title, 'jobspy_' || site AS source_name, url AS source_url,
 CASE WHEN page_id % 4 = 0 THEN 'https://direct/' || page_id ELSE url END AS apply_url, CASE WHEN page_id % 5 = 0 THEN 'remote' ELSE 'unknown' END AS is_remote FROM s WHERE page_id % 6 <> 5
""")
def feed_scraped(t: Tables) -> DataFrame:
    k = _key("page_id")
    d = t.pages.select(F.concat(F.lit("Page "), _s(k)).alias("title"), F.lit("C").alias("company"), F.when(k % 6 != 5, F.col("url")).alias("job_url"),
                       F.when(k % 4 == 0, F.concat(F.lit("https://direct/"), _s(k))).alias("job_url_direct"), _case(k, "indeed", "linkedin", "glassdoor").alias("site"), F.lit("L").alias("location"), F.lit("D").alias("description"),
                       F.lit(None).cast("double").alias("min_amount"), F.lit(None).cast("double").alias("max_amount"), (k % 5 == 0).alias("is_remote"), F.lit(None).cast("string").alias("date_posted"))
    return feeds.scraped(d).select("external_id", "title", "source_name", "source_url", "apply_url", "is_remote")


@query("""
WITH e AS (SELECT event_id, 'feed' || (user_id % 7) AS feed, 'https://l/' || (event_id % 900) AS link, CASE WHEN event_type = 'error' THEN 'Webinar: ' || event_id ELSE 'Analyst ' || event_id || ' - Acme ' || (user_id % 3) END AS title,
 row_number() OVER (PARTITION BY user_id % 7 ORDER BY event_id) AS pos FROM events),
f AS (SELECT *, 'galert_' || substr(sha256(link), 1, 12) AS id FROM e WHERE pos <= 20 AND NOT regexp_matches(title, '(?i)webinar')),
o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY feed, event_id) AS rn FROM f)
SELECT id AS external_id, title, CASE WHEN event_id % 2 = 0 THEN 'Named' ELSE split_part(title, ' - ', 2) END AS company, link AS source_url FROM o WHERE rn = 1
""")
def feed_rss(t: Tables) -> DataFrame:
    """The first entries of each feed without blog posts, one an id."""
    title = F.when(F.col("event_type") == "error", F.concat(F.lit("Webinar: "), _s(F.col("event_id")))).otherwise(
        F.concat(F.lit("Analyst "), _s(F.col("event_id")), F.lit(" - Acme "), _s(F.col("user_id") % 3)))
    d = t.events.select(title.alias("title"), F.concat(F.lit("https://l/"), _s(F.col("event_id") % 900)).alias("link"), F.lit("s").alias("summary"), F.lit("now").alias("published"),
                        F.when(F.col("event_id") % 2 == 0, F.struct(F.lit("Named").alias("title"))).alias("source"), F.concat(F.lit("feed"), _s(F.col("user_id") % 7)).alias("feed"), F.col("event_id").alias("pos"))
    return feeds.rss(d).select("external_id", "title", "company", "source_url")


@query("""
WITH l AS (SELECT 'gh' AS ats, CAST(l_suppkey % 40 AS VARCHAR) AS slug, l_returnflag = 'A' AND l_suppkey % 3 <> 0 AS ok, l_returnflag = 'R' AS error, l_orderkey AS jid FROM lineitem),
b AS (SELECT ats, slug FROM l GROUP BY 1, 2 HAVING count(*) FILTER (ok) > 0) SELECT DISTINCT ats, slug, CAST(jid AS VARCHAR) AS jid FROM l JOIN b USING (ats, slug) WHERE ok
""")
def board_jobs(t: Tables) -> DataFrame:
    """Job ids of boards that can be trusted."""
    flag, board = F.col("l_returnflag"), F.col("l_suppkey") % 40
    return lifecycle.board_jobs(t.lineitem.select(
        F.lit("gh").alias("ats"), _s(board).alias("slug"), ((flag == "A") & (F.col("l_suppkey") % 3 != 0)).alias("ok"), (flag == "R").alias("error"), F.lit(True).alias("raw"), F.col("l_orderkey").alias("jid")))


def _jobs(t: Tables) -> DataFrame:
    k = _key()
    return t.orders.select(
        _s(k).alias("external_id"), F.col("o_orderpriority").alias("title"), F.concat(F.lit("Customer "), _s(F.col("o_custkey"))).alias("company"), F.when(k % 3 != 0, _case(k, "A", "", "B", "C")).alias("category"),
        _case(k, "Manager", "", "VP").alias("seniority"), F.when(k % 2 == 0, "remote").alias("is_remote"), F.when(k % 5 == 0, "likely_closed").otherwise("active").alias("lifecycle_status"), (k % 7 != 0).cast("int").alias("is_active"),
        F.to_date("o_orderdate").alias("first_seen_date"), F.to_date("o_orderdate").alias("last_seen_date"), F.when(k % 7 == 0, F.date_add(F.to_date("o_orderdate"), 5)).alias("archived_date"), k.alias("wp_post_id"), F.col("o_totalprice").alias("salary_min"))


_JOBS = """SELECT CAST(o_orderkey AS VARCHAR) AS external_id, o_orderpriority AS title, CASE WHEN o_orderkey % 3 <> 0 THEN CASE o_orderkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN '' WHEN 2 THEN 'B' ELSE 'C' END END AS category,
 CASE o_orderkey % 3 WHEN 0 THEN 'Manager' WHEN 1 THEN '' ELSE 'VP' END AS seniority, CASE WHEN o_orderkey % 2 = 0 THEN 'remote' END AS is_remote, CASE WHEN o_orderkey % 5 = 0 THEN 'likely_closed' ELSE 'active' END AS lifecycle_status,
 CAST(o_orderkey % 7 <> 0 AS INTEGER) AS is_active, CAST(o_orderdate AS DATE) AS first_seen_date, CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderdate AS DATE) + 5 END AS archived_date, o_orderkey, o_totalprice FROM orders"""


@query(f"""
SELECT external_id, coalesce(nullif(category, ''), 'General PA') AS category, coalesce(nullif(seniority, ''), 'Unknown') AS seniority, coalesce(is_remote, 'unknown') AS is_remote, lifecycle_status, first_seen_date
FROM ({_JOBS}) WHERE is_active = 1 ORDER BY lifecycle_status = 'likely_closed', first_seen_date DESC, external_id LIMIT 500
""")
def active_listing(t: Tables) -> DataFrame:
    return publish.active_view(_jobs(t)).select("external_id", "category", "seniority", "is_remote", "lifecycle_status", "first_seen_date")


@query(f"SELECT external_id, title, archived_date FROM ({_JOBS}) WHERE is_active = 0 ORDER BY archived_date DESC, external_id LIMIT 500")
def archived_listing(t: Tables) -> DataFrame:
    return publish.archived_view(_jobs(t)).select("external_id", "title", "archived_date")


@query(f"SELECT external_id FROM ({_JOBS}) WHERE is_active = 1 OR archived_date >= DATE '2001-07-02'")
def resolution_pool(t: Tables) -> DataFrame:
    return lifecycle.dedup_pool(_jobs(t), F.lit("2001-08-01").cast("date")).select("external_id")


@query(f"SELECT external_id, lifecycle_status, first_seen_date AS last_seen_date, o_orderkey AS wp_post_id FROM ({_JOBS}) WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def pushed_rows(t: Tables) -> DataFrame:
    keys = t.lineitem.where("l_quantity > 49").select(_s(F.col("l_orderkey")).alias("external_id"))
    return state.pushed(_jobs(t), keys, columns=("lifecycle_status", "last_seen_date", "wp_post_id"))


@query("""
SELECT o_orderkey, '{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"' || CASE WHEN o_orderkey % 3 = 0 THEN ',"flag":1' WHEN o_orderkey % 3 = 1 THEN ',"flag":0' ELSE '' END || '}' AS payload FROM orders
""")
def payload_json(t: Tables) -> DataFrame:
    """The allowed fields that are there, nulls left out, flags as numbers."""
    df = t.orders.withColumn("flag", F.when(_key() % 3 == 0, True).when(_key() % 3 == 1, False))
    return df.select("o_orderkey", publish.payload(df, ["o_orderkey", "o_orderpriority", "flag", "absent"]).alias("payload"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS external_id, CASE WHEN o_orderkey % 3 = 0 THEN '{}' ELSE '{"external_id":"' || o_orderkey || '","title":"' || o_orderpriority || '"}' END AS job_json, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END AS attempts
FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0
""")
def retry_enqueue(t: Tables) -> DataFrame:
    key = _s(_key()).alias("external_id")
    queue = t.orders.where("o_orderkey % 3 = 0").select(key, F.lit("{}").alias("job_json"), F.lit(2).alias("attempts"))
    return state.enqueued(queue, t.orders.where("o_orderkey % 2 = 0").select(key, F.col("o_orderpriority").alias("title")))


@query(f"""
WITH p AS (SELECT o_orderkey AS k, o_orderpriority AS title, repeat('x', 6000) AS content, {_DAY} AS first_seen, 'archived' AS status FROM orders WHERE o_orderkey % 3 <> 0),
i AS (SELECT o_orderkey AS k, repeat(o_orderpriority, 40) AS title, CASE WHEN o_orderkey % 4 = 0 THEN 'new' END AS content, '1999-01-01' AS first_seen FROM orders WHERE o_orderkey % 2 = 0)
SELECT CAST(coalesce(p.k, i.k) AS VARCHAR) AS external_id, substr(coalesce(i.title, p.title), 1, 200) AS title, length(substr(coalesce(i.content, p.content), 1, 5000)) AS content_length, least(i.first_seen, p.first_seen) AS first_seen,
 CASE WHEN i.k IS NOT NULL THEN 'publish' ELSE p.status END AS status FROM p FULL OUTER JOIN i ON p.k = i.k
""")
def receiver_upsert(t: Tables) -> DataFrame:
    key = _s(_key()).alias("external_id")
    posts = t.orders.where("o_orderkey % 3 <> 0").select(key, F.col("o_orderpriority").alias("title"), F.repeat(F.lit("x"), 6000).alias("content"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_seen"), F.lit("archived").alias("status"))
    new = t.orders.where("o_orderkey % 2 = 0").select(key, F.repeat("o_orderpriority", 40).alias("title"), F.when(_key() % 4 == 0, "new").alias("content"), F.lit("1999-01-01").alias("first_seen"))
    return publish.received(posts, new).withColumn("content_length", F.length("content").cast("long")).drop("content")


@query("SELECT count_if(o_orderstatus = 'O')::BIGINT AS published, count_if(o_orderstatus = 'F')::BIGINT AS archived, count(*) AS total FROM orders")
def post_counts(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "O", "publish").when(F.col("o_orderstatus") == "F", "archived").otherwise("draft")
    return publish.status_counts(t.orders.select(status.alias("status")))


@query(f"""
SELECT o_orderkey, json_extract_string(j, '$.title') AS title, json_extract_string(j, '$.hiringOrganization.name') AS company, json_extract_string(j, '$.datePosted') AS posted, json_extract_string(j, '$.validThrough') AS through,
 json_extract_string(j, '$.employmentType') AS kind, json_extract_string(j, '$.jobLocationType') AS place FROM (SELECT o_orderkey, ('{{"title":"' || o_orderpriority || '","hiringOrganization":{{"name":"C ' || o_custkey || '"}},"datePosted":"' || {_DAY}
 || '","validThrough":"' || strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') || '","employmentType":"' || CASE WHEN o_orderkey % 9 = 0 THEN 'INTERN' ELSE 'FULL_TIME' END || '"' || CASE WHEN o_orderkey % 2 = 0 THEN ',"jobLocationType":"TELECOMMUTE"' ELSE '' END || '}}')::JSON AS j FROM orders)
""")
def posting_documents(t: Tables) -> DataFrame:
    """The documents that a listing embeds, read back field by field."""
    doc = jsonld.posting_json(F.col("o_orderpriority"), F.lit("d"), F.concat(F.lit("C "), _s(F.col("o_custkey"))), F.to_date("o_orderdate"), F.when(_key() % 9 == 0, "Intern").otherwise("VP"),
                              jobLocationType=F.when(_key() % 2 == 0, "TELECOMMUTE"))
    get = lambda path: F.get_json_object("j", path)
    return t.orders.select("o_orderkey", doc.alias("j")).select(
        "o_orderkey", get("$.title").alias("title"), get("$.hiringOrganization.name").alias("company"), get("$.datePosted").alias("posted"), get("$.validThrough").alias("through"), get("$.employmentType").alias("kind"),
        get("$.jobLocationType").alias("place"))


@query("""
SELECT s_suppkey, lower(trim(split_part(s_name || ', TX', ',', 1))) AS city, lower(s_name) AS consulting, substr(repeat(s_name, 40), 1, 300) AS snippet, '&lt;b&gt; ' || s_name || ' &amp; &quot;co&quot;' AS escaped,
 'Title: "' || s_name || '"' || chr(10) || 'Company: "it''s ''it''"' || chr(10) || 'Description: "' || substr(repeat(s_name, 200), 1, 2000) || '"' AS prompt FROM supplier
""")
def text_fields(t: Tables) -> DataFrame:
    name = F.col("s_name")
    return t.supplier.select(
        "s_suppkey", text.city(F.concat(F.lit(" "), name, F.lit(" , TX"))).alias("city"), text.normalize_consulting(F.concat(name, F.lit(", Inc. LLC"))).alias("consulting"), text.snippet(F.repeat(name, 40)).alias("snippet"),
        text.html_escape(F.concat(F.lit("<b> "), name, F.lit(' & "co"'))).alias("escaped"), text.prompt(name, F.lit("it's \"it\""), F.repeat(name, 200)).alias("prompt"))


@query("""
SELECT event_id, least(greatest(CAST(floor(value) AS BIGINT) - 100, 0), 100) AS clamped, CAST(floor(value / 10) AS BIGINT) AS bucket, CAST(ts AS DATE) AS day, isodow(ts) = 1 AS monday, coalesce(CAST(trunc(value) AS INTEGER), 0) AS salary_order FROM events
""")
def number_fields(t: Tables) -> DataFrame:
    day = stats.from_millis(F.unix_millis(F.col("ts").cast("timestamp")))
    value = F.col("value")
    return t.events.select("event_id", stats.clamp(F.floor(value) - 100).alias("clamped"), stats.bucket(value).alias("bucket"), day.alias("day"), stats.is_monday(day).alias("monday"), stats.salary_order(value).alias("salary_order"))


@query("""
SELECT o_orderkey, fit >= 50 OR kind = 'RELEVANT' AS qualifies, CASE WHEN kind IN ('RELEVANT', 'PARTIALLY_RELEVANT') AND confidence >= 70 THEN 'publish' WHEN kind = 'PARTIALLY_RELEVANT' AND confidence >= 40 THEN 'publish_flag' ELSE 'reject' END AS route,
 CASE WHEN status BETWEEN 200 AND 299 THEN 'active' WHEN status IN (404, 410) THEN 'likely_closed' ELSE 'unknown' END AS verdict, NOT (date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') < 7) AS stale,
 CASE WHEN CAST(o_totalprice AS INTEGER) % 100 >= 50 THEN 'RELEVANT' WHEN CAST(o_totalprice AS INTEGER) % 100 >= 25 THEN 'PARTIALLY_RELEVANT' ELSE 'NOT_RELEVANT' END AS fallback
FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'RELEVANT' WHEN 1 THEN 'PARTIALLY_RELEVANT' ELSE 'NOT_RELEVANT' END AS kind, o_orderkey % 101 AS fit, o_orderkey % 97 AS confidence,
 CASE o_orderkey % 6 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 410 WHEN 3 THEN 403 WHEN 4 THEN 503 END AS status FROM orders)
""")
def routing(t: Tables) -> DataFrame:
    """What qualifies, is published, was closed, has to be enriched again, and what the keyword score says without a classifier."""
    k = _key()
    kind = _case(k, "RELEVANT", "PARTIALLY_RELEVANT", "NOT_RELEVANT")
    status = _case(k, 200, 404, 410, 403, 503, None)
    return t.orders.select(
        "o_orderkey", publish.qualifies(k % 101, kind).alias("qualifies"), rules.publish_decision(kind, k % 97).alias("route"), urls.verdict(status).alias("verdict"),
        enrich.stale(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("2001-08-01").cast("date")).alias("stale"), rules.keyword_fallback(F.rint("o_totalprice").cast("int") % 100)["kind"].alias("fallback"))


@query("""
WITH a AS (SELECT event_id % 500 AS k, event_id, CASE event_type WHEN 'view' THEN 'groq' WHEN 'click' THEN 'gemini' ELSE 'openai' END AS provider, user_id % 130 AS confidence, event_id % 4 <> 3 AS valid FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY list_position(['groq', 'gemini', 'openai'], provider), confidence) AS rn FROM (SELECT k, provider, max(confidence) AS confidence FROM a WHERE valid GROUP BY 1, 2)),
s AS (SELECT user_id AS k FROM events GROUP BY 1)
SELECT CAST(s.k AS VARCHAR) AS external_id, CASE WHEN r.k IS NOT NULL THEN 'RELEVANT' WHEN s.k % 100 >= 50 THEN 'RELEVANT' WHEN s.k % 100 >= 25 THEN 'PARTIALLY_RELEVANT' ELSE 'NOT_RELEVANT' END AS llm_classification,
 CASE WHEN r.k IS NOT NULL THEN greatest(0, least(100, confidence) - CASE WHEN s.k % 2 = 0 THEN 10 ELSE 0 END) WHEN s.k % 100 >= 50 THEN 70 ELSE 50 END AS llm_confidence, coalesce(provider, 'keyword_only') AS llm_provider
FROM s LEFT JOIN r ON s.k = r.k AND rn = 1
""")
def classifier_chain(t: Tables) -> DataFrame:
    """The first provider's valid answer counts, else the keyword score."""
    provider = F.when(F.col("event_type") == "view", "groq").when(F.col("event_type") == "click", "gemini").otherwise("openai")
    raw = F.when(F.col("event_id") % 4 != 3, F.concat(F.lit('```json\n{"classification":"relevant","confidence":'), _s(F.col("user_id") % 130), F.lit("}\n```"))).otherwise("no json")
    answers = t.events.select(_s(F.col("event_id") % 500).alias("external_id"), provider.alias("provider"), raw.alias("raw"), (F.col("user_id") % 130).alias("c"))
    answers = answers.groupBy("external_id", "provider", F.col("raw").startswith("no").alias("bad")).agg(F.max_by("raw", "c").alias("raw")).drop("bad")
    rows = t.events.select("user_id").distinct().select(_s(F.col("user_id")).alias("external_id"), (F.col("user_id") % 100).cast("int").alias("keyword_score"), (F.col("user_id") % 2 == 0).alias("description_is_snippet"))
    return classifier.classified(rows, answers).select("external_id", "llm_classification", F.col("llm_confidence").cast("long").alias("llm_confidence"), "llm_provider")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'hybrid' WHEN o_orderkey % 2 = 0 THEN 'remote' WHEN o_orderkey % 5 = 0 THEN 'onsite' ELSE 'onsite' END AS is_remote,
 CASE WHEN o_orderkey % 3 = 0 THEN 'unverified' WHEN o_orderkey % 2 = 0 THEN 'inferred' WHEN o_orderkey % 5 = 0 THEN 'inferred' ELSE 'assumed' END AS remote_confidence,
 CAST(CASE WHEN o_orderkey % 4 = 0 THEN 70000 WHEN o_orderkey % 7 = 0 THEN 90000 END AS DOUBLE) AS salary_min, CAST(CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 120000 END AS DOUBLE) AS salary_max,
 CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 7 = 0 THEN 'inferred' ELSE 'unverified' END AS salary_confidence FROM orders
""")
def enrichment_fill(t: Tables) -> DataFrame:
    """Hints first, then the description, then what is assumed."""
    k = _key()
    nothing = F.lit("unverified")
    df = t.orders.select(
        "o_orderkey", F.when(k % 3 == 0, "hybrid").otherwise("unknown").alias("is_remote"), nothing.alias("remote_confidence"), F.when(k % 4 == 0, 70000.0).alias("salary_min"), F.lit(None).cast("double").alias("salary_max"),
        nothing.alias("salary_confidence"), F.lit("X").alias("location"), nothing.alias("location_confidence"), F.when(k % 2 == 0, "remote").alias("llm_remote"), F.when(k % 7 == 0, "$90,000 - $120,000").alias("llm_salary_hint"),
        F.when(k % 5 == 0, "this role is on-site in our office").otherwise("nothing here").alias("description"))
    return enrich.assumed(enrich.from_description(enrich.from_hints(df))).select("o_orderkey", "is_remote", "remote_confidence", "salary_min", "salary_max", "salary_confidence")


@query("""
SELECT CAST(page_id AS VARCHAR) AS external_id, CASE page_id % 2 WHEN 0 THEN 'jooble' ELSE 'jobspy_linkedin' END AS source_name, 'https://www.linkedin.com/' || page_id AS apply_url FROM pages WHERE page_id % 3 = 0 AND page_id % 2 = 0
""")
def unresolved_links(t: Tables) -> DataFrame:
    k = _key("page_id")
    link = F.when(k % 3 == 0, F.concat(F.lit("https://www.linkedin.com/"), _s(k))).otherwise(F.col("url"))
    return publish.unresolved(t.pages.select(_s(k).alias("external_id"), _case(k, "jooble", "jobspy_linkedin").alias("source_name"), link.alias("apply_url")))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '✓' WHEN 1 THEN '~' WHEN 2 THEN '?' ELSE '' END AS badge, CASE WHEN o_orderkey % 5 >= 2 THEN o_orderstatus || ' | ' || o_orderpriority END AS tooltip,
 substr(repeat(o_orderpriority, 50), 1, 250) || ' @ C' || chr(10) || 'https://x' AS message FROM orders
""")
def badges(t: Tables) -> DataFrame:
    k = _key()
    return t.orders.select(
        "o_orderkey", consensus.badge(_case(k, "confirmed", "inferred", "aggregator_only", "assumed")).alias("badge"), consensus.tooltip(F.array("o_orderstatus", "o_orderpriority"), k % 5).alias("tooltip"),
        publish.message(F.repeat("o_orderpriority", 50), F.lit("C"), F.lit("https://x")).alias("message"))


@query("""
SELECT coalesce(provider, 'none') AS provider, count(*) AS n FROM (SELECT CASE event_type WHEN 'view' THEN 'groq' WHEN 'click' THEN 'gemini' END AS provider FROM events) GROUP BY 1
""")
def provider_counts(t: Tables) -> DataFrame:
    return A.provider_counts(t.events.select(F.when(F.col("event_type") == "view", "groq").when(F.col("event_type") == "click", "gemini").alias("llm_provider")))


@query("""
SELECT TIMESTAMP '2024-02-01 00:00:00' AS run_ts, '{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) || '}' AS source_counts, 5::BIGINT AS published, 2.5::DOUBLE AS duration_seconds
FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
""")
def run_log_entry(t: Tables) -> DataFrame:
    by_source = t.events.groupBy(F.col("event_type").alias("source_name")).agg(F.count(F.lit(1)).alias("n"))
    empty = t.spark.createDataFrame([], "run_ts timestamp_ntz, source_counts map<string,bigint>, published long, errors array<string>, duration_seconds double")
    return state.logged(empty, F.lit("2024-02-01").cast("timestamp_ntz"), by_source, 5, [], 2.5).withColumn("source_counts", F.to_json("source_counts")).drop("errors")


@query("""
SELECT 'user' || user_id AS feed, date_trunc('second', max(ts)) AS latest, date_trunc('second', max(ts)) < TIMESTAMP '2024-01-30 00:00:00' AS stale FROM events GROUP BY 1
""")
def stale_feeds(t: Tables) -> DataFrame:
    published = F.date_format(F.col("ts").cast("timestamp"), "dd MMM yyyy HH:mm:ss 'GMT'")
    d = t.events.select(F.concat(F.lit("user"), _s(F.col("user_id"))).alias("feed"), F.concat(F.lit("Mon, "), published).alias("published"))
    out = feeds.stale_feeds(d, F.lit("2024-02-06").cast("timestamp"))
    return out.withColumn("latest", F.col("latest").cast("timestamp_ntz"))


@query("""
WITH h AS (SELECT page_id, substr(sha256(html), 1, 16) AS hash FROM pages) SELECT page_id, hash FROM h WHERE page_id % 3 <> 0
""")
def changed_pages(t: Tables) -> DataFrame:
    pages = t.pages.select(_s(F.col("page_id")).alias("board"), "html", "page_id")
    seen = pages.select(F.lit("page").alias("ats"), F.col("board").alias("slug"), F.when(F.col("page_id") % 3 == 0, text.hash_id(F.col("html"))).otherwise("old").alias("status"))
    return feeds.changed_pages(pages, seen).select("page_id", "hash")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 AND d IN ('auto_include', 'low_score') THEN 'llm_review' ELSE d END AS decision FROM (SELECT o_orderkey,
 CASE WHEN o_orderkey % 5 = 0 AND score < 15 THEN 'auto_reject' WHEN o_orderkey % 5 = 0 THEN 'llm_review' WHEN score >= 50 AND o_orderkey % 3 = 0 THEN 'auto_include' WHEN score >= 15 THEN 'llm_review' ELSE 'low_score' END AS d
 FROM (SELECT o_orderkey, o_orderkey % 80 AS score FROM orders))
""")
def keyword_routing(t: Tables) -> DataFrame:
    k = _key()
    return t.orders.select("o_orderkey", scoring.route(k % 80, k % 5 == 0, k % 3 == 0, k % 4 == 0, Lexicon()).alias("decision"))
