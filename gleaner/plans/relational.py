"""Queries over aggregates, windows, joins and state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.config import Lexicon
from gleaner.functions import stats
from gleaner.operators import aggregates as A
from gleaner.operators import consensus, lifecycle, publish, resolve, scoring, state
from gleaner.operators.cache import Cache
from gleaner.operators.outbox import Outbox
from gleaner.plans.registry import Tables, query
from gleaner.runtime import shared_dir



def day():
    return F.to_date("ts")



@query("""
SELECT 'lang_count' AS stat_type, coalesce(nullif(lang, ''), 'none') AS stat_key, count(*) AS stat_value FROM documents GROUP BY 2
UNION ALL SELECT 'event_count', coalesce(nullif(event_type, ''), 'unknown'), count(*) FROM events GROUP BY 2
""")
def group_count_default(t: Tables) -> DataFrame:
    return A.counted(t.documents, F.col("lang"), "none", "lang_count").unionByName(A.counted(t.events, F.col("event_type"), "unknown", "event_count"))


@query("SELECT s_name AS stat_key, count(*) AS stat_value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def top_k_companies(t: Tables) -> DataFrame:
    return A.top(t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")), F.col("s_name"), 20)


@query("SELECT trim(w) AS stat_key, count(*) AS stat_value FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) WHERE trim(w) <> '' GROUP BY 1")
def explode_tag_count(t: Tables) -> DataFrame:
    return A.exploded(t.part, F.col("p_name"), " ")


def _quartile_sql(q: int) -> str:
    j = f"greatest(1, least(CAST(floor({q} * (n + 1) / 4.0) AS BIGINT), n - 1))"
    d = f"({q} * (n + 1) - 4 * {j})"
    return f"CAST(trunc((a[{j}] * (4 - {d}) + a[{j} + 1] * {d}) / 4) AS BIGINT) AS p{q * 25}"


_QUARTILES = "WITH g AS (SELECT o_orderpriority AS stat_key, list_sort(list(o_totalprice)) AS a, count(*) AS n FROM orders GROUP BY 1) SELECT stat_key, " + ", ".join(
    _quartile_sql(q) for q in (1, 2, 3)) + " FROM g WHERE n >= 3"


@query(_QUARTILES)
def exclusive_quantiles(t: Tables) -> DataFrame:
    return A.quartiles_at_scale(t.orders, F.col("o_orderpriority"), F.col("o_totalprice"))


@query("""
SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
 count(*) FILTER (event_type = 'purchase') AS purchase FROM events GROUP BY 1
""")
def eav_pivot(t: Tables) -> DataFrame:
    kinds = ["click", "error", "purchase"]
    long = t.events.groupBy(day().alias("day"), F.col("event_type").alias("stat_type")).agg(F.count(F.lit(1)).alias("stat_value"))
    return A.wide(long, "day", kinds).fillna(0, kinds)


@query("""
SELECT CAST(ts AS DATE) AS stat_date, 'type_count' AS stat_type, event_type AS stat_key, count(*) AS stat_value FROM events GROUP BY 1, 3
UNION ALL SELECT CAST(ts AS DATE), 'total_active', 'all', count(*) FROM events GROUP BY 1
UNION ALL SELECT CAST(ts AS DATE), 'users', 'distinct', count(DISTINCT user_id) FROM events GROUP BY 1
""")
def daily_snapshot_eav(t: Tables) -> DataFrame:
    e = t.events
    return (
        A.counted_by(e, day(), F.col("event_type"), "type_count").unionByName(A.counted_by(e, day(), F.lit("all"), "total_active"))
        .unionByName(A.counted_by(e, day(), F.lit("distinct"), "users", F.countDistinct("user_id")))
    )


@query("""
SELECT event_type AS stat_key, count(*) AS stat_value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' GROUP BY 1 ORDER BY 2 DESC, 1
""")
def stat_slice(t: Tables) -> DataFrame:
    """One slice of the statistics of all days, as a chart reads it."""
    return A.stat_slice(daily_snapshot_eav(t), F.lit("2024-01-10").cast("date"), "type_count")


@query("SELECT *, sum(l_quantity) OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount ROWS UNBOUNDED PRECEDING) AS through FROM lineitem")
def running_sum(t: Tables) -> DataFrame:
    return A.running(t.lineitem, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"], "l_quantity", "through")


@query("SELECT * FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 14) ORDER BY 1")
def trend_last_n(t: Tables) -> DataFrame:
    return A.latest(t.events.groupBy(day().alias("day")).agg(F.count(F.lit(1)).alias("n")), "day", 14)


@query("""
SELECT l_linestatus, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_discount > 0.05) AS discounted,
 CAST(sum(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS BIGINT) AS large FROM lineitem GROUP BY 1
""")
def conditional_tallies(t: Tables) -> DataFrame:
    return A.tallied(t.lineitem, ["l_linestatus"], {
        "returned": F.col("l_returnflag") == "R", "discounted": F.col("l_discount") > 0.05, "large": F.col("l_quantity") > 25})


@query("""
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase' AND value > 480) AS total FROM events GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY day DESC) AS rn FROM d QUALIFY rn <= 10)
SELECT coalesce(min(CASE WHEN total > 0 THEN rn END) - 1, count(*))::BIGINT AS streak FROM r
""")
def zero_run_streak(t: Tables) -> DataFrame:
    hits = (F.col("event_type") == "purchase") & (F.col("value") > 480)
    return A.zero_streak(t.events.groupBy(day().alias("day")).agg(F.count_if(hits).alias("total")), "day", "total")


@query("""
WITH i AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events),
f AS (SELECT event_id, user_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS fails FROM i)
SELECT event_id, user_id, CAST(fails AS BIGINT) AS fails, fails >= 3 AS open FROM f
""")
def breaker_trip(t: Tables) -> DataFrame:
    return A.breaker(t.events, "user_id", ["ts", "event_id"], F.col("event_type") == "error", 3).select("event_id", "user_id", "fails", "open")


_GUARD = """
WITH p AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS place, event_type = 'error' AS failed FROM events),
i AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS g FROM p),
f AS (SELECT *, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY place ROWS UNBOUNDED PRECEDING) AS fails FROM i),
t AS (SELECT user_id, min(place) AS trip FROM f WHERE fails >= 2 GROUP BY 1),
k AS (SELECT f.*, trip FROM f LEFT JOIN t USING (user_id)),
e AS (SELECT max(place) AS last FROM (SELECT place FROM k WHERE trip IS NULL OR place <= trip ORDER BY place LIMIT 5000)),
o AS (SELECT k.*, CASE WHEN trip IS NOT NULL AND place > trip AND trip <= last THEN 'breaker' WHEN place > last THEN 'budget' ELSE 'fetched' END AS outcome FROM k, e)
"""


@query(_GUARD + "SELECT event_id, user_id, place, outcome FROM o")
def fetch_guardrails(t: Tables) -> DataFrame:
    return A.guarded(t.events, "user_id", ["ts", "event_id"], F.col("event_type") == "error", 2, 5000).select("event_id", "user_id", "place", "outcome")


@query(_GUARD + """, s AS (SELECT user_id, max(place) AS ok FROM o WHERE outcome = 'fetched' AND NOT failed GROUP BY 1),
c AS (SELECT user_id, count(*) AS n FROM o LEFT JOIN s USING (user_id) WHERE outcome = 'fetched' AND failed AND place > coalesce(ok, 0) GROUP BY 1)
SELECT count_if(n >= 2)::BIGINT AS tripped, coalesce(sum(n), 0)::BIGINT AS failures, (SELECT count(*) FROM o WHERE outcome = 'fetched') AS used, 5000::BIGINT AS budget FROM c
""")
def guardrail_snapshot(t: Tables) -> DataFrame:
    failed = F.col("event_type") == "error"
    return A.guard_snapshot(A.guarded(t.events, "user_id", ["ts", "event_id"], failed, 2, 5000), "user_id", failed, 2, 5000)


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, floor(o_totalprice / 10000) DESC, o_orderkey LIMIT 300")
def priority_budget(t: Tables) -> DataFrame:
    return A.within_budget(t.orders, [F.asc("o_orderpriority"), F.desc(F.floor(F.col("o_totalprice") / 10000)), F.asc("o_orderkey")], 300).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("SELECT *, CAST(floor((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) / 20) AS BIGINT) AS batch FROM orders")
def batch_chunking(t: Tables) -> DataFrame:
    return A.chunked(t.orders, ["o_orderdate", "o_orderkey"])


def _receive(run: str, batch: int, rows: list[dict]) -> list[dict]:
    """A receiver for the query below: refuses every seventh batch, and every ninth row of the others."""
    if batch % 7 == 3:
        raise OSError("refused")
    return [{"o_orderkey": r["o_orderkey"], "post_id": int(r["o_orderkey"]) + 5} for r in rows if int(r["o_orderkey"]) % 9]


@query("""
WITH b AS (SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) / 20) AS BIGINT) AS batch FROM orders)
SELECT batch, CAST(o_orderkey AS VARCHAR) AS o_orderkey, batch % 7 <> 3 AND o_orderkey % 9 <> 0 AS ok, CASE WHEN batch % 7 <> 3 AND o_orderkey % 9 <> 0 THEN o_orderkey + 5 END AS post_id,
 CASE WHEN batch % 7 = 3 THEN 'OSError: refused' END AS error FROM b
""")
def outbox_send(t: Tables) -> DataFrame:
    box = Outbox(t.spark, f"{shared_dir(t.spark)}/outbox/{uuid.uuid4().hex}", "o_orderkey")
    box.prepare("day", t.orders, ["o_orderdate", "o_orderkey"])
    box.send("day", _receive, 4000)
    return box.outcomes("day")


@query("SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount) AS place FROM lineitem")
def numbered_rows(t: Tables) -> DataFrame:
    return A.numbered(t.lineitem, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"], "place")


@query("SELECT user_id, event_id, rn FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 20")
def first_n_per_group(t: Tables) -> DataFrame:
    return A.first_n(t.events, "user_id", ["ts", "event_id"], 20).select("user_id", "event_id", "rn")


@query("""
SELECT o_orderkey, max_ship FROM (SELECT o_orderkey, max(l_shipdate) AS max_ship FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)
ORDER BY max_ship ASC NULLS FIRST, o_orderkey LIMIT 500
""")
def null_first_pick(t: Tables) -> DataFrame:
    ships = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("max_ship"))
    j = t.orders.join(ships, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.orderBy(F.col("max_ship").asc_nulls_first(), "o_orderkey").limit(500).select("o_orderkey", "max_ship")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate > TIMESTAMP '2000-06-01')")
def negative_cache_anti(t: Tables) -> DataFrame:
    status = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("last_checked"), F.lit("not_found").alias("status")).where(
        F.col("o_orderdate") > F.lit("2000-06-01").cast("timestamp_ntz"))
    return state.uncached(t.customer, status, ["c_custkey"], F.lit("2000-06-01").cast("date")).select("c_custkey", "c_name")


@query("""
SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') THEN 'active'
 WHEN EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) THEN 'likely_closed' END AS verdict FROM orders
""")
def membership_three_way(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_custkey").alias("slug"), F.col("o_orderkey").alias("jid"))
    boards = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("slug"))
    jobs = t.lineitem.where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("jid"))
    return lifecycle.membership(rows, boards, jobs, ["slug"], ["jid"]).select("o_orderkey", "verdict")


@query("""
SELECT DISTINCT o_orderkey FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS seen FROM lineitem GROUP BY 1) s ON o_orderkey = s.l_orderkey
LEFT JOIN (SELECT l_orderkey, max(l_linestatus) AS status FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r ON o_orderkey = r.l_orderkey
WHERE seen < TIMESTAMP '1999-01-01' AND (status IS NULL OR status <> 'O')
""")
def eav_outer_join(t: Tables) -> DataFrame:
    li = t.lineitem
    seen = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("seen"))
    status = li.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linestatus").alias("status"))
    return t.orders.join(seen, "o_orderkey").join(status, "o_orderkey", "left").where(
        (F.col("seen") < F.lit("1999-01-01").cast("timestamp_ntz")) & (F.col("status").isNull() | (F.col("status") != "O"))).select("o_orderkey").distinct()


@query("""
WITH t AS (SELECT o_orderkey, o_totalprice AS price, CAST(o_orderdate AS DATE) AS date_posted, DATE '1999-01-01' AS first_seen_date, DATE '1999-01-01' AS last_seen_date FROM orders WHERE o_orderkey % 3 <> 0),
s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice + 1 END AS price, CAST(o_orderdate AS DATE) - 2 AS date_posted FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, round(coalesce(s.price, t.price), 2) AS price, least(t.date_posted, s.date_posted) AS date_posted,
 coalesce(first_seen_date, DATE '2000-01-01') AS first_seen_date, CASE WHEN s.o_orderkey IS NOT NULL THEN DATE '2000-01-01' ELSE last_seen_date END AS last_seen_date, t.o_orderkey IS NULL AS is_brand_new
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
""")
def keyed_upsert(t: Tables) -> DataFrame:
    o, day = t.orders, F.to_date("o_orderdate")
    old = F.lit("1999-01-01").cast("date")
    target = o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_totalprice").alias("price"), day.alias("date_posted"), old.alias("first_seen_date"), old.alias("last_seen_date"))
    source = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice") + 1).alias("price"), F.date_sub(day, 2).alias("date_posted"))
    return state.merge(target, source, "o_orderkey", F.lit("2000-01-01").cast("date")).withColumn("price", F.round("price", 2))


@query("""
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'active' ELSE 'likely_closed' END AS old, CASE WHEN o_orderstatus = 'F' THEN 'likely_closed' WHEN o_orderstatus = 'O' THEN 'active' ELSE 'unknown' END AS new FROM orders)
SELECT o_orderkey, old, new FROM a WHERE old <> new AND new <> 'unknown'
""")
def state_transition(t: Tables) -> DataFrame:
    old = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "active").otherwise("likely_closed").alias("s"))
    new = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "likely_closed").when(F.col("o_orderstatus") == "O", "active").otherwise("unknown").alias("s"))
    return state.transitions(old, new, "o_orderkey", "s")


@query("""
WITH j AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS seen, CAST(o_orderdate AS DATE) - 30 AS first_seen,
 CASE WHEN o_orderstatus = 'F' THEN 'likely_closed' ELSE 'active' END AS st, CASE WHEN o_orderkey % 2 = 0 THEN 'likely_closed' ELSE 'active' END AS vd FROM orders),
g AS (SELECT *, (st = 'likely_closed' AND vd = 'likely_closed') OR date_diff('day', seen, DATE '2001-08-01') >= 21 AS gone, date_diff('day', seen, DATE '2001-08-01') AS unseen FROM j)
SELECT o_orderkey, CASE WHEN gone OR (st = 'active' AND unseen >= 7) THEN 'likely_closed' ELSE st END AS lifecycle_status, CASE WHEN gone THEN 0 ELSE 1 END AS is_active,
 CASE WHEN gone THEN greatest(1, date_diff('day', first_seen, DATE '2001-08-01')) END::BIGINT AS days_active FROM g
""")
def archive_two_track(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    jobs = t.orders.select(
        "o_orderkey", day.alias("last_seen_date"), F.date_sub(day, 30).alias("first_seen_date"), F.when(F.col("o_orderstatus") == "F", "likely_closed").otherwise("active").alias("lifecycle_status"),
        F.when(F.col("o_orderkey") % 2 == 0, "likely_closed").otherwise("active").alias("last_lifecycle_verdict"), F.lit(1).alias("is_active"),
        F.lit(None).cast("date").alias("archived_date"), F.lit(None).cast("int").alias("days_active"))
    return lifecycle.archived(jobs, F.lit("2001-08-01").cast("date")).select("o_orderkey", "lifecycle_status", "is_active", F.col("days_active").cast("long").alias("days_active"))


_VOTES = """
WITH o AS (SELECT l_orderkey, l_returnflag AS value, sum(CAST(l_quantity AS BIGINT)) AS w, min(l_linenumber) AS first FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, sum(w) OVER (PARTITION BY l_orderkey) AS total,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY w DESC, CASE value WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, first, value) AS rn FROM o)
"""


def _votes(t: Tables) -> DataFrame:
    obs = t.lineitem.select("l_orderkey", F.lit("flag").alias("field"), F.col("l_linenumber").alias("seq"), F.col("l_suppkey").cast("string").alias("source"),
                            F.col("l_returnflag").alias("value"), F.col("l_quantity").cast("long").alias("confidence"))
    return consensus.vote(obs, "l_orderkey", {"R": 0, "A": 1, "N": 2})


@query(_VOTES + "SELECT l_orderkey, value, round(w / total, 4) AS confidence FROM r WHERE rn = 1")
def weighted_vote(t: Tables) -> DataFrame:
    return _votes(t).select("l_orderkey", "value", F.round("confidence", 4).alias("confidence"))


@query(_VOTES + """
SELECT o_orderkey, CASE WHEN value IS NULL OR value = flag THEN flag WHEN w >= 0.65 * total THEN value ELSE flag END AS value,
 CASE WHEN value IS NULL THEN 'none' WHEN value = flag THEN 'tied' WHEN w >= 0.65 * total THEN 'override' ELSE 'below_threshold' END AS outcome
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'N' ELSE 'A' END AS flag FROM orders) LEFT JOIN (SELECT * FROM r WHERE rn = 1) ON o_orderkey = l_orderkey
""")
def consensus_override(t: Tables) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "F", "R").when(F.col("o_orderstatus") == "O", "N").otherwise("A")
    j = t.orders.select("o_orderkey", flag.alias("flag")).join(_votes(t), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.select("o_orderkey", consensus.applied(F.col("flag"), F.col("value"), F.round("confidence", 9)).alias("a")).select("o_orderkey", "a.value", "a.outcome")


@query("SELECT doc_id, n FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY n_chars DESC, doc_id) AS rn, count(*) OVER (PARTITION BY md5(text)) AS n FROM documents) WHERE rn = 1")
def doc_exact_dedup(t: Tables) -> DataFrame:
    # Digests stand for texts, and the count is combined before the shuffle.
    return t.documents.groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).select("doc_id", "n")


@query("""
WITH n AS (SELECT o_custkey % 50 AS k, n_name, min(o_orderkey) AS first FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 GROUP BY 1, 2),
g AS (SELECT k, list(n_name ORDER BY first) AS l FROM n GROUP BY 1)
SELECT k, CASE WHEN len(l) > 3 THEN 'Multiple Locations (' || len(l) || ')' ELSE array_to_string(l, '; ') END AS location FROM g
""")
def location_merge(t: Tables) -> DataFrame:
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    firsts = j.groupBy((F.col("o_custkey") % 50).alias("k"), "n_name").agg(F.min("o_orderkey").alias("first"))
    names = F.transform(F.sort_array(F.collect_list(F.struct("first", "n_name"))), lambda x: x["n_name"])
    return firsts.groupBy("k").agg(resolve.merged_locations(names).alias("location"))


@query("""
WITH q AS (SELECT user_id, count(*) % 3 AS attempts FROM events WHERE event_type = 'error' GROUP BY 1),
o AS (SELECT user_id, max(value) > 150 AS ok FROM events WHERE event_type = 'purchase' GROUP BY 1 HAVING count(*) > 12)
SELECT user_id, attempts + CASE WHEN ok IS NOT NULL THEN 1 ELSE 0 END AS attempts FROM q LEFT JOIN o USING (user_id)
WHERE NOT coalesce(ok, false) AND attempts + CASE WHEN ok IS NOT NULL THEN 1 ELSE 0 END < 3
""")
def retry_queue_step(t: Tables) -> DataFrame:
    queue = t.events.where("event_type = 'error'").groupBy("user_id").agg((F.count(F.lit(1)) % 3).alias("attempts"))
    done = t.events.where("event_type = 'purchase'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), (F.max("value") > 150).alias("ok")).where("n > 12")
    return state.retried(queue, done.select("user_id", "ok"), "user_id").select("user_id", "attempts")


@query("SELECT p_partkey, p_name FROM part WHERE p_brand IN ('Brand#1', 'Brand#2') AND p_type IN ('ECONOMY', 'PROMO') AND contains(lower(p_name), 'ring')")
def facet_filter(t: Tables) -> DataFrame:
    return publish.filtered(t.part, {"p_brand": ["Brand#1", "Brand#2"], "p_type": ["ECONOMY", "PROMO"]}, "Ring", "p_name").select("p_partkey", "p_name")


@query("SELECT 'p_brand' AS facet, p_brand AS value FROM part GROUP BY 2 UNION ALL SELECT 'p_type', p_type FROM part GROUP BY 2")
def facet_values(t: Tables) -> DataFrame:
    return publish.facets(t.part, ["p_brand", "p_type"])


@query("""
SELECT 'type' AS series, event_type AS stat_key, count(*) AS stat_value, row_number() OVER (ORDER BY count(*) DESC, event_type) AS place FROM events GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'user', CAST(user_id AS VARCHAR), count(*), row_number() OVER (ORDER BY count(*) DESC, CAST(user_id AS VARCHAR)) AS place FROM events GROUP BY 2) WHERE place <= 15
""")
def dashboard_payload(t: Tables) -> DataFrame:
    place = F.row_number().over(Window.orderBy(F.desc("stat_value"), "stat_key"))
    series = lambda c, name, n: A.top(t.events, F.col(c).cast("string"), n).select(F.lit(name).alias("series"), "stat_key", "stat_value", place.alias("place"))
    return series("event_type", "type", 10).unionByName(series("user_id", "user", 15))


@query("SELECT lang, source, count(*) AS n, grouping_id(lang, source) AS level FROM documents GROUP BY CUBE (lang, source)")
def cube_counts(t: Tables) -> DataFrame:
    return A.cube_counts(t.documents, "lang", "source")


@query("""
WITH s AS (SELECT s_suppkey, s_acctbal AS raw, s_suppkey % 2 = 0 AS titled, s_suppkey < 1000 AND s_suppkey % 3 = 0 AS listed FROM supplier)
SELECT s_suppkey, listed, round(least(CASE WHEN titled AND listed THEN raw + 10 WHEN listed AND raw > 14 THEN 14 ELSE raw END, 100), 2) AS score FROM s
""")
def vendor_cap_boost(t: Tables) -> DataFrame:
    names = frozenset(f"supplier#{i}" for i in range(0, 1000, 3))
    company = F.concat(F.lit(" Supplier#"), F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 4 == 0, ", Inc.").when(F.col("s_suppkey") % 4 == 1, " Co").otherwise(""))
    listed = scoring.boosted(company, names)
    score = scoring.with_boost(F.col("s_acctbal"), F.col("s_suppkey") % 2 == 0, listed, Lexicon(boost_companies=names))
    return t.supplier.select("s_suppkey", listed.alias("listed"), F.round(score, 2).alias("score"))


@query("""
SELECT o_orderkey, o_clerk_id, o_orderstatus FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'post_' || o_orderkey ELSE o_orderpriority END AS o_clerk_id,
 CASE WHEN o_orderkey % 3 = 0 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus FROM orders)
""")
def assigned_columns(t: Tables) -> DataFrame:
    table = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("o_clerk_id"), "o_orderstatus")
    new = t.orders.where("o_orderkey % 3 = 0").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("post_"), F.col("o_orderkey").cast("string"))).otherwise("").alias("o_clerk_id"), F.lit("Z").alias("o_orderstatus"))
    return state.assigned(table, new, "o_orderkey", ["o_clerk_id", "o_orderstatus"])


@query("""
SELECT o_orderkey AS external_id, CAST(o_orderdate AS DATE) AS last_seen_date FROM orders WHERE o_orderstatus = 'O' AND date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') > 30
ORDER BY o_orderdate, o_orderkey LIMIT 100
""")
def unseen_rows(t: Tables) -> DataFrame:
    jobs = t.orders.select(F.col("o_orderkey").alias("external_id"), F.to_date("o_orderdate").alias("last_seen_date"), (F.col("o_orderstatus") == "O").cast("int").alias("is_active"))
    return lifecycle.unseen(jobs, F.lit("2001-08-01").cast("date"), 30).select("external_id", "last_seen_date")


@query("""
SELECT o_orderkey AS external_id, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) > 150 AS deferred FROM orders
""")
def deferred_calls(t: Tables) -> DataFrame:
    return lifecycle.with_budget(t.orders.withColumnRenamed("o_orderkey", "external_id"), [F.desc("o_totalprice"), "external_id"]).select("external_id", "deferred")


_CHECKED = """
SELECT o_orderkey AS external_id, CASE o_orderstatus WHEN 'F' THEN 'likely_closed' WHEN 'O' THEN 'active' ELSE 'unknown' END AS verdict, CASE WHEN o_orderkey % 2 = 0 THEN 200 END AS status,
 o_orderkey % 5 = 0 AS deferred, CASE WHEN o_orderkey % 7 = 0 THEN 'likely_closed' ELSE 'active' END AS old_status,
 CASE o_orderstatus WHEN 'F' THEN 'likely_closed' WHEN 'O' THEN 'active' ELSE CASE WHEN o_orderkey % 7 = 0 THEN 'likely_closed' ELSE 'active' END END AS new_status FROM orders
"""


@query(f"""
WITH c AS ({_CHECKED})
SELECT count(*) AS candidates, count(*) FILTER (NOT deferred) AS checked, count(*) FILTER (deferred) AS deferred, count(*) FILTER (verdict = 'active') AS active,
 count(*) FILTER (verdict = 'likely_closed') AS closed, count(*) FILTER (verdict = 'unknown') AS unknown, count(*) FILTER (status IS NULL AND NOT deferred) AS by_board,
 count(*) FILTER (old_status <> new_status AND new_status = 'likely_closed') AS newly_closed, count(*) FILTER (old_status <> new_status AND new_status = 'active') AS reopened,
 md5(string_agg(CAST(external_id AS VARCHAR), ',' ORDER BY external_id) FILTER (old_status <> new_status AND new_status = 'active')) AS reopened_ids FROM c
""")
def lifecycle_tallies(t: Tables) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    old = F.when(key % 7 == 0, "likely_closed").otherwise("active")
    verdict = F.when(status == "F", "likely_closed").when(status == "O", "active").otherwise("unknown")
    checked = t.orders.select(key.alias("external_id"), verdict.alias("verdict"), F.when(key % 2 == 0, 200).alias("status"), (key % 5 == 0).alias("deferred"),
                              old.alias("old_status"), lifecycle.with_verdict(old, verdict).alias("new_status"))
    return lifecycle.tallies(checked).drop("closed_ids").withColumn("reopened_ids", F.md5(F.array_join(F.col("reopened_ids").cast("array<string>"), ",").cast("binary")))


@query(_VOTES + """
SELECT count(*) FILTER (o = 'override') AS override, count(*) FILTER (o = 'tied') AS tied, count(*) FILTER (o = 'below_threshold') AS below_threshold, count(*) FILTER (o = 'none') AS none, count(*) AS total
FROM (SELECT CASE WHEN value IS NULL THEN 'none' WHEN value = flag THEN 'tied' WHEN w >= 0.65 * total THEN 'override' ELSE 'below_threshold' END AS o
 FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'N' ELSE 'A' END AS flag FROM orders) LEFT JOIN (SELECT * FROM r WHERE rn = 1) ON o_orderkey = l_orderkey)
""")
def consensus_tallies(t: Tables) -> DataFrame:
    return consensus.outcome_tallies(consensus_override(t))


@query("""
SELECT list_sort(list(DISTINCT CAST(user_id AS VARCHAR)) FILTER (n >= 8)) AS tripped, CAST(sum(n) AS BIGINT) AS failures FROM (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
""")
def breaker_summary(t: Tables) -> DataFrame:
    fails = t.events.where("event_type = 'error'").groupBy(F.col("user_id").cast("string").alias("host")).agg(F.count(F.lit(1)).alias("fails"))
    return A.breaker_summary(fails, 8)


@query("""
WITH s AS (SELECT c_nationkey AS slug, CASE WHEN c_acctbal > 0 THEN 'ok' ELSE 'not_found' END AS status, CAST(floor(abs(c_acctbal)) AS INTEGER) % 50 AS n,
 date_trunc('month', CAST(o_orderdate AS DATE)) AS checked FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey < 12),
n AS (SELECT slug, status, n FROM s QUALIFY row_number() OVER (PARTITION BY slug ORDER BY checked DESC, n DESC, status DESC) = 1)
SELECT 'gh' AS ats, CAST(n_nationkey AS VARCHAR) AS slug, coalesce(n.status, 'old') AS status, CASE WHEN n.slug IS NULL THEN DATE '2000-01-01' ELSE DATE '2001-08-01' END AS last_checked,
 coalesce(n.n, 0) AS jobs_found FROM nation LEFT JOIN n ON n_nationkey = n.slug
""")
def slug_upsert(t: Tables) -> DataFrame:
    """A slug is scanned once for every order of its customers; many scans are of one month and of equal counts."""
    old = t.nation.select(F.lit("gh").alias("ats"), F.col("n_nationkey").cast("string").alias("slug"), F.lit("old").alias("status"), F.lit("2000-01-01").cast("date").alias("last_checked"), F.lit(0).alias("jobs_found"))
    scans = t.customer.where("c_nationkey < 12").join(t.orders, F.col("o_custkey") == F.col("c_custkey")).select(
        F.lit("gh").alias("ats"), F.col("c_nationkey").cast("string").alias("slug"), F.when(F.col("c_acctbal") > 0, "ok").otherwise("not_found").alias("status"),
        (F.floor(F.abs("c_acctbal")).cast("int") % 50).alias("jobs_found"), F.trunc(F.to_date("o_orderdate"), "month").alias("checked_at"))
    return state.slug_status(old, scans, F.lit("2001-08-01").cast("date"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def cached_counts(t: Tables) -> DataFrame:
    """The second read of a result that is kept until its table changes."""
    base = f"{shared_dir(t.spark)}/cache/{uuid.uuid4().hex}"
    table = state.VersionedTable(t.spark, f"{base}/events")
    table.write(t.events)
    kept = Cache(t.spark, f"{base}/results")
    count = lambda df: df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    kept.get("counts", table, count)
    return kept.get("counts", table, count)


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 8 = 0 THEN 'LinkedIn' WHEN p_partkey % 8 = 1 THEN 'Monster' WHEN p_partkey % 8 = 2 THEN 'Niche Board' WHEN p_partkey % 8 = 3 THEN 'Unknown' ELSE p_brand END AS source,
 CASE WHEN p_type = 'ECONOMY' THEN 'Relevant' WHEN p_type = 'PROMO' THEN 'Partial' ELSE 'Auto' END AS relevance FROM part
""")
def display_names(t: Tables) -> DataFrame:
    k = F.col("p_partkey") % 8
    source = F.when(k == 0, "jobspy_linkedin").when(k == 1, "jobspy_monster").when(k == 2, "siop").when(k == 3, "").otherwise(F.col("p_brand"))
    kind = F.when(F.col("p_type") == "ECONOMY", "RELEVANT").when(F.col("p_type") == "PROMO", "PARTIALLY_RELEVANT").otherwise("NOT_RELEVANT")
    return t.part.select("p_partkey", publish.source_label(source).alias("source"), publish.relevance(kind).alias("relevance"))


_AGES = "greatest(0, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01'))"


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Seen ' ELSE '' END || CASE {_AGES} WHEN 0 THEN 'Today' WHEN 1 THEN '1 day ago' ELSE {_AGES} || ' days ago' END AS age, {_AGES} AS place FROM orders
""")
def freshness_labels(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    posted, seen, now = F.when(F.col("o_orderkey") % 3 != 0, day), day, F.lit("2001-08-01").cast("date")
    return t.orders.select("o_orderkey", stats.freshness_label(posted, seen, now).alias("age"), stats.freshness_order(stats.days_since(posted, seen, now)).cast("long").alias("place"))


@query("""
SELECT o_orderkey AS post_id, 'o_orderpriority' AS meta_key, substr(o_orderpriority, 1, 3) AS meta_value FROM orders WHERE o_orderpriority IS NOT NULL
UNION ALL SELECT o_orderkey, 'o_orderstatus', substr(o_orderstatus, 1, 3) FROM orders WHERE o_orderstatus IS NOT NULL
""")
def meta_rows(t: Tables) -> DataFrame:
    return publish.meta(t.orders.withColumnRenamed("o_orderkey", "post_id"), ["o_orderpriority", "o_orderstatus", "absent"], "post_id", 3)


@query("""
SELECT o_orderkey AS post_id FROM orders WHERE o_orderstatus = 'O' AND strftime(o_orderdate, '%Y-%m-%d') < '2000-01-01' ORDER BY strftime(o_orderdate, '%Y-%m-%d'), o_orderkey LIMIT 100
""")
def due_posts(t: Tables) -> DataFrame:
    posts = t.orders.select(F.col("o_orderkey").alias("post_id"), F.when(F.col("o_orderstatus") == "O", "publish").otherwise("draft").alias("status"))
    metas = t.orders.select(F.col("o_orderkey").alias("post_id"), F.lit("last_seen_active").alias("meta_key"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("meta_value"))
    return publish.due(posts, metas, "last_seen_active", "2000-01-01").select("post_id")


@query("""
SELECT o_orderkey AS post_id FROM orders WHERE o_orderstatus IN ('O', 'F') AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
""")
def posts_by_meta(t: Tables) -> DataFrame:
    posts = t.orders.select(F.col("o_orderkey").alias("post_id"), F.when(F.col("o_orderstatus") == "O", "publish").when(F.col("o_orderstatus") == "F", "archived").otherwise("draft").alias("status"))
    metas = t.lineitem.select(F.col("l_orderkey").alias("post_id"), F.lit("flag").alias("meta_key"), F.col("l_returnflag").alias("meta_value"))
    return publish.holders(posts, metas, "flag", ["R"]).select("post_id")
