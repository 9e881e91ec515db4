"""Daily snapshots, top-k lists, pivots, trends, streaks and budgets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.stats import exclusive_quantile
from gleaner.runtime import stored


def counted(df: DataFrame, column: Column, default: str, kind: str) -> DataFrame:
    """(stat_type, stat_key, stat_value): rows by value, null and '' under ``default``."""
    key = F.coalesce(F.nullif(column, F.lit("")), F.lit(default))
    return df.groupBy(key.alias("stat_key")).agg(F.count(F.lit(1)).alias("stat_value")).select(F.lit(kind).alias("stat_type"), "stat_key", "stat_value")


def counted_by(df: DataFrame, by: Column, key: Column, kind: str, count: Column | None = None) -> DataFrame:
    """(stat_date, stat_type, stat_key, stat_value): ``count``, by default rows, of each day and key."""
    value = F.count(F.lit(1)) if count is None else count
    return df.groupBy(by.alias("stat_date"), key.alias("stat_key")).agg(value.alias("stat_value")).select("stat_date", F.lit(kind).alias("stat_type"), "stat_key", "stat_value")


def tallied(df: DataFrame, by: list[str], conditions: dict[str, Column]) -> DataFrame:
    """One row a group, or one in all: rows as n, and how many meet each condition, null as not met."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()])


def top(df: DataFrame, column: Column, n: int) -> DataFrame:
    """The n most frequent values by count then name; blanks take a place and are then dropped."""
    counts = df.groupBy(F.coalesce(column, F.lit("")).alias("stat_key")).agg(F.count(F.lit(1)).alias("stat_value"))
    return counts.orderBy(F.desc("stat_value"), "stat_key").limit(n).where("stat_key <> ''")


def exploded(df: DataFrame, column: Column, separator: str = ",") -> DataFrame:
    """Counts of the trimmed parts of a separated text."""
    parts = df.select(F.explode(F.split(column, separator)).alias("p")).select(F.trim("p").alias("stat_key"))
    return parts.where("stat_key <> ''").groupBy("stat_key").agg(F.count(F.lit(1)).alias("stat_value"))


def quartiles(df: DataFrame, group: Column, value: Column) -> DataFrame:
    """(stat_key, p25, p50, p75) of groups of three or more, by exclusive interpolation.

    Values are counted per distinct amount first, so a group's array holds each rank's amount
    from a bounded number of distinct ones.
    """
    sorted_values = F.sort_array(F.collect_list("v"))
    out = df.select(group.alias("stat_key"), value.alias("v")).where("v is not null").groupBy("stat_key").agg(sorted_values.alias("a"))
    return out.where(F.size("a") >= 3).select("stat_key", *[exclusive_quantile(F.col("a"), q).alias(f"p{q * 25}") for q in (1, 2, 3)])


def running(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """df with the sum of ``value`` through each row in a total ``order``, without bringing all rows into one task.

    Ranges of the order are written with their number and summed; each then starts with the sum of
    those before it. Only one sum a range is gathered.
    """
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = stored(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_n"))
    before = sums.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.sum(value).over(within)).drop("_part", "_before")


def quartiles_at_scale(df: DataFrame, group: Column, value: Column) -> DataFrame:
    """``quartiles`` without collecting or sorting a group in one task: ranks from running counts of distinct amounts."""
    counts = df.select(group.alias("stat_key"), value.alias("v")).where("v is not null").groupBy("stat_key", "v").agg(F.count(F.lit(1)).alias("c"))
    ranked = stored(running(counts, ["stat_key", "v"], "c", "through"))
    groups = ranked.groupBy("stat_key").agg((F.max("through") - F.min(F.col("through") - F.col("c"))).alias("n"), F.min(F.col("through") - F.col("c")).alias("_start"))
    ranked = ranked.join(groups.where("n >= 3"), "stat_key").withColumn("through", F.col("through") - F.col("_start"))
    out = []
    for q in (1, 2, 3):
        j = F.greatest(F.lit(1), F.least(F.floor(F.lit(q) * (F.col("n") + 1) / 4), F.col("n") - 1))
        d = q * (F.col("n") + 1) - 4 * j
        at = lambda k: F.min(F.when(F.col("through") >= k, F.col("v")))
        out += [at(j).alias(f"lo{q}"), at(j + 1).alias(f"hi{q}"), F.max(d).alias(f"d{q}")]
    return ranked.groupBy("stat_key").agg(*out).select(
        "stat_key", *[((F.col(f"lo{q}") * (4 - F.col(f"d{q}")) + F.col(f"hi{q}") * F.col(f"d{q}")) / 4).cast("long").alias(f"p{q * 25}") for q in (1, 2, 3)])


def snapshot(active: DataFrame, day: Column, extra: list[DataFrame] = ()) -> DataFrame:
    """The day's statistics in one long table; write it once, by stat_date."""
    parts = [
        counted(active, F.col("category"), "General PA", "category_count"), counted(active, F.col("seniority"), "Unknown", "seniority_count"),
        counted(active, F.col("is_remote"), "unknown", "remote_count"),
        top(active, F.col("company"), 20).select(F.lit("company_count").alias("stat_type"), "stat_key", "stat_value"),
        exploded(active, F.col("vendors_mentioned")).select(F.lit("vendor_count").alias("stat_type"), "stat_key", "stat_value"),
        active.agg(F.count(F.lit(1)).alias("stat_value")).select(F.lit("total_active").alias("stat_type"), F.lit("all").alias("stat_key"), "stat_value"),
        *extra,
    ]
    salaries = quartiles_at_scale(active, F.coalesce("seniority", F.lit("Unknown")), F.nullif("salary_min", F.lit(0.0)))
    for p in ("p25", "p50", "p75"):
        parts.append(salaries.select(F.lit(f"salary_{p}").alias("stat_type"), "stat_key", F.col(p).alias("stat_value")))
    return reduce(DataFrame.unionByName, parts).select(day.alias("stat_date"), "stat_type", "stat_key", "stat_value")


def stat_slice(stats: DataFrame, day: Column, kind: str) -> DataFrame:
    """(stat_key, stat_value) of one day and type of the stored statistics, largest first, ties by key."""
    return stats.where((F.col("stat_date") == day) & (F.col("stat_type") == kind)).select("stat_key", "stat_value").orderBy(F.desc("stat_value"), "stat_key")


def wide(stats: DataFrame, key: str, kinds: list[str]) -> DataFrame:
    return stats.groupBy(key).pivot("stat_type", kinds).agg(F.max("stat_value"))


def latest(df: DataFrame, order: str, n: int) -> DataFrame:
    """The newest n rows, oldest of them first."""
    return df.orderBy(F.desc(order)).limit(n).orderBy(order)


def zero_streak(runs: DataFrame, order: str, total: str, last: int = 10) -> DataFrame:
    """(streak): how many of the newest ``last`` runs had nothing before the first that had something."""
    newest = runs.orderBy(F.desc(order)).limit(last).withColumn("rn", F.row_number().over(Window.orderBy(F.desc(order))))
    return newest.agg(F.coalesce(F.min(F.when(F.col(total) > 0, F.col("rn"))) - 1, F.count(F.lit(1))).cast("long").alias("streak"))


def streaks(events: DataFrame, key: str, order: list[str], failed: Column, span: int = 10_000) -> DataFrame:
    """events with ``place``, from 1 in a total ``order``, and ``fails``: how many rows of their key have failed in a row up to them.

    A key may hold most rows: they are cut into spans of places, summed up as one row a key and
    span (was there a success, and how many failed since), and only these rows of a key meet.
    """
    placed = stored(numbered(events.withColumn("_failed", F.coalesce(failed, F.lit(False))), order, "place")).withColumn("_span", F.floor((F.col("place") - 1) / span))
    within = Window.partitionBy(key, "_span").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    cut = placed.withColumn("_island", F.count_if(~F.col("_failed")).over(within))
    run = Window.partitionBy(key, "_span", "_island").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("fails", F.count_if("_failed").over(run))
    spans = cut.groupBy(key, "_span").agg(F.max("_island").alias("_resets"), F.max_by("fails", "place").alias("_tail"))
    before = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("_group", F.count_if(F.col("_resets") > 0).over(before))
    after = Window.partitionBy(key, "_group").orderBy("_span").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("_through", F.sum("_tail").over(after))
    carried = spans.withColumn("_carry", F.coalesce(F.lag("_through").over(Window.partitionBy(key).orderBy("_span")), F.lit(0)))
    same = cut[key].eqNullSafe(carried[key]) & (cut["_span"] == carried["_span"])
    joined = cut.join(carried.select(key, "_span", "_carry"), same).drop(carried[key]).drop(carried["_span"])
    return joined.withColumn("fails", F.col("fails") + F.when(F.col("_island") == 0, F.col("_carry")).otherwise(0)).drop("_failed", "_span", "_island", "_carry")


def breaker(events: DataFrame, key: str, order: list[str], failed: Column, trip: int = 5) -> DataFrame:
    """events with consecutive failures so far and whether the breaker is open; success resets."""
    return streaks(events, key, order, failed).withColumn("open", F.col("fails") >= trip).drop("place")


def guarded(events: DataFrame, key: str, order: list[str], failed: Column, trip: int = 5, budget: int = 300) -> DataFrame:
    """events, each a wish to fetch in order of priority, with what becomes of it: fetched, breaker or budget.

    A key that fails ``trip`` times in a row is refused from then on and spends nothing; of the
    rest the first ``budget`` are fetched. A null or empty key is never refused by its failures.
    ``failed`` is what the fetch would give.

    Until the budget is spent a key is refused after the first place where its streak is full,
    whatever the others do, so places of refusal come from streaks; the budget ends at the place of
    the last fetch it pays for, and no key is refused for failures after it.
    """
    named = F.coalesce(F.col(key).cast("string"), F.lit("")) != ""
    run = stored(streaks(events, key, order, failed).withColumn("_named", named))
    tripped = run.where(F.col("_named") & (F.col("fails") >= trip)).groupBy(key).agg(F.min("place").alias("_trip"))
    known = run.join(tripped, key, "left")
    wanted = F.col("_trip").isNull() | (F.col("place") <= F.col("_trip"))
    # The first ``budget`` places that ask: a bounded number of rows, and one value.
    end = known.where(wanted).orderBy("place").limit(budget).agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("last")).first()
    last = F.lit(end.last if end.n == budget else None).cast("long")
    if budget <= 0:
        last = F.lit(0).cast("long")
    spent = F.coalesce(F.col("place") > last, F.lit(False))
    refused = F.col("_trip").isNotNull() & (F.col("place") > F.col("_trip")) & F.coalesce(F.col("_trip") <= last, F.lit(True))
    return known.withColumn("outcome", F.when(refused, "breaker").when(spent, "budget").otherwise("fetched")).drop("_trip", "_named", "fails")


def guard_snapshot(done: DataFrame, key: str, failed: Column, trip: int = 5, budget: int = 300) -> DataFrame:
    """One row over ``guarded`` rows: keys that are refused, failures since each key's last success, fetches paid and the budget."""
    fetched = done.where("outcome = 'fetched'").withColumn("_failed", F.coalesce(failed, F.lit(False)))
    success = fetched.where("not _failed").groupBy(key).agg(F.max("place").alias("_ok"))
    open_ = fetched.join(success, key, "left").where(F.col("_failed") & (F.col("place") > F.coalesce("_ok", F.lit(0)))).groupBy(key).agg(F.count(F.lit(1)).alias("fails"))
    named = F.coalesce(F.col(key).cast("string"), F.lit("")) != ""
    spent = done.agg(F.count_if(F.col("outcome") == "fetched").alias("used"))
    return open_.where(named).agg(F.count_if(F.col("fails") >= trip).alias("tripped"), F.coalesce(F.sum("fails"), F.lit(0)).alias("failures")).join(
        spent, how="cross").withColumn("budget", F.lit(budget).cast("long"))


def within_budget(df: DataFrame, order: list[Column], budget: int) -> DataFrame:
    """The first ``budget`` rows in priority order."""
    return df.orderBy(*order).limit(budget)


def chunked(df: DataFrame, order: list[str], size: int = 20) -> DataFrame:
    """df with the number of the batch each row goes out in."""
    return numbered(df, order, "_nth").withColumn("batch", F.floor((F.col("_nth") - 1) / size)).drop("_nth")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with each row's place from 1 in a total ``order``, without bringing all rows into one task.

    Rows are dealt by range, sorted within their partitions and written with partition and place
    there, so that counting them and numbering them see the same ranges; each partition
    then starts after the rows of those before it. Only one count a partition is gathered.
    """
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = stored(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(
        name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_before", "_at")


def first_n(df: DataFrame, key: str, order: list[Column | str], n: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rn") <= n)


def breaker_summary(failures: DataFrame, trip: int) -> DataFrame:
    """One row over ``failures(host, fails)``: the hosts that tripped, sorted, and all failures."""
    return failures.agg(F.sort_array(F.collect_set(F.when(F.col("fails") >= trip, F.col("host")))).alias("tripped"), F.coalesce(F.sum("fails"), F.lit(0)).alias("failures"))


def provider_counts(df: DataFrame) -> DataFrame:
    """How many rows each classifier provider has answered."""
    return df.groupBy(F.coalesce("llm_provider", F.lit("none")).alias("provider")).agg(F.count(F.lit(1)).alias("n"))


def enrichment_tallies(df: DataFrame) -> DataFrame:
    """One row: rows enriched from a page, and those that an aggregator alone speaks for."""
    source = F.col("enrichment_source")
    return tallied(df, [], {"enriched": source == "page", "aggregator_only": source == "aggregator"}).select("enriched", "aggregator_only", F.col("n").alias("total"))


def cube_counts(df: DataFrame, *columns: str) -> DataFrame:
    """An extension: counts for every combination of the columns, with the level of each."""
    return df.cube(*columns).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))
