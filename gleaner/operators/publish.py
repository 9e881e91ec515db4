"""Outgoing payloads, digests, views and receiver-side merges."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from gleaner import config as C
from gleaner.functions.text import html_escape
from gleaner.functions.urls import host, is_aggregator


def payload(df: DataFrame, fields: list[str]) -> Column:
    """JSON of the allowed fields that are there; flags as 0 and 1, other non-numbers as text."""
    kinds = dict(df.dtypes)
    out = []
    for f in fields:
        if f not in kinds:
            continue
        c = F.col(f)
        numeric = kinds[f] in ("int", "bigint", "double", "float", "smallint", "tinyint")
        out.append((c.cast("int") if kinds[f] == "boolean" else c if numeric else c.cast("string")).alias(f))
    return F.to_json(F.struct(*out))


def sent(df: DataFrame, send: Callable[[list[dict]], Iterable[dict]], key: str, size: int = 20) -> DataFrame:
    """Send ``payload`` rows in batches from the executors; (key, ok, post_id) for each row.

    ``send`` gets a batch and returns the accepted rows' keys and post ids; a batch that fails
    is not ok as a whole.
    """
    def run(frames):
        import pandas as pd

        for frame in frames:
            for i in range(0, len(frame), size):
                part = frame.iloc[i : i + size]
                try:
                    got = {r[key]: r.get("post_id") for r in send(part.to_dict("records"))}
                except OSError:
                    got = {}
                yield pd.DataFrame({key: part[key], "ok": [k in got for k in part[key]], "post_id": [got.get(k) for k in part[key]]})

    return df.select(key, "payload").mapInPandas(run, f"{key} string, ok boolean, post_id long")


def qualifies(fit: Column, kind: Column) -> Column:
    return (fit >= 50) | F.coalesce(kind == "RELEVANT", F.lit(False))


def message(title: Column, company: Column, url: Column) -> Column:
    return F.concat(F.substring(title, 1, 250), F.lit(" @ "), company, F.lit("\n"), url)


def relevance(kind: Column) -> Column:
    """The name a class is shown by; everything else was decided automatically."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in C.RELEVANCE_NAMES.items() for x in pair])[kind], F.lit("Auto"))


def source_label(source: Column) -> Column:
    """The name a source is shown by: known ones by a map, other scraped sites by their own, capitalised."""
    known = F.create_map(*[F.lit(x) for pair in C.SOURCE_NAMES.items() for x in pair])[source]
    site = F.regexp_extract(source, "^jobspy_(.*)$", 1)
    scraped = F.when(source.startswith("jobspy_"), F.concat(F.upper(F.substring(site, 1, 1)), F.substring(site, F.lit(2), F.length(site))))
    return F.when(F.coalesce(source, F.lit("")) == "", "Unknown").otherwise(F.coalesce(known, scraped, source))


def meta(df: DataFrame, allowed: list[str], key: str = "external_id", most: int = 500) -> DataFrame:
    """(key, meta_key, meta_value): the allowed columns that are there, as texts of at most ``most`` characters."""
    names = [c for c in allowed if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("meta_key"), F.substring(F.col(c).cast("string"), 1, most).alias("meta_value")) for c in names])
    return df.select(key, F.explode(pairs).alias("m")).select(key, "m.*").where("meta_value is not null")


def holders(posts: DataFrame, metas: DataFrame, name: str, values: list[str], statuses: tuple[str, ...] = ("publish", "archived")) -> DataFrame:
    """Posts of these statuses that hold one of ``values`` under the meta key ``name``."""
    hit = metas.where((F.col("meta_key") == name) & F.col("meta_value").isin(*values)).select("post_id").distinct()
    return posts.where(F.col("status").isin(*statuses)).join(hit, "post_id", "left_semi")


def due(posts: DataFrame, metas: DataFrame, name: str, before: str, most: int = 100) -> DataFrame:
    """Published posts whose meta value ``name`` lies before a cutoff, oldest first, at most ``most``."""
    old = metas.where((F.col("meta_key") == name) & (F.col("meta_value") < before)).groupBy("post_id").agg(F.min("meta_value").alias("_at"))
    return posts.where("status = 'publish'").join(old, "post_id").orderBy("_at", "post_id").limit(most).drop("_at")


def status_counts(posts: DataFrame) -> DataFrame:
    """One row: how many posts are published and archived, and all together."""
    return posts.agg(F.count_if(F.col("status") == "publish").alias("published"), F.count_if(F.col("status") == "archived").alias("archived"), F.count(F.lit(1)).alias("total"))


def unresolved(df: DataFrame) -> DataFrame:
    """Rows whose apply URL still leads to an aggregator, but for sources where that is the page to apply at."""
    return df.where(is_aggregator(host(F.coalesce("apply_url", F.lit("")))) & ~F.coalesce("source_name", F.lit("")).isin(*C.TERMINAL_SOURCES)).select("external_id", "source_name", "apply_url")


def shadowed(df: DataFrame, stage: str, path: str) -> None:
    """Append a decision log of one stage as lines of JSON."""
    df.select(F.lit(stage).alias("stage"), F.current_timestamp().alias("at"), *df.columns).write.mode("append").json(path)


def dashboard(series: DataFrame) -> DataFrame:
    """One row (payload): ``series(series, stat_key, stat_value, place)`` as JSON, ready to be pushed."""
    each = series.groupBy("series").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "stat_key", "stat_value"))), lambda r: F.struct(r["stat_key"].alias("key"), r["stat_value"].alias("value"))).alias("rows"))
    return each.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("series", "rows"))))).alias("payload"))


def digest_text(df: DataFrame) -> DataFrame:
    """A plain line per record."""
    return df.select("external_id", F.concat_ws(" — ", "title", "company").alias("line"))


def digest(df: DataFrame) -> DataFrame:
    """(html): one escaped line per record, by key."""
    line = F.concat(F.lit("<li>"), html_escape(F.col("title")), F.lit(" — "), html_escape(F.col("company")), F.lit("</li>"))
    return df.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("external_id", line.alias("l")))), lambda x: x["l"]), "\n").alias("html"))


def ping(counts: DataFrame, errors: DataFrame, most: int = 50) -> Row:
    """Health report: counts, the first errors, how many there are and whether some are left out."""
    n = errors.count()
    first = [r[0] for r in errors.orderBy(errors.columns[0]).limit(most).collect()]
    return Row(total=counts.agg(F.sum("n")).first()[0] or 0, errors=first, n_errors=n, truncated=n > most)


#: Characters of long texts, as they are in memory, that one task of ``received`` joins.
TASK_CHARS = 64_000_000


def received(posts: DataFrame, incoming: DataFrame, key: str = "external_id") -> DataFrame:
    """The receiver's table after an upsert: long texts cut, earliest first_seen kept, archived rows active again.

    Texts are cut before they travel. Like ones compress so well that adaptive execution would take
    partitions of gigabytes for small and join them in one task, so their number is set from the texts' length.
    """
    cut = lambda df: df.withColumns({c: F.substring(F.col(c), 1, most) for c, most in (("title", 200), ("content", 5000))})
    posts, incoming = cut(posts), cut(incoming)
    size = lambda df: df.agg(F.sum(100 + sum(F.coalesce(F.length(c), F.lit(0)) for c in ("title", "content")))).first()[0] or 0
    tasks = max(1, -(-(size(posts) + size(incoming)) // TASK_CHARS))
    a = posts.select(F.col(key).alias("_a"), F.struct(*posts.columns).alias("p")).repartition(tasks, "_a")
    b = incoming.select(F.col(key).alias("_b"), F.struct(*incoming.columns).alias("i")).repartition(tasks, "_b")
    j = a.join(b, F.col("_a") == F.col("_b"), "full_outer")
    new, old = (lambda c: F.col("i").getField(c)), (lambda c: F.col("p").getField(c))
    return j.select(
        F.coalesce("_a", "_b").alias(key), F.coalesce(new("title"), old("title")).alias("title"), F.coalesce(new("content"), old("content")).alias("content"),
        F.least(new("first_seen"), old("first_seen")).alias("first_seen"),
        F.when(F.col("_b").isNotNull(), "publish").otherwise(old("status")).alias("status"),
    )


def active_view(jobs: DataFrame, most: int = 500) -> DataFrame:
    """Listing of active rows: defaults in, closed ones last, newest first."""
    return (
        jobs.where("is_active = 1")
        .withColumns({
            "category": F.coalesce(F.nullif("category", F.lit("")), F.lit("General PA")),
            "seniority": F.coalesce(F.nullif("seniority", F.lit("")), F.lit("Unknown")),
            "is_remote": F.coalesce(F.nullif("is_remote", F.lit("")), F.lit("unknown")),
        })
        .orderBy((F.col("lifecycle_status") == "likely_closed").cast("int"), F.desc("first_seen_date"), "external_id").limit(most)
    )


def archived_view(jobs: DataFrame, most: int = 500) -> DataFrame:
    return jobs.where("is_active = 0").orderBy(F.desc("archived_date"), "external_id").limit(most)


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value) of the distinct non-empty values of each column, sorted by both."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null and value <> ''").distinct()


def filtered(df: DataFrame, checked: dict[str, list[str]], query: str = "", text: str = "title") -> DataFrame:
    """Rows in every checked facet that hold the query in any case; with nothing or all of a facet checked it is no filter."""
    for c, values in checked.items():
        if not values:
            continue
        every = df.where(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).agg(F.bool_and(F.col(c).isin(*values)))
        df = df.where(F.col(c).isin(*values) | F.coalesce(every.scalar(), F.lit(True)))
    return df.where(F.lower(F.col(text)).contains(query.lower())) if query else df
