"""Feed payloads to the one record schema, as projections over read JSON, XML and HTML."""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable
from datetime import date
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.runtime import stored
from gleaner.functions.stats import from_millis
from gleaner.functions.text import blank_to_null, capped_json, hash_id, last_segment, salary_range, split_title, strip_tags, sweep_amounts
from gleaner.functions.urls import with_scheme

RECORD = (
    "external_id string, title string, company string, location string, location_country string, description string, "
    "description_is_snippet boolean, salary_min double, salary_max double, salary_range string, source_url string, apply_url string, "
    "source_name string, is_remote string, work_arrangement string, date_posted string, raw_data string"
)
# Payload schemas.
JSEARCH = (
    "job_id string, job_title string, employer_name string, job_city string, job_state string, job_country string, job_location string, "
    "job_description string, job_min_salary double, job_max_salary double, job_apply_link string, job_google_link string, "
    "job_is_remote boolean, job_employment_type string, job_posted_at_datetime_utc string"
)
JOOBLE = "id bigint, title string, company string, location string, snippet string, salary string, link string, updated string"
ADZUNA = (
    "id string, title string, company struct<display_name:string>, location struct<display_name:string>, description string, "
    "salary_min double, salary_max double, redirect_url string, created string"
)
USAJOBS = (
    "MatchedObjectId string, MatchedObjectDescriptor struct<PositionTitle:string,OrganizationName:string,DepartmentName:string,"
    "PositionLocation:array<struct<LocationName:string>>,QualificationSummary:string,"
    "PositionRemuneration:array<struct<MinimumRange:string,MaximumRange:string>>,PositionURI:string,PublicationStartDate:string,"
    "TeleworkEligible:boolean,RemoteIndicator:boolean>"
)
GREENHOUSE = "id bigint, title string, location struct<name:string>, content string, updated_at string, absolute_url string"
LEVER = (
    "id string, text string, categories struct<location:string,team:string>, descriptionPlain string, hostedUrl string, createdAt bigint, "
    "salaryRange struct<min:double,max:double,currency:string,text:string>, salaryDescription string"
)
ASHBY = (
    "id string, title string, location variant, workplaceType string, "
    "compensation struct<compensationTierSummary:struct<minValue:double,maxValue:double,min:double,max:double>>, "
    "descriptionHtml string, descriptionPlain string, jobUrl string, applyUrl string, publishedAt string"
)
SCRAPED = (
    "title string, company string, job_url string, job_url_direct string, site string, location string, description string, "
    "min_amount double, max_amount double, is_remote boolean, date_posted string"
)
RSS = "title string, link string, summary string, published string, source struct<title:string>, feed string, pos int"
NOT_JOBS = r"(?i)how to|guide|tips|best practices|webinar|podcast|report:|trends"
COUNTRY_LABELS = {"us": "US", "usa": "US", "united states": "US", "uk": "GB", "united kingdom": "GB", "ca": "CA", "canada": "CA"}


def items(spark: SparkSession, path: str, schema: str, key: str | None) -> DataFrame:
    """The items of JSON responses: the array under ``key``, or the top-level array."""
    wrapped = spark.read.option("multiLine", True).schema(f"{key} array<struct<{_nested(schema)}>>" if key else schema).json(path)
    return wrapped.select(F.inline(key)) if key else wrapped


def _nested(schema: str) -> str:
    depth, out = 0, []
    for part in schema.replace(", ", ",").split(","):
        out.append(part if depth else part.replace(" ", ":", 1))
        depth += part.count("<") - part.count(">")
    return ",".join(out)


def record(df: DataFrame, source: Column | str, **c: Column) -> DataFrame:
    """One row of ``RECORD`` per row that has an id, a title and a company."""
    text = lambda k: F.coalesce(c[k], F.lit("")) if k in c else F.lit("")
    low = c.get("salary_min", F.lit(None)).cast("double")
    high = c.get("salary_max", F.lit(None)).cast("double")
    raw = capped_json(F.to_json(F.struct("*")))
    out = df.select(
        c["external_id"].alias("external_id"), F.trim(text("title")).alias("title"), F.trim(text("company")).alias("company"),
        text("location").alias("location"), text("location_country").alias("location_country"), text("description").alias("description"),
        c.get("snippet", F.lit(False)).alias("description_is_snippet"), low.alias("salary_min"), high.alias("salary_max"),
        salary_range(low, high).alias("salary_range"), text("source_url").alias("source_url"),
        F.coalesce(blank_to_null(text("apply_url")), text("source_url")).alias("apply_url"),
        (F.lit(source) if isinstance(source, str) else source).alias("source_name"),
        F.coalesce(c.get("is_remote", F.lit(None).cast("string")), F.lit("unknown")).alias("is_remote"),
        text("work_arrangement").alias("work_arrangement"), c.get("date_posted", F.lit(None)).cast("string").alias("date_posted"), raw.alias("raw_data"),
    )
    return out.where(F.col("external_id").isNotNull() & (F.col("title") != "") & (F.col("company") != ""))


def jsearch(d: DataFrame) -> DataFrame:
    place = F.coalesce(blank_to_null(F.concat_ws(", ", blank_to_null(F.col("job_city")), blank_to_null(F.col("job_state")))), F.col("job_location"))
    return record(
        d, "jsearch", external_id=F.concat(F.lit("jsearch_"), F.col("job_id")), title=F.col("job_title"), company=F.col("employer_name"), location=place,
        location_country=F.upper(F.coalesce("job_country", F.lit("US"))), description=F.col("job_description"), salary_min=F.col("job_min_salary"),
        salary_max=F.col("job_max_salary"), source_url=F.coalesce("job_google_link", "job_apply_link"), apply_url=F.col("job_apply_link"),
        is_remote=F.when(F.col("job_is_remote"), "remote"), work_arrangement=F.col("job_employment_type"), date_posted=F.col("job_posted_at_datetime_utc"),
    )


def jooble(d: DataFrame, country: str = "us") -> DataFrame:
    pay = sweep_amounts(F.regexp_replace(F.coalesce("salary", F.lit("")), r"(?<=\d)\.(?=\d{3})", ""))
    return record(
        d, "jooble", external_id=F.concat(F.lit("jooble_"), F.col("id").cast("string")), title=F.col("title"), company=F.col("company"),
        location=F.col("location"), location_country=F.lit(COUNTRY_LABELS.get(country.lower(), country.upper())), description=strip_tags(F.col("snippet")),
        snippet=F.lit(True), salary_min=pay["min"], salary_max=pay["max"], source_url=F.col("link"), date_posted=F.col("updated"),
    )


def adzuna(d: DataFrame, country: str = "us") -> DataFrame:
    return record(
        d, "adzuna", external_id=F.concat(F.lit("adzuna_"), F.col("id")), title=strip_tags(F.col("title")), company=F.col("company.display_name"),
        location=F.col("location.display_name"), location_country=F.lit(COUNTRY_LABELS.get(country.lower(), country.upper())), description=strip_tags(F.col("description")),
        snippet=F.lit(True), salary_min=F.col("salary_min"), salary_max=F.col("salary_max"), source_url=F.col("redirect_url"), date_posted=F.col("created"),
    )


def usajobs(d: DataFrame) -> DataFrame:
    m = F.col("MatchedObjectDescriptor")
    amounts = lambda f: F.transform(m["PositionRemuneration"], lambda r: r[f].try_cast("double"))
    return record(
        d, "usajobs", external_id=F.concat(F.lit("usajobs_"), F.col("MatchedObjectId")), title=m["PositionTitle"],
        company=F.coalesce(m["OrganizationName"], m["DepartmentName"]), location=F.try_element_at(m["PositionLocation"], F.lit(1))["LocationName"],
        location_country=F.lit("US"), description=m["QualificationSummary"], salary_min=F.array_min(amounts("MinimumRange")),
        salary_max=F.array_max(amounts("MaximumRange")), source_url=m["PositionURI"],
        is_remote=F.when(m["RemoteIndicator"], "remote").when(m["TeleworkEligible"], "hybrid").otherwise("onsite"), date_posted=m["PublicationStartDate"],
    )


def greenhouse(d: DataFrame, slug: Column) -> DataFrame:
    return record(
        d, "greenhouse", external_id=F.concat(F.lit("gh_"), slug, F.lit("_"), F.col("id").cast("string")), title=F.col("title"), company=F.initcap(F.replace(slug, F.lit("-"), F.lit(" "))),
        location=F.col("location.name"), description=strip_tags(F.col("content")), source_url=F.col("absolute_url"), date_posted=F.col("updated_at"),
    )


def lever(d: DataFrame, slug: Column) -> DataFrame:
    pay = sweep_amounts(F.coalesce("salaryRange.text", "salaryDescription", F.lit("")), r"\d[\d,]*")
    return record(
        d, "lever", external_id=F.concat(F.lit("lever_"), slug, F.lit("_"), F.col("id")), title=F.col("text"), company=F.initcap(F.replace(slug, F.lit("-"), F.lit(" "))),
        location=F.col("categories.location"), description=F.col("descriptionPlain"), salary_min=F.coalesce("salaryRange.min", pay["min"]),
        salary_max=F.coalesce("salaryRange.max", pay["max"]), source_url=F.col("hostedUrl"), date_posted=from_millis(F.col("createdAt")).cast("string"),
    )


def ashby(d: DataFrame, slug: Column) -> DataFrame:
    pay = F.col("compensation.compensationTierSummary")
    kind = F.lower(F.trim(F.coalesce("workplaceType", F.lit(""))))
    return record(
        d, "ashby", external_id=F.concat(F.lit("ashby_"), slug, F.lit("_"), F.col("id")), title=F.col("title"), company=F.initcap(F.replace(slug, F.lit("-"), F.lit(" "))),
        location=F.coalesce(F.try_variant_get("location", "$.name", "string"), F.when(F.schema_of_variant("location") == "STRING", F.try_variant_get("location", "$", "string"))),
        description=F.coalesce("descriptionPlain", strip_tags(F.col("descriptionHtml"))), salary_min=F.coalesce(pay["minValue"], pay["min"]),
        salary_max=F.coalesce(pay["maxValue"], pay["max"]), source_url=F.col("jobUrl"), apply_url=F.col("applyUrl"),
        is_remote=F.when(kind == "remote", "remote").when(kind == "hybrid", "hybrid").when(kind.isin("onsite", "on-site"), "onsite"), date_posted=F.col("publishedAt"),
    )


def scraped(d: DataFrame) -> DataFrame:
    d = d.where(F.coalesce("job_url", F.lit("")) != "")
    return record(
        d, F.concat(F.lit("jobspy_"), F.col("site")),
        external_id=F.concat(F.lit("jobspy_"), F.col("site"), F.lit("_"), hash_id(F.concat_ws("|", "site", "job_url"))), title=F.col("title"), company=F.col("company"),
        location=F.col("location"), description=F.col("description"), salary_min=F.col("min_amount"), salary_max=F.col("max_amount"), source_url=F.col("job_url"),
        apply_url=F.col("job_url_direct"), is_remote=F.when(F.col("is_remote"), "remote"), date_posted=F.col("date_posted"),
    )


def rss_items(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """The items of an RSS document by the built-in XML reader, numbered in order."""
    read = spark.read.format("xml").option("rowTag", "item").schema("title string, link string, description string, pubDate string").load(path)
    return read.select("title", "link", F.col("description").alias("summary"), F.col("pubDate").alias("published"),
                       F.lit(None).cast("struct<title:string>").alias("source"), F.lit(feed).alias("feed"), F.monotonically_increasing_id().cast("int").alias("pos"))


def rss(d: DataFrame, most: int = 20) -> DataFrame:
    """The first entries of each feed that look like postings, one per id."""
    from gleaner.operators.aggregates import first_n
    from gleaner.operators.state import keep_first

    d = first_n(d, "feed", ["pos"], most).where(~F.col("title").rlike(NOT_JOBS))
    d = d.withColumn("_id", F.concat(F.lit("galert_"), hash_id(F.col("link"), 12)))
    d = keep_first(d, "_id", ["feed", "pos"])
    return record(
        d, "google_alerts", external_id=F.col("_id"), title=F.col("title"), company=F.coalesce(F.col("source.title"), last_segment(F.col("title")), F.lit("Unknown")),
        description=strip_tags(F.col("summary")), snippet=F.lit(True), source_url=F.col("link"), date_posted=F.col("published"),
    )


def anchors(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., pos, href, text) of every link with text, in order of place."""
    pattern = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
    pair = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("text"))
    return (
        pages.select(*keep, F.posexplode(pair).alias("pos", "a"))
        .select(*keep, "pos", F.col("a.href").alias("href"), strip_tags(F.col("a.text")).alias("text")).where("text <> ''")
    )


def board(pages: DataFrame, source: str, html: str = "html") -> DataFrame:
    """Records of a community board: absolute links whose text splits into title and company."""
    links = anchors(pages, html).where(F.col("href").rlike("(?i)^https?://")).withColumn("_s", split_title(F.col("text"))).where("_s is not null")
    return record(
        links, source, external_id=F.concat(F.lit(f"{source}_"), hash_id(F.col("href"))), title=F.col("_s.title"), company=F.col("_s.company"), source_url=F.col("href"),
    )


def changed_pages(pages: DataFrame, seen: DataFrame) -> DataFrame:
    """Pages whose content hash is not the stored one: ``seen(ats, slug, status)`` holds hashes."""
    hashed = pages.withColumn("hash", hash_id(F.col("html")))
    return hashed.join(seen.select(F.col("slug").alias("board"), F.col("status").alias("hash")), ["board", "hash"], "left_anti")


def gathered(spark: SparkSession, reads: dict[str, Callable[[], DataFrame]], monday_only: tuple[str, ...] = ("usajobs",), day: date | None = None) -> tuple[DataFrame, dict[str, str]]:
    """(all records in the order of ``reads`` with ``arrival``, error by source).

    Each source is read once, as a whole and in a job of its own, into the shared folder: one that
    fails, in whichever partition, is left out and named, and a lost executor numbers nothing
    anew. One that runs weekly is read on Mondays.
    """
    parts, errors = [], {}
    for place, (name, read) in enumerate(reads.items()):
        if name in monday_only and day is not None and day.weekday() != 0:
            continue
        try:
            part = stored(read().withColumn("arrival", F.lit(place << 48) + F.monotonically_increasing_id()))
        except Exception as error:  # whatever a source does, the others go on
            errors[name] = f"{type(error).__name__}: {error}"[:500]
            continue
        parts.append(part)
    empty = spark.createDataFrame([], RECORD).withColumn("arrival", F.lit(0).cast("long"))
    return union(parts or [empty]), errors


def failed_requests(pages: DataFrame) -> DataFrame:
    """(url, status, error) of requests that brought nothing usable; the pages of all others go on."""
    return pages.where(~F.col("status").between(200, 299)).select("url", "status", F.when(F.col("status") == 0, F.col("html")).alias("error"))


def first_filled(*reads: Callable[[], DataFrame]) -> DataFrame:
    """The first of several ways to read a source that gives a record; the last one if none does."""
    for read in reads[:-1]:
        part = read()
        if not part.isEmpty():
            return part
    return reads[-1]()


def requests_of(queries: list[str], **dims: list[str]) -> list[dict[str, str]]:
    """Every combination of queries with the other dimensions of a feed, queries innermost."""
    names = [*dims, "query"]
    return [dict(zip(names, values)) for values in itertools.product(*dims.values(), queries)]


def discovered(candidates: DataFrame, asking: Callable | None = None, gap: float = 1.0) -> dict[str, list[str]]:
    """The slugs by system of ``candidates(ats, slug, url)`` whose board answers 200, ready to be merged into the known ones."""
    from gleaner.sources import chain

    rows = candidates.withColumn("_id", F.concat_ws("/", "ats", "slug"))
    got = rows.join(chain.visited(rows, "_id", "url", chain.page_answer, asking or chain.ask, gap), "_id").where("status = 200")
    return {r.ats: sorted(r.slugs) for r in got.groupBy("ats").agg(F.collect_set("slug").alias("slugs")).collect()}


def known_slugs(path: str, found: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """The slug lists by system in a JSON file, with newly ``found`` ones merged in and written back."""
    file = Path(path)
    known = json.loads(file.read_text()) if file.exists() else {}
    if found:
        known |= {ats: sorted({*known.get(ats, ()), *slugs}) for ats, slugs in found.items()}
        file.write_text(json.dumps(known, indent=1, sort_keys=True))
    return known


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stale_feeds(d: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """(feed, latest, stale): feeds with no entry newer than ``days``."""
    # Spark reads no weekday names.
    bare = F.regexp_replace("published", r"^[A-Za-z]{3},\s*", "")
    at = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f"d MMM yyyy HH:mm:ss {zone}")) for zone in ("Z", "z")], F.try_to_timestamp("published"))
    return d.groupBy("feed").agg(F.max(at).alias("latest")).withColumn("stale", F.coalesce(F.col("latest") < now - F.expr(f"INTERVAL {days} DAYS"), F.lit(True)))


def feed_url(url: Column) -> Column:
    return with_scheme(url)
