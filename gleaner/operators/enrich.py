"""Enrichment from descriptions and fetched pages, with a confidence for every field."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import config as C
from gleaner.functions.rules import best_confidence
from gleaner.functions.text import extract_location, extract_salary, html_to_text, missing, remote_status
from gleaner.functions.urls import body_redirect, host, is_aggregator
from gleaner.operators.jsonld import extracted
from gleaner.operators.state import assigned
from gleaner.runtime import stored


def lattice(found: Column, present: Column, confidence: Column) -> Column:
    """A field's confidence after a page was read.

    Found fills or confirms; found against a value of other standing leaves it to the
    aggregator, as does a value that the page doesn't show and that was not inferred.
    """
    return (
        F.when(found & ~present, "confirmed").when(found & (confidence == "inferred"), "confirmed").when(found, "aggregator_only")
        .when(present & (F.coalesce(confidence, F.lit("")) != "inferred"), "aggregator_only").otherwise(confidence)
    )


def _filled(df: DataFrame, remote: Column, salary: Column, location: Column | None = None) -> DataFrame:
    """Empty remote, salary and location filled, as inferred; each is looked for only where it is empty, and once."""
    no_remote, no_salary = missing(F.col("is_remote")).isNull(), F.col("salary_min").isNull()
    looked = {"_remote": F.when(no_remote, remote), "_salary": F.when(no_salary, salary)}
    said, paid = F.col("_remote"), F.col("_salary")
    filled = {
        "is_remote": F.coalesce(said, "is_remote"), "remote_confidence": F.when(said.isNotNull(), "inferred").otherwise(F.col("remote_confidence")),
        "salary_min": F.coalesce("salary_min", paid["min"]), "salary_max": F.coalesce("salary_max", paid["max"]),
        "salary_confidence": F.when(paid.isNotNull(), "inferred").otherwise(F.col("salary_confidence")),
    }
    if location is not None:
        looked["_place"] = F.when(missing(F.col("location")).isNull(), location)
        place = F.col("_place")
        filled |= {"location": F.coalesce(place, "location"), "location_confidence": F.when(place.isNotNull(), "inferred").otherwise(F.col("location_confidence"))}
    return df.withColumns(looked).withColumns(filled).drop(*looked)


def from_description(df: DataFrame) -> DataFrame:
    """Empty remote, salary and location filled from the description, as inferred."""
    d = F.coalesce("description", F.lit(""))
    return _filled(df, remote_status(d), extract_salary(d), extract_location(d))


def from_hints(df: DataFrame) -> DataFrame:
    """Empty remote and salary filled from the classifier's hints (llm_remote, llm_salary_hint), as inferred."""
    return _filled(df, F.col("llm_remote"), extract_salary(F.coalesce("llm_salary_hint", F.lit(""))))


def from_pages(df: DataFrame, pages: DataFrame) -> DataFrame:
    """df joined with fetched ``pages(apply_url, final_url, html)``: redirects, values and confidences."""
    p = pages.select("apply_url", F.col("final_url").alias("_final"), F.col("html").alias("_html"))
    landed = F.coalesce("_final", "apply_url")
    j = df.join(p, "apply_url", "left").withColumns({
        "_moved": body_redirect(F.coalesce("_html", F.lit("")), landed), "_text": html_to_text(F.coalesce("_html", F.lit(""))),
        "_read": F.col("_html").isNotNull() & ~is_aggregator(host(landed))})
    read, text = F.col("_read"), F.col("_text")
    said = {"_remote": remote_status(text), "_place": extract_location(text), "_salary": extract_salary(text)}
    j = j.withColumns({name: F.when(read, value) for name, value in said.items()})
    target = F.when(F.col("_moved") != "", F.col("_moved")).otherwise(landed)
    remote, location, salary = map(F.col, said)
    out = {"apply_url": F.when(host(target) != host(F.col("apply_url")), target).otherwise(F.col("apply_url"))}
    for value, found, conf in (("is_remote", remote, "remote_confidence"), ("location", location, "location_confidence")):
        present = missing(F.col(value)).isNotNull()
        out[value] = F.when(read & ~present & found.isNotNull(), found).otherwise(F.col(value))
        out[conf] = F.when(read, lattice(found.isNotNull(), present, F.col(conf))).otherwise(F.col(conf))
    present = F.col("salary_min").isNotNull()
    out["salary_min"] = F.when(read, F.coalesce("salary_min", salary["min"])).otherwise(F.col("salary_min"))
    out["salary_max"] = F.when(read & ~present, F.coalesce("salary_max", salary["max"])).otherwise(F.col("salary_max"))
    out["salary_confidence"] = F.when(read, lattice(salary.isNotNull(), present, F.col("salary_confidence"))).otherwise(F.col("salary_confidence"))
    out["enrichment_source"] = F.when(read, "page").otherwise("aggregator")
    return j.withColumns(out).drop("_final", "_html", "_moved", "_text", "_read", *said)


def assumed(df: DataFrame) -> DataFrame:
    """What nobody says is taken to be on site."""
    empty = missing(F.col("is_remote")).isNull()
    return df.withColumns({
        "is_remote": F.when(empty, "onsite").otherwise(F.col("is_remote")),
        "remote_confidence": F.when(empty, "assumed").otherwise(F.col("remote_confidence")),
    })


def stale(date: Column, as_of: Column, days: int = 7) -> Column:
    """Not enriched within ``days``; an unreadable date counts as never."""
    return ~F.coalesce(F.datediff(as_of, F.try_to_date(F.substring(date, 1, 10))) < days, F.lit(False))


def priority(tier: Column, score: Column, source: Column) -> list[Column]:
    """Fetch order: relevance tier, score bucket, aggregators first."""
    aggregator = source.isin("jooble", "adzuna", "jsearch", "google_alerts").cast("int")
    return [F.desc_nulls_last(tier), F.desc(F.floor(score / 10)), F.desc(aggregator)]


def backfill_candidates(jobs: DataFrame) -> DataFrame:
    """(external_id, apply_url) of active rows whose link is an aggregator's."""
    link = F.coalesce("apply_url", F.lit(""))
    return jobs.where((F.col("is_active") == 1) & (link != "") & is_aggregator(host(link))).select("external_id", "apply_url")


def backfilled(jobs: DataFrame, asking: Callable | None = None, gap: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(the rows with links that left the aggregators, (external_id, url, target) of every link tried).

    Looking at the second alone is the dry run: nothing is written here.
    """
    from gleaner.sources import chain

    links = stored(chain.landed(backfill_candidates(jobs), "external_id", "apply_url", asking or chain.ask, gap))
    moved = links.where("target is not null").select("external_id", F.col("target").alias("apply_url"))
    return assigned(jobs, moved, "external_id", ["apply_url"]), links


def page_observations(df: DataFrame, pages: DataFrame, confidence: float = 0.85) -> DataFrame:
    """(external_id, field, seq, source, value, confidence): what JSON-LD postings on pages that aren't an aggregator's say of the rows of ``df``."""
    own = pages.where(~is_aggregator(host(F.coalesce("final_url", "apply_url", F.lit("")))))
    found = extracted(own.select("apply_url", "html"), "apply_url")
    said = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in found.columns if c != "apply_url"])
    return df.select("external_id", "apply_url").join(found, "apply_url").select("external_id", F.explode(said).alias("o")).select(
        "external_id", F.col("o.field").alias("field"), F.lit(99).alias("seq"), F.lit("schema_org").alias("source"), F.col("o.value").alias("value"),
        F.lit(confidence).alias("confidence")).where("value is not null")


def heard(df: DataFrame) -> DataFrame:
    """The arrangement that each description says, as observations of both fields it speaks of."""
    said = best_confidence(F.coalesce("description", F.lit("")))
    one = df.select("external_id", said["value"].alias("value"), said["confidence"].alias("confidence")).where("value is not null")
    return one.select("external_id", F.explode(F.array(F.lit("is_remote"), F.lit("work_arrangement"))).alias("field"), F.lit(9).alias("seq"),
                      F.lit("text_classifier").alias("source"), "value", "confidence")


def heard_tallies(df: DataFrame, text: str = "description", patterns: Sequence[tuple[str, str, float]] = C.ARRANGEMENT_PATTERNS) -> DataFrame:
    """One row: texts that say an arrangement, each arrangement, and those that say none."""
    said = df.select(best_confidence(F.coalesce(text, F.lit("")), patterns)["value"].alias("v"))
    return said.agg(F.count("v").alias("classified"), *[F.count_if(F.col("v") == x).alias(x) for x in ("remote", "hybrid", "onsite")], F.count_if(F.col("v").isNull()).alias("no_signal"))
