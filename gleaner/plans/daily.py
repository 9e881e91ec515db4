"""The daily run as one composition of stages over DataFrames, in the order the stages rely on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.config import Lexicon
from gleaner.functions import rules
from gleaner.functions.text import normalize_company
from gleaner.operators import aggregates, classifier, consensus, enrich, lifecycle, publish, resolve, scoring, state
from gleaner.runtime import stored


#: Fields that sources, descriptions and pages vote on.
VOTED = ("is_remote", "work_arrangement")


@dataclass
class Outcome:
    """What a run leaves: the new state, what to publish, what was rejected, and the day's figures."""

    jobs: DataFrame
    published: DataFrame
    rejected: DataFrame
    duplicates: DataFrame
    stats: DataFrame
    by_source: DataFrame


def run(batch: DataFrame, jobs: DataFrame, lexicon: Lexicon, as_of: date, answers: DataFrame | None = None, pages: DataFrame | None = None, log: str | None = None) -> Outcome:
    """One day: score, route, classify, label, resolve, vote, enrich, merge, archive, aggregate.

    ``batch`` has the record schema, ``jobs`` the stored one (both may be empty). ``answers``
    are classifier responses and ``pages`` fetched pages; without them the keyword fallback
    and the descriptions decide. Decisions are appended under ``log`` if it is given.
    """
    day = F.lit(as_of)
    by_source = batch.groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))
    if "arrival" not in batch.columns:  # the order of the batch itself: sources as united, rows as read
        batch = stored(batch.withColumn("arrival", F.monotonically_increasing_id()))  # written, so that a lost executor can't number anew
    scored = scoring.score_records(batch, lexicon).cache()
    rejects = F.col("decision").isin("auto_reject", "low_score")
    rejected = scored.where(rejects)
    kept = classifier.classified(scored.where(~rejects), answers)
    routed = kept.withColumn("publish", rules.publish_decision(F.col("llm_classification"), F.col("llm_confidence")))
    labelled = routed.where(F.col("publish") != "reject").withColumns({
        "seniority": rules.merged_seniority(rules.seniority(F.col("title")), F.col("llm_seniority"), F.col("salary_min")),
        "category": rules.category(F.col("title"), F.col("company"), F.col("description")),
        "vendors_mentioned": F.array_join(rules.multi_label(F.coalesce("description", F.lit(""))), ","),
        "company_normalized": normalize_company(F.col("company")),
    })
    # Resolution: each record against what is stored and what the batch has kept, the best of both at once.
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("company", "title", "location", "apply_url")]
    pool = lifecycle.dedup_pool(jobs, day).select("external_id", *texts)
    clusters = resolve.cluster(labelled.select("external_id", *texts, "arrival"), pool).cache()
    duplicates = clusters.where("key <> primary or stored")
    primaries = labelled.drop("location").join(clusters.where("key = primary and not stored").select(F.col("key").alias("external_id"), "location"), "external_id")
    known = clusters.where("stored").select(F.col("key").alias("external_id"), F.col("primary").alias("against"))
    jobs = resolve.upgraded(jobs, labelled.join(known, "external_id").select("external_id", "against", "apply_url"))
    # Votes on the arrangement, by source prior and by the descriptions' own words, of all members of a cluster.
    members = labelled.join(clusters.where("not stored").select(F.col("key").alias("external_id"), "primary"), "external_id").withColumn("external_id", F.col("primary"))
    observed = consensus.observations(members, "external_id", VOTED).unionByName(enrich.heard(members))
    if pages is not None:
        observed = observed.unionByName(enrich.page_observations(members, pages))
    votes = consensus.vote(observed.where(F.col("field").isin(*VOTED)), "external_id")
    voted = primaries
    for field in VOTED:
        own = votes.where(F.col("field") == field).select("external_id", F.col("value").alias("_v"), F.col("confidence").alias("_c"))
        voted = voted.join(own, "external_id", "left").withColumn(field, consensus.applied(F.col(field), F.col("_v"), F.col("_c"))["value"]).drop("_v", "_c")
    blank = F.lit("unverified")
    enriched = enrich.from_hints(voted.withColumns({"remote_confidence": blank, "salary_confidence": blank, "location_confidence": blank}))
    enriched = enrich.from_description(enriched)
    if pages is not None:  # rows that were enriched lately keep what they have
        lately = jobs.where(~enrich.stale(F.col("enrichment_date"), day)).select("external_id")
        due = enrich.from_pages(enriched.join(lately, "external_id", "left_anti"), pages).withColumn("enrichment_date", day.cast("string"))
        enriched = due.unionByName(enriched.join(lately, "external_id", "left_semi"), allowMissingColumns=True)
    enriched = enrich.assumed(enriched)
    names = [c for c in jobs.columns if c in enriched.columns]
    merged = state.merge(jobs, enriched.select(*names), "external_id", day)
    archived = lifecycle.archived(merged, day)
    active = archived.where("is_active = 1")
    if log:
        publish.shadowed(rejected.select("external_id", "title", "company", "keyword_score", "decision"), "keyword_filter", log)
        publish.shadowed(routed.select("external_id", "llm_classification", "llm_confidence", "publish"), "classifier", log)
    published = enriched.select("external_id", publish.payload(enriched, [c for c in enriched.columns if c not in ("raw_data", "arrival")]).alias("payload"), "publish")
    return Outcome(archived, published, rejected, duplicates, aggregates.snapshot(active, day), by_source)


def sweep(table: state.VersionedTable, as_of: date) -> DataFrame:
    """The archival of a day without a batch, written as a new version; (external_id, old, new) of the rows whose status changed."""
    before = table.read()
    after = lifecycle.archived(before, F.lit(as_of))
    table.write(after)
    return state.transitions(before, table.read(), "external_id", "lifecycle_status")
