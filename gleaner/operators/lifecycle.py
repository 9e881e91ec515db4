"""Lifecycle: membership verdicts, transitions, archival, budgets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.stats import days_between
from gleaner.functions.urls import host, is_aggregator, verdict
from gleaner.runtime import stored

CLOSE_AFTER, ARCHIVE_AFTER, PICKS, CALLS = 7, 21, 500, 150


def board_key(external_id: Column) -> Column:
    """struct<ats, slug, jid> of a board id; the slug ends at the last underscore."""
    pattern = r"^(gh|lever|ashby)_(.+)_([^_]+)$"
    part = lambda i: F.nullif(F.regexp_extract(external_id, pattern, i), F.lit(""))
    return F.struct(part(1).alias("ats"), part(2).alias("slug"), part(3).alias("jid"))


def board_snapshot(scans: DataFrame) -> DataFrame:
    """Boards that can be trusted: (ats, slug) with a mapped job, or empty without an error."""
    return scans.groupBy("ats", "slug").agg(
        F.count_if("ok").alias("mapped"), F.count_if("error").alias("errors"), F.count(F.when(F.col("raw"), 1)).alias("listed"),
    ).where((F.col("mapped") > 0) | ((F.col("listed") == 0) & (F.col("errors") == 0)))


def board_jobs(scans: DataFrame) -> DataFrame:
    """(ats, slug, jid): the job ids on each board that can be trusted, of ``scans`` with a row a listed job."""
    return scans.where("ok and jid is not null").join(board_snapshot(scans), ["ats", "slug"], "left_semi").select("ats", "slug", F.col("jid").cast("string").alias("jid")).distinct()


def membership(rows: DataFrame, boards: DataFrame, jobs: DataFrame, board: list[str], job: list[str]) -> DataFrame:
    """rows with a verdict: on its board active, off a known board closed, board unknown null."""
    known = boards.select(*board).distinct().withColumn("_board", F.lit(True))
    member = jobs.select(*job).distinct().withColumn("_job", F.lit(True))
    joined = rows.join(known, board, "left").join(member, job, "left")
    return joined.withColumn("verdict", F.when(F.col("_job"), "active").when(F.col("_board"), "likely_closed")).drop("_board", "_job")


def resolved(rows: DataFrame, statuses: DataFrame) -> DataFrame:
    """rows(verdict, apply_url) with the verdict of the direct page where the board had none.

    Aggregator pages say nothing: unknown. ``statuses(apply_url, status)`` are fetched pages.
    """
    joined = rows.join(statuses, "apply_url", "left")
    direct = F.when(is_aggregator(host(F.col("apply_url"))), "unknown").otherwise(verdict(F.col("status")))
    return joined.withColumn("verdict", F.coalesce("verdict", direct)).drop("status")


def picks(jobs: DataFrame, as_of: Column, age: int = 2, most: int = PICKS) -> DataFrame:
    """Active rows due for a check, never-checked first, then the oldest."""
    due = F.col("last_lifecycle_check").isNull() | (F.datediff(as_of, F.col("last_lifecycle_check")) >= age)
    return jobs.where((F.col("is_active") == 1) & due).orderBy(F.col("last_lifecycle_check").asc_nulls_first(), "external_id").limit(most)


def unseen(jobs: DataFrame, as_of: Column, days: int, most: int = 100) -> DataFrame:
    """Active rows unseen for more than ``days``, longest first, at most ``most``."""
    old = F.datediff(as_of, F.col("last_seen_date")) > days
    return jobs.where((F.col("is_active") == 1) & old).orderBy("last_seen_date", "external_id").limit(most)


def with_budget(candidates: DataFrame, order: list[Column | str], most: int = CALLS) -> DataFrame:
    """candidates with ``deferred``: whether they come after the calls a run may make."""
    first = candidates.orderBy(*order).limit(most).select("external_id").withColumn("_in", F.lit(True))
    return candidates.join(F.broadcast(first), "external_id", "left").withColumn("deferred", F.col("_in").isNull()).drop("_in")


def method_after(method: Column, status: Column) -> Column:
    """The method to ask a page with again: GET where HEAD is refused, none else."""
    return F.when((method == "HEAD") & status.isin(403, 405, 501), "GET")


def checked(jobs: DataFrame, boards: DataFrame, listed: DataFrame, as_of: Column, statuses: Callable[[DataFrame], DataFrame], most: int = PICKS, calls: int = CALLS) -> DataFrame:
    """The due rows of a run with their verdicts, by board, by page, or put off: what ``tallies`` counts.

    ``boards(ats, slug)`` can be trusted and ``listed(ats, slug, jid)`` are their jobs. Rows that no
    board decides and whose link isn't an aggregator's are asked for, the first ``calls`` of
    them in the order of the picks; ``statuses`` maps these rows to (external_id, status).
    """
    due_first = [F.col("last_lifecycle_check").asc_nulls_first(), F.col("external_id")]
    parts = picks(jobs, as_of, most=most).withColumn("_b", board_key(F.col("external_id")))
    page = F.coalesce(F.nullif("apply_url", F.lit("")), F.col("source_url"), F.lit("")) if "source_url" in jobs.columns else F.coalesce("apply_url", F.lit(""))
    parts = parts.select("*", "_b.*").drop("_b").withColumn("apply_url", page)
    rows = stored(membership(parts, boards, listed, ["ats", "slug"], ["ats", "slug", "jid"]))
    away = is_aggregator(host(F.col("apply_url"))) | (host(F.col("apply_url")) == "")
    asked = stored(with_budget(rows.where(F.col("verdict").isNull() & ~away), due_first, calls).select("external_id", "apply_url", "deferred"))
    answers = statuses(asked.where("not deferred").select("external_id", "apply_url"))
    joined = rows.withColumnRenamed("verdict", "_board").join(asked.drop("apply_url"), "external_id", "left").join(answers, "external_id", "left")
    put_off = F.coalesce("deferred", F.lit(False))
    by_page = F.when(F.col("deferred").isNotNull(), verdict(F.col("status"))).otherwise("unknown")
    return joined.select(
        "external_id", F.when(~put_off, F.coalesce("_board", by_page)).alias("verdict"), "status", put_off.alias("deferred"), F.col("lifecycle_status").alias("old_status"),
    ).withColumn("new_status", with_verdict(F.col("old_status"), F.col("verdict")))


def rechecked(jobs: DataFrame, done: DataFrame, as_of: Column) -> DataFrame:
    """The stored rows after a check: date and verdict of those that were looked at, status where a verdict says one."""
    seen = done.where("not deferred").select("external_id", F.col("verdict").alias("_v"), F.col("new_status").alias("_s"))
    j = jobs.join(seen, "external_id", "left")
    return j.withColumns({
        "lifecycle_status": F.coalesce("_s", "lifecycle_status"), "last_lifecycle_verdict": F.coalesce("_v", "last_lifecycle_verdict"),
        "last_lifecycle_check": F.when(F.col("_v").isNotNull(), as_of.cast("date")).otherwise(F.col("last_lifecycle_check")),
    }).select(*jobs.columns)


def tallies(checked: DataFrame) -> DataFrame:
    """One row of counts over ``checked(external_id, verdict, status, deferred, old_status, new_status)`` and the ids that changed."""
    changed = F.col("old_status") != F.col("new_status")
    to = lambda s: changed & (F.col("new_status") == s)
    ids = lambda which: F.sort_array(F.collect_list(F.when(which, F.col("external_id"))))
    return checked.agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(~F.col("deferred")).alias("checked"), F.count_if("deferred").alias("deferred"),
        F.count_if(F.col("verdict") == "active").alias("active"), F.count_if(F.col("verdict") == "likely_closed").alias("closed"),
        F.count_if(F.col("verdict") == "unknown").alias("unknown"), F.count_if(F.col("status").isNull() & ~F.col("deferred")).alias("by_board"),
        F.count_if(to("likely_closed")).alias("newly_closed"), F.count_if(to("active")).alias("reopened"),
        ids(to("likely_closed")).alias("closed_ids"), ids(to("active")).alias("reopened_ids"))


def with_verdict(status: Column, verdict_: Column) -> Column:
    """The status after a verdict; unknown never changes it."""
    return F.when(verdict_.isin("active", "likely_closed"), verdict_).otherwise(status)


def archived(jobs: DataFrame, as_of: Column) -> DataFrame:
    """Both archival tracks: verified closures at once; unseen for a week likely closed, for three archived."""
    unseen = F.datediff(as_of, F.col("last_seen_date"))
    active = F.col("is_active") == 1
    closed = active & (F.col("lifecycle_status") == "likely_closed") & (F.col("last_lifecycle_verdict") == "likely_closed")
    gone = active & (F.coalesce(closed, F.lit(False)) | (unseen >= ARCHIVE_AFTER))
    marked = active & ~gone & (unseen >= CLOSE_AFTER) & (F.col("lifecycle_status").isNull() | (F.col("lifecycle_status") == "active"))
    return jobs.withColumns({
        "lifecycle_status": F.when(gone | marked, "likely_closed").otherwise(F.col("lifecycle_status")),
        "is_active": F.when(gone, 0).otherwise(F.col("is_active")),
        "archived_date": F.when(gone, as_of).otherwise(F.col("archived_date")),
        "days_active": F.when(gone, days_between(F.col("first_seen_date"), as_of)).otherwise(F.col("days_active")),
    })


def dedup_pool(jobs: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Active rows and those archived within ``days``."""
    return jobs.where((F.col("is_active") == 1) | ((F.col("is_active") == 0) & (F.col("archived_date") >= F.date_sub(as_of, days))))
