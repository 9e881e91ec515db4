"""Requests that go host by host: status checks, the page a redirect ends at, and fetches within a breaker and a budget.

A host's requests are one group, asked in order and ``gap`` seconds apart, so hosts go in parallel
and none is pressed. How many requests a run makes is bounded by its budget, not by the data.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple
from urllib import error, request

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.urls import body_redirect, host, is_aggregator
from gleaner.operators.aggregates import numbered
from gleaner.runtime import ship, stored

TIMEOUT, AGAIN, GAP = 10.0, 5.0, 1.0
#: Statuses of hosts that refuse HEAD but may answer GET.
REFUSED = (403, 405, 501)


class Answer(NamedTuple):
    """What came back; no status if nothing did, and then whether that took too long."""

    status: int | None
    url: str
    html: str = ""
    late: bool = False


def ask(method: str, url: str, timeout: float) -> Answer:
    """One request, redirects followed; never raises."""
    try:
        with request.urlopen(request.Request(url, method=method, headers={"User-Agent": "Mozilla/5.0"}), timeout=timeout) as r:
            return Answer(r.status, r.geturl(), "" if method == "HEAD" else r.read().decode("utf-8", "replace"))
    except error.HTTPError as e:
        return Answer(e.code, e.geturl() or url)
    except (OSError, ValueError) as e:
        late = isinstance(e, TimeoutError) or isinstance(getattr(e, "reason", None), TimeoutError)
        return Answer(None, url, late=late)


def patient(asking: Callable, method: str, url: str) -> Answer:
    """An answer, or a second try within a shorter time where the first broke off; a late host isn't asked again."""
    got = asking(method, url, TIMEOUT)
    return asking(method, url, AGAIN) if got.status is None and not got.late else got


def status_answer(asking: Callable, url: str) -> Answer:
    """HEAD, then GET where HEAD is refused or brings nothing."""
    got = patient(asking, "HEAD", url)
    return patient(asking, "GET", url) if got.status is None or got.status in REFUSED else got


def page_answer(asking: Callable, url: str) -> Answer:
    return asking("GET", url, TIMEOUT)


def head_answer(asking: Callable, url: str) -> Answer:
    return asking("HEAD", url, TIMEOUT)


_ANSWER = "status int, final_url string, html string"


def visited(rows: DataFrame, key: str, url: str, how: Callable = status_answer, asking: Callable = ask, gap: float = GAP) -> DataFrame:
    """(key, status, final_url, html) of each row's page, asked by ``how``; an empty URL has no answer."""
    ship(rows.sparkSession)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for i, (k, u) in enumerate(zip(frame["_key"], frame["_url"])):
            if i and gap:
                time.sleep(gap)
            got = how(asking, u) if u else Answer(None, "")
            out.append((k, got.status, got.url, got.html))
        return pd.DataFrame(out, columns=["_key", "status", "final_url", "html"])

    asked = rows.select(F.col(key).cast("string").alias("_key"), F.coalesce(url, F.lit("")).alias("_url"))
    return asked.groupBy(host(F.col("_url"))).applyInPandas(run, f"_key string, {_ANSWER}").withColumnRenamed("_key", key)


def landed(rows: DataFrame, key: str, url: str, asking: Callable = ask, gap: float = GAP) -> DataFrame:
    """(key, url, target): where aggregator links of ``rows`` end, null where none of the ways leaves the aggregator.

    GET with its redirects comes first, then what the body of a page that answered 200 redirects
    to, then HEAD, for hosts that redirect nothing else. Links that aren't an aggregator's are left out.
    """
    links = stored(rows.select(F.col(key).cast("string").alias(key), F.col(url).alias("url")).where(is_aggregator(host(F.coalesce("url", F.lit(""))))))
    own = lambda u: F.when((host(u) != "") & ~is_aggregator(host(u)), u)
    got = links.join(visited(links, key, "url", page_answer, asking, gap), key)
    moved = F.when(F.col("status") == 200, own(body_redirect(F.coalesce("html", F.lit("")), F.col("url"))))
    first = stored(got.select(key, "url", F.coalesce(own(F.col("final_url")), moved).alias("target")))
    rest = first.where("target is null")
    headed = visited(rest, key, "url", head_answer, asking, gap).select(key, own(F.col("final_url")).alias("_target"))
    return first.join(stored(headed), key, "left").select(key, "url", F.coalesce("target", "_target").alias("target"))


def fetched(rows: DataFrame, key: str, url: str, order: list[str], budget: int = 300, trip: int = 5, asking: Callable = ask, gap: float = GAP) -> DataFrame:
    """(key, url, outcome, status, final_url, html): pages of ``rows`` in a total ``order`` within a breaker and a budget.

    A host that fails ``trip`` times in a row (anything but 200) isn't asked again in the run and
    spends nothing; ``budget`` requests are made at most. ``outcome`` is fetched, breaker or budget.

    Rounds take as many of the next rows as the budget has left, of hosts that are not refused;
    all of them are asked for unless their host is refused on the way, so the budget can't end
    within a round. The next round begins with what these left over.
    """
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        fails, out = int(frame["fails"].iloc[0]), []
        for place, name, u in zip(frame["place"], frame["host"], frame["_url"]):
            if name and fails >= trip:
                out.append((name, place, "breaker", fails, None, None, None))
                continue
            if out and gap:
                time.sleep(gap)
            got = page_answer(asking, u) if u else Answer(None, "")
            fails = 0 if got.status == 200 else fails + 1
            out.append((name, place, "fetched", fails, got.status, got.url, got.html))
        return pd.DataFrame(out, columns=["host", "place", "outcome", "fails", "status", "final_url", "html"])

    ship(rows.sparkSession)
    placed = stored(numbered(rows.withColumn("_url", F.coalesce(url, F.lit(""))).withColumn("host", host(F.col("_url"))), order, "place"))
    asked, hosts, left, after = None, None, budget, 0
    while left > 0:
        waiting = placed.where(F.col("place") > after).select("host", "place", "_url")
        if hosts is not None:
            waiting = waiting.join(hosts.where((F.col("fails") >= trip) & (F.col("host") != "")), "host", "left_anti")
            waiting = waiting.join(hosts, "host", "left")
        else:
            waiting = waiting.withColumn("fails", F.lit(0))
        turn = stored(waiting.fillna(0, ["fails"]).orderBy("place").limit(left))  # at most the budget
        if turn.isEmpty():
            break
        done = stored(turn.groupBy("host").applyInPandas(run, f"host string, place long, outcome string, fails int, {_ANSWER}"))
        asked = done if asked is None else asked.unionByName(done)
        end = done.agg(F.max("place").alias("last"), F.count_if(F.col("outcome") == "fetched").alias("n")).first()
        left, after = left - end.n, end.last
        hosts = stored(asked.groupBy("host").agg(F.max_by("fails", "place").alias("fails")))
    out = placed.drop("fails", "status", "final_url", "html", "outcome")
    if asked is None:
        empty = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in _ANSWER.split(", ")]
        return out.select(key, F.col("_url").alias("url"), F.lit("budget").alias("outcome"), *empty)
    refused = hosts.where((F.col("fails") >= trip) & (F.col("host") != "")).select("host", F.lit(True).alias("_refused"))
    return out.join(asked.select("place", "outcome", "status", "final_url", "html"), "place", "left").join(refused, "host", "left").select(
        key, F.col("_url").alias("url"), F.coalesce("outcome", F.when(F.col("_refused"), "breaker").otherwise("budget")).alias("outcome"), "status", "final_url", "html")
