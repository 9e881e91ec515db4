"""Fuzzy entity resolution: blocking, pair scoring, clustering and merging."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.similarity import similar
from gleaner.functions.text import city, normalize_company, normalize_title
from gleaner.functions.urls import apply_score
from gleaner.operators.aggregates import numbered
from gleaner.runtime import ship, stored

DUPLICATE, FLAG, SAME_COMPANY, SAME_COMPANY_SIMILARITY, SHOWN = 85, 70, 75, 95, 3
#: Company and title similarity of less than this in sum can't be flagged in any city, with room for rounding.
LEAST_SUM = (FLAG - 20) / 0.4 - 1e-6
#: Texts that are compared in one round, those they are compared with in one task, and records of a round.
CHUNK, BLOCK, ROWS = 4096, 4096, 500_000


def composite(company: Column, title: Column, city_a: Column, city_b: Column) -> Column:
    """0.4 company, 0.4 title, 0.2 equal city; halves where a city is missing."""
    return F.when((city_a == "") | (city_b == ""), 0.5 * company + 0.5 * title).otherwise(
        0.4 * company + 0.4 * title + F.when(city_a == city_b, 20.0).otherwise(0.0))


def outcome(score: Column, company: Column) -> Column:
    least = F.when(company >= SAME_COMPANY_SIMILARITY, SAME_COMPANY).otherwise(DUPLICATE)
    return F.when(score >= least, "duplicate").when(score >= FLAG, "flagged").otherwise("new")


def prepared(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "_c": normalize_company(F.col("company")), "_n": normalize_title(F.col("title")), "_y": city(F.col("location")),
        "_u": apply_score(F.col("apply_url")),
    })


def _rows(df: DataFrame, side: str, extra: dict[str, Column] | None = None) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return prepared(df).select(
        text("external_id").alias(f"{side}_key"), text("_c").alias(f"{side}_c"), text("_n").alias(f"{side}_n"), text("location").alias(f"{side}_location"),
        F.col("_u").cast("int").alias(f"{side}_u"), *[c.alias(f"{side}_{n}") for n, c in (extra or {}).items()])


def _met(left: DataFrame, right: DataFrame, by: Column, run: Callable, schema: str, left_block: int = CHUNK, right_block: int = BLOCK) -> DataFrame:
    """``run(left frame, right frame)`` of every block of ``left`` with every block of ``right``, whose rows are dealt by ``by``.

    The rule lets pairs match that share next to nothing (LEAST_SUM), so no key that both sides
    must share is selective; what is sent is rows times blocks of the other side, and only pairs
    above the bound come back.
    """
    ship(left.sparkSession)
    n, m = (max(1, -(-df.count() // size)) for df, size in ((left, left_block), (right, right_block)))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    a = left.withColumn("_l", F.pmod(F.xxhash64("l_key"), F.lit(n)).cast("int")).withColumn("_r", every(m))
    b = right.withColumn("_r", F.pmod(F.xxhash64(by), F.lit(m)).cast("int")).withColumn("_l", every(n))
    return a.groupBy("_l", "_r").cogroup(b.groupBy("_l", "_r")).applyInPandas(run, schema)


def scored_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of left and right records of unlike ids that score ``FLAG`` or more, with similarities and outcome.

    Records have external_id, company, title, location and apply_url; nulls read as empty.
    Rows: a_ and b_ external_id, url quality; company_similarity, title_similarity, score, outcome.
    """
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        i, j, c, t = similar(list(zip(a["l_c"], a["l_n"])), list(zip(b["r_c"], b["r_n"])), LEAST_SUM)
        out = pd.DataFrame({
            "a_external_id": a["l_key"].to_numpy()[i], "a__u": a["l_u"].to_numpy()[i], "a_city": a["l_location"].to_numpy()[i],
            "b_external_id": b["r_key"].to_numpy()[j], "b__u": b["r_u"].to_numpy()[j], "b_city": b["r_location"].to_numpy()[j],
            "company_similarity": c, "title_similarity": t})
        return out[out["a_external_id"] != out["b_external_id"]]

    schema = "a_external_id string, a__u int, a_city string, b_external_id string, b__u int, b_city string, company_similarity double, title_similarity double"
    out = _met(_rows(left, "l"), _rows(right, "r"), F.col("r_key"), run, schema)
    score = composite(F.col("company_similarity"), F.col("title_similarity"), city(F.col("a_city")), city(F.col("b_city")))
    scored = out.withColumn("score", score).where(F.col("score") >= FLAG).drop("a_city", "b_city")
    return scored.withColumn("outcome", outcome(F.col("score"), F.col("company_similarity")))


def best_match(pairs: DataFrame, key: str = "external_id") -> DataFrame:
    """The best partner of each left record; ties to the smaller key."""
    order = Window.partitionBy(f"a_{key}").orderBy(F.desc("score"), f"b_{key}")
    return pairs.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


class Places:
    """The locations of a cluster: the distinct ones while they are few enough to be shown, then their number."""

    def __init__(self, stored: str | None):
        stored = (stored or "").strip()
        counted = re.fullmatch(r"Multiple Locations \((\d+)\)", stored)
        self.number = int(counted[1]) if counted else 0
        self.text = stored
        self.names = [] if counted else list(dict.fromkeys(filter(None, map(str.strip, stored.split(";")))))

    def add(self, place: str | None) -> Places:
        place = (place or "").strip()
        if not place:
            return self
        if self.number:
            self.number += 1
        elif not self.text:
            self.__init__(place)
            return self
        elif place not in self.names:
            self.names.append(place)
        if len(self.names) > SHOWN:
            self.number, self.names = len(self.names), []
        self.text = f"Multiple Locations ({self.number})" if self.number else "; ".join(self.names)
        return self


def merge_locations(primary: str, new: str) -> str:
    """The location text of a record that ``new`` is merged into."""
    return Places(primary).add(new).text


def merged_locations(locations: Column) -> Column:
    """All locations of a cluster at once: up to three joined, more counted."""
    distinct = F.array_distinct(F.filter(F.transform(locations, lambda x: F.trim(x)), lambda x: x != ""))
    return F.when(F.size(distinct) > SHOWN, F.format_string("Multiple Locations (%d)", F.size(distinct))).otherwise(F.array_join(distinct, "; "))


@dataclass
class Cluster:
    position: int
    record: int
    key: str
    location: str
    quality: int


def city_of(location: str) -> str:
    return location.partition(",")[0].strip().lower()


def verdict_of(score: float, company: float) -> str:
    """``outcome`` of plain numbers."""
    if score >= (SAME_COMPANY if company >= SAME_COMPANY_SIMILARITY else DUPLICATE):
        return "duplicate"
    return "flagged" if score >= FLAG else "new"


def _alike(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """The pairs of a block of texts with another that may be flagged in some city, with both similarities."""
    i, j, c, t = similar(list(zip(a["l_c"], a["l_n"])), list(zip(b["r_c"], b["r_n"])), LEAST_SUM)
    return pd.DataFrame({"text": a["l_key"].to_numpy()[i], "other": b["r_key"].to_numpy()[j], "c": c, "t": t})


class Fold:
    """Records of a chunk in order of arrival against stored records and clusters near them.

    What a record meets depends on its text, its city and what stands. The answer for a text and city is
    kept until something changes that they could see: a cluster that is new, one of another primary, or one
    that leaves or enters the city. So copies cost next to nothing.
    """

    def __init__(self, near: pd.DataFrame):
        near = near.sort_values("id")
        room = max(1024, 2 * len(near))
        self.n, self.text, self.city, self.order = 0, np.zeros(room, np.int64), np.full(room, "", object), np.zeros(room, np.int64)
        self.clusters: dict[int, Cluster] = {}
        self.slot: dict[int, int] = {}
        self.stored: dict[int, str] = {}
        self.by_key: dict[str, int] = {}
        self.slots_of: dict[str, set[int]] = {}
        self.touched: set[int] = set()
        self.events: list[tuple] = []
        self.lists: dict[int, tuple] = {}
        self.known: dict[tuple[int, str], tuple] = {}
        self.changes, self.city_changes = 0, {}
        for row in near.itertuples(index=False):
            k = self._add(row.key, row.text, city_of(row.location), -row.id - (1 << 40) if row.id < 0 else row.place)  # the pool is in front
            if row.id < 0:
                self.stored[k] = row.key
            else:
                self.clusters[row.place], self.slot[row.place] = Cluster(row.place, row.id, row.key, row.location, row.quality), k
                self.by_key.setdefault(row.key, row.place)

    def _add(self, key: str, text: int, city: str, order: int) -> int:
        if self.n == len(self.text):
            self.text, self.city, self.order = (np.concatenate([x, np.zeros_like(x)]) for x in (self.text, self.city, self.order))
        k = self.n
        self.text[k], self.city[k], self.order[k] = text, city, order
        self.slots_of.setdefault(key, set()).add(k)
        self.n, self.changes = k + 1, self.changes + 1
        return k

    def _moves(self, k: int, city: str) -> None:
        old = self.city[k]
        if city == old:
            return
        self.city[k] = city
        if not city or not old:
            self.changes += 1
        else:
            for x in (old, city):
                self.city_changes[x] = self.city_changes.get(x, 0) + 1

    def _best(self, text: int, here: str, but: set[int] | None = None) -> tuple[int, float, float]:
        """(where, score, company similarity) of the best that stands, the first of equals; -1 without any."""
        ids, c, t = self.lists.get(text, ((), (), ()))
        if not len(ids) or not self.n:
            return -1, 0.0, 0.0
        at = np.searchsorted(ids, self.text[: self.n])
        at[at == len(ids)] = 0
        k = np.flatnonzero(ids[at] == self.text[: self.n])
        if but:
            k = k[~np.isin(k, list(but))]
        if not len(k):
            return -1, 0.0, 0.0
        c, t, there = c[at[k]], t[at[k]], self.city[k]
        scores = np.where((there == "") | (not here), 0.5 * c + 0.5 * t, 0.4 * c + 0.4 * t + np.where(there == here, 20.0, 0.0))
        score = scores.max()
        best = np.flatnonzero(scores == score)
        best = best[np.argmin(self.order[k[best]])]
        return int(k[best]), float(score), float(c[best])

    def met(self, key: str, text: int, here: str) -> tuple[int, float, float]:
        own = self.slots_of.get(key)
        if own:  # equal ids are not compared
            return self._best(text, here, own)
        stamp = self.changes, self.city_changes.get(here, 0)
        seen = self.known.get((text, here))
        if seen is None or seen[0] != stamp:
            seen = self.known[text, here] = stamp, self._best(text, here)
        return seen[1]

    def take(self, nth: int, key: str, location: str, quality: int, text: int) -> None:
        k, score, company = self.met(key, text, city_of(location))
        verdict = verdict_of(score, company) if k >= 0 else "new"
        if verdict != "duplicate":
            self.clusters[nth], self.slot[nth] = Cluster(nth, nth, key, location, quality), self._add(key, text, city_of(location), nth)
            self.by_key.setdefault(key, nth)
            self.touched.add(nth)
            self.events.append((nth, nth, None, "flagged" if verdict == "flagged" else "kept", score if verdict == "flagged" else 0.0))
            return
        # A stored record that the batch has kept as well stands for that cluster.
        position = self.by_key.get(self.stored[k]) if k in self.stored else int(self.order[k])
        if position is None:
            self.events.append((nth, None, self.stored[k], "duplicate", score))
            return
        held, k = self.clusters[position], self.slot[position]
        held.location = merge_locations(held.location, location)
        if quality > held.quality:
            if self.by_key.get(held.key) == position:
                del self.by_key[held.key]
            self.slots_of[held.key].discard(k)
            self.slots_of.setdefault(key, set()).add(k)
            held.record, held.key, held.quality = nth, key, quality
            self.text[k] = text
            self.changes += 1
        self._moves(k, city_of(held.location))
        self.by_key.setdefault(held.key, position)
        self.touched.add(position)
        self.events.append((nth, position, None, "duplicate", score))


def _fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    near, fold = [], None
    for frame in frames:
        near.append(frame[frame["nth"] == 0]) if fold is None else None
        rows = frame[frame["nth"] > 0]
        if not len(rows):
            continue
        fold = fold or Fold(pd.concat(near))
        for r in rows.itertuples(index=False):
            if r.ids is not None:
                order = np.argsort(r.ids)
                fold.lists[r.text] = tuple(np.asarray(x)[order] for x in (r.ids, r.c, r.t))
            fold.take(r.nth, r.key, r.location, r.quality, r.text)
            if r.last:
                fold.lists.pop(r.text, None)
        yield pd.DataFrame(fold.events, columns=["nth", "position", "pool", "outcome", "score"]).assign(record=None, location=None, quality=None)
        fold.events = []
    if fold:
        held = [(c.position, c.record, c.location, c.quality) for c in map(fold.clusters.get, fold.touched)]
        yield pd.DataFrame(held, columns=["position", "record", "location", "quality"]).assign(nth=None, pool=None, outcome=None, score=None)


_FOLDED = "nth long, position long, pool string, outcome string, score double, record long, location string, quality int"


def cluster(df: DataFrame, pool: DataFrame | None = None, arrival: str = "arrival", chunk: int = CHUNK) -> DataFrame:
    """Greedy clustering in order of arrival: each record against all that are stored or kept so far.

    ``df`` and ``pool`` have external_id, company, title, location and apply_url. A record joins
    the best of ``pool`` and of the clusters' primaries at once, the first of equals with the pool in
    front, if that scores as a duplicate; a better apply URL makes it the primary of its cluster,
    and later records are compared with it. A stored record is never changed; one that the
    batch has kept under the same id stands for that cluster. Ids that are equal are not compared.

    Rows: key, primary in the end, outcome on arrival (kept, flagged, duplicate), score, location,
    stored (whether the primary is of the pool); one for each row of ``df``. Ties of ``arrival`` go by external_id, and
    those of the pool by its arrival if it has one. Nulls read as empty; empty tables give empty results.

    What a record does depends on all before it, so records go in chunks by arrival, each of at most
    ``chunk`` texts (company and title) and ``ROWS`` rows. All similarities of a chunk's texts to those of
    the pool, of the clusters and to each other are taken by all tasks, in blocks; one task then folds the
    chunk's rows, a batch at a time. It holds the records near the chunk, and a text's candidates from
    its first row to its last.
    """
    total_order = ["l_arrival", "l_key", "l_n", "l_c", "l_location", "l_u"]
    ready = stored(numbered(_rows(df, "l", {"arrival": F.col(arrival).cast("long")}), total_order, "l_nth").drop("l_arrival"))
    total = ready.count()
    known = None
    if pool is not None:
        stored_order = F.col("arrival").cast("long") if "arrival" in pool.columns else F.lit(0).cast("long")
        known = stored(numbered(_rows(pool, "l", {"arrival": stored_order}), total_order, "l_nth").drop("l_arrival").withColumn("l_nth", -F.col("l_nth")))
    every = ready if known is None else ready.unionByName(known)
    texts = stored(every.groupBy("l_c", "l_n").agg(F.min("l_nth").alias("text")))
    ready = stored(ready.join(texts, ["l_c", "l_n"]))
    if known is not None:
        known = stored(known.join(texts, ["l_c", "l_n"]).withColumn("position", F.col("l_nth")))
    state = ready.limit(0).withColumn("position", F.col("l_nth"))
    side = lambda of, name: of.select("text").distinct().join(texts, "text").select(F.col("text").alias(f"{name}_key"), *[F.col(f"l_{c}").alias(f"{name}_{c}") for c in ("c", "n")])
    events, last = None, 0
    while last < total:
        first, last = last, min(total, last + ROWS)
        rows = ready.where((F.col("l_nth") > first) & (F.col("l_nth") <= last))
        beyond = rows.groupBy("text").agg(F.min("l_nth").alias("nth")).orderBy("nth").offset(chunk).first()
        if beyond is not None:
            last = beyond.nth - 1
            rows = rows.where(F.col("l_nth") <= last)
        standing = state if known is None else state.unionByName(known)
        pairs = stored(_met(side(rows, "l"), side(standing.select("text").unionByName(rows.select("text")), "r"), F.col("r_key"), _alike, "text long, other long, c double, t double", BLOCK, BLOCK))
        lists = pairs.groupBy("text").agg(F.collect_list(F.struct("other", "c", "t")).alias("x"))
        ends = rows.groupBy("text").agg(F.min("l_nth").alias("_from"), F.max("l_nth").alias("_to"))
        begins = ends.join(lists, "text").select(F.col("_from").alias("l_nth"), "x")
        chunk_rows = rows.join(ends.select("text", "_to"), "text").join(begins, "l_nth", "left").select(
            F.lit(0).cast("long").alias("id"), F.col("l_nth").alias("nth"), F.col("l_nth").alias("place"), F.col("l_key").alias("key"), F.col("l_location").alias("location"),
            F.col("l_u").alias("quality"), "text", (F.col("l_nth") == F.col("_to")).alias("last"), F.col("x.other").alias("ids"), F.col("x.c").alias("c"), F.col("x.t").alias("t"))
        near = standing.join(pairs.select(F.col("other").alias("text")).distinct(), "text", "left_semi")
        if known is not None:  # and clusters under the ids of stored records among them
            near = near.unionByName(state.join(near.where("l_nth < 0").select("l_key").distinct(), "l_key", "left_semi").select(*near.columns)).distinct()
        near = near.select(
            F.col("l_nth").alias("id"), F.lit(0).cast("long").alias("nth"), F.col("position").alias("place"), F.col("l_key").alias("key"), F.col("l_location").alias("location"),
            F.col("l_u").alias("quality"), "text", F.lit(False).alias("last"), *[F.lit(None).cast(f"array<{kind}>").alias(c) for c, kind in (("ids", "long"), ("c", "double"), ("t", "double"))])
        folded = stored(near.unionByName(chunk_rows).repartition(1).sortWithinPartitions("nth").mapInPandas(_fold, _FOLDED))
        events = folded if events is None else events.unionByName(folded)
        touched = folded.where("record is not null").select("position", F.col("record").alias("l_nth"), F.col("location").alias("l_location"), F.col("quality").alias("l_u"))
        names = ready.select("l_nth", "l_key", "l_c", "l_n", "text")
        state = stored(state.join(touched.select("position"), "position", "left_anti").unionByName(touched.join(names, "l_nth")))
    if events is None:
        return ready.select(F.col("l_key").alias("key"), F.col("l_key").alias("primary"), F.lit("kept").alias("outcome"), F.lit(0.0).alias("score"),
                            F.col("l_location").alias("location"), F.lit(False).alias("stored"))
    primaries = state.select("position", F.col("l_key").alias("_primary"), F.col("l_location").alias("_location"))
    done = ready.select("l_nth", "l_key", "l_location").join(events.where("nth is not null").withColumnRenamed("nth", "l_nth").drop("record", "location", "quality"), "l_nth")
    return done.join(primaries, "position", "left").select(
        F.col("l_key").alias("key"), F.coalesce("_primary", "pool").alias("primary"), "outcome", "score",
        F.coalesce("_location", "l_location").alias("location"), F.col("position").isNull().alias("stored"))


def url_upgrades(matches: DataFrame, key: str = "external_id") -> DataFrame:
    """Duplicates whose apply URL is better than that of the stored record they match."""
    return matches.where((F.col("outcome") == "duplicate") & (F.col("a__u") > F.col("b__u"))).select(
        F.col(f"a_{key}").alias(key), F.col(f"b_{key}").alias("against"), F.col("a__u").alias("new_score"), F.col("b__u").alias("old_score"))


def upgraded(jobs: DataFrame, known: DataFrame) -> DataFrame:
    """The stored ``jobs`` with the best apply URL of the duplicates ``known(external_id, against, apply_url)`` where it is better than their own."""
    best = known.groupBy(F.col("against").alias("external_id")).agg(
        F.min(F.struct((-apply_score(F.col("apply_url"))).alias("u"), "external_id", F.col("apply_url").alias("url"))).alias("_best"))
    better = -F.col("_best.u") > apply_score(F.coalesce("apply_url", F.lit("")))
    return jobs.join(best, "external_id", "left").withColumn("apply_url", F.when(better, F.col("_best.url")).otherwise(F.col("apply_url"))).select(*jobs.columns)
