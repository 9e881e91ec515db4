"""Exact top-k inner products over an impact-ordered, score-at-a-time index.

The postings of a component, the rows in which it isn't zero, are cut into segments by
quantised impact, the size of the component; rows of no impact have no posting. A query takes
the segments of all components by falling bound on what they can add to a score, its weight
in the component times the segment's highest impact, and adds to accumulators. What the
segments not yet taken can still change is bounded by the highest impact left in each
component. A query stops only when this bound proves that few rows can be members; those are
rescored exactly, and later segments are not touched.

Queries are a stated set and meet all candidates block by block. Candidates stay where their block
is indexed; queries come to them by broadcast, a bounded number of bytes at a time, so candidates
are shuffled once for each of these portions. A block returns at most k rows a query. Queries
that go together are those of like heaviest components, for which one order of segments suits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import table
from gleaner.runtime import ship

K, EVERY, SCALE = 20, 20, 64
#: Rows of a candidate block; bytes of the queries that are broadcast at once.
BLOCK, PORTION = 8192, 32 << 20
#: Impacts a component is quantised to, shares of the segments after which a query looks for proof, and
#: queries that take the segments together.
LEVELS, LOOKS, AT_ONCE = 8, (0.5, 0.7, 0.85, 1.0), 32
#: Sums of integers below this are exact in single precision.
SINGLE = 1 << 24


class ImpactIndex:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order].astype(np.int64)
        impact = np.abs(self.vectors)
        top = impact.max(axis=0) if impact.size else np.zeros(self.vectors.shape[1], np.int64)
        self.top, kind = top, np.float32 if top.max(initial=0) < SINGLE else np.float64
        #: Segments (component, rows, their values, highest impact, highest impact of the component's next).
        self.segments: list[tuple] = []
        for d in np.flatnonzero(top):
            level = -(-impact[:, d] * LEVELS // top[d])
            own = []
            for step in range(LEVELS, 0, -1):
                rows = np.flatnonzero(level == step)
                if len(rows):
                    own.append((d, rows, self.vectors[rows, d].astype(kind), int(impact[rows, d].max())))
            after = [s[3] for s in own[1:]] + [0]
            self.segments += [(*s, left) for s, left in zip(own, after)]
        self.component = np.array([s[0] for s in self.segments], np.int64)
        self.highest = np.array([s[3] for s in self.segments], np.float64)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (ids, scores) of its k best, ties to smaller ids, without rows of its own id."""
        out: list = [None] * len(queries)
        if not len(queries):
            return out
        heaviest = np.abs(queries).argmax(axis=1) if queries.shape[1] else np.zeros(len(queries), np.int64)
        order = np.argsort(heaviest, kind="stable")
        for i in range(0, len(order), AT_ONCE):
            rows = order[i : i + AT_ONCE]
            for at, found in zip(rows.tolist(), self._search(queries[rows].astype(np.int64), own[rows], k)):
                out[at] = found
        return out

    def _search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        n = len(self.ids)
        result: list = [(self.ids[:0], np.zeros(0, np.int64))] * len(queries)
        live = np.arange(len(queries))
        q = queries.astype(np.float64)
        weight = np.abs(q)
        # No partial sum is above the sum of all bounds; half the bytes take half the time.
        kind = np.float32 if (weight @ self.top).max(initial=0) < SINGLE else np.float64
        score = np.zeros((n, len(queries)), kind)
        # One order for queries that go together: by what a segment can add to any of them.
        bound = weight.max(axis=0)[self.component] * self.highest
        order = np.argsort(-bound, kind="stable")
        left = np.zeros(q.shape[1])
        np.maximum.at(left, self.component, self.highest)
        taken = 0
        for look in LOOKS:
            until = int(len(order) * look)
            for i in order[taken:until].tolist():
                d, rows, values, _, after = self.segments[i]
                score[rows] += np.multiply.outer(values, q[live, d].astype(kind))
                left[d] = after
            taken = until
            rest = weight[live] @ left  # what the highest impacts not yet taken can add or take away
            stay = np.zeros(len(live), bool)
            for at, i in enumerate(live.tolist()):
                column = score[:, at]
                possible = np.ones(n, bool)
                if n > k:
                    low = column.copy()
                    low[slice(*np.searchsorted(self.ids, [own[i], own[i] + 1]))] = -np.inf
                    possible = column >= np.partition(low, n - k)[n - k] - 2 * rest[at] - 0.5
                if look < 1 and possible.sum() > max(8 * k, n // 50):
                    stay[at] = True
                    continue
                members = np.flatnonzero(possible)
                members = members[self.ids[members] != own[i]]
                exact = self.vectors[members] @ queries[i]
                best = np.lexsort((self.ids[members], -exact))[:k]
                result[i] = self.ids[members][best], exact[best]
            if not stay.any():
                break
            if not stay.all():
                live, score = live[stay], np.ascontiguousarray(score[:, stay])
        return result


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows; those that are shorter than ``width`` are filled with 0, longer ones cut."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(sizes), width), np.int64)
    fits = place < width
    out[row[fits], place[fits]] = column.flatten().to_numpy(zero_copy_only=False)[fits]
    return out


def _search_block(asked, k: int):
    def run(rows: pa.Table) -> pa.Table:
        ids, queries = asked.value
        # A component that one side lacks adds nothing to a score.
        index = ImpactIndex(rows.column("vec_id").to_numpy(), _matrix(rows.column("v").combine_chunks(), queries.shape[1]))
        q, d, s = [], [], []
        for own, (found, score) in zip(ids.tolist(), index.search(queries, ids, k)):
            q.append(np.full(len(found), own))
            d.append(found)
            s.append(score)
        whole = lambda parts: pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64))
        return pa.table({"query_id": whole(q), "vec_id": whole(d), "score": whole(s)})
    return run


def top_k(rows: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, block: int = BLOCK, portion: int = PORTION) -> DataFrame:
    """For each row of ``rows(vec_id, embedding)`` whose vec_id ``every`` divides, its k best others.

    Components are floor(scale * x); the score is their integer inner product, missing
    components of a shorter vector counting 0. Rows: query_id, rank from 1, vec_id, score;
    ties go to the smaller vec_id. Null vectors, those with null or non-finite components and
    rows without a vec_id take no part; an empty vector scores 0 with all. Rows that repeat a
    vec_id are all candidates of other queries; a query leaves out the rows of its own id, and
    repeated query rows answer once. An empty table gives an empty result; other columns are
    ignored. The work is the number of queries times the number of rows, by contract; rows are
    shuffled once for every ``portion`` bytes of queries.
    """
    spark = rows.sparkSession
    ship(spark)
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = table(
        rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"),
                F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    )
    blocks = max(1, -(-scaled.count() // block))
    candidates = scaled.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
    queries = table(scaled.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"]))
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    portions = max(1, -(-size.n * max(1, size.width or 0) * 8 // portion))
    found = None
    for i in range(portions if size.n else 0):
        part = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(portions)) == i).toArrow()  # about ``portion`` bytes
        asked = spark.sparkContext.broadcast((part.column("vec_id").to_numpy(), _matrix(part.column("v").combine_chunks(), size.width)))
        one = candidates.groupBy("block").applyInArrow(_search_block(asked, k), "query_id long, vec_id long, score long")
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all ``embeddings`` for every 20th of them."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
