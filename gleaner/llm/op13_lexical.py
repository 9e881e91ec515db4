"""Exact ranked lexical search over a two-level quantised index.

Postings of a shard of documents lie by term. At the first level a posting is one byte, its
saturated frequency rounded up, so that a weighted sum of bytes bounds a score from above
and, taken one lower, from below. The k-th highest lower bound, or the k-th best score
so far if that is more, rules documents out; every document whose upper bound reaches it is
rescored at the second level in whole integers.

Frequencies of the terms that are asked for are counted where the texts are read and written
once; statistics of the collection come from that table, and shards are searched where it is read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import batches, table
from gleaner.llm.terms import Words

K = 10
#: Documents of a shard; words of a block of items that is broadcast, some 20 bytes each.
SHARD, BLOCK = 1 << 15, 1 << 20
#: A posting adds its weight times (TENFOLD * tf) div (1000 * tf + 8 * m), which is below FULL; m is 100 for average length.
TENFOLD, FULL, TOP = 1_000_000_000, 1_000_000, 255


def _counter(vocabulary):
    """For each document its number of terms, and those of the sorted vocabulary with their counts."""
    def run(frames):
        known = vocabulary.value
        for frame in frames:
            got = Words(frame.column("text").to_pylist())
            at = np.minimum(np.searchsorted(known, got.hash), max(0, len(known) - 1))
            asked = known[at] == got.hash if len(known) else np.zeros(len(at), bool)
            pair, count = np.unique(got.text[asked] * max(1, len(known)) + at[asked], return_counts=True)
            offsets = pa.array(np.searchsorted(pair // max(1, len(known)), np.arange(got.n + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [frame.column("doc_id"), pa.array(got.counts), pa.ListArray.from_arrays(offsets, pa.array(pair % max(1, len(known)), pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(count, pa.int64()))], ["doc_id", "n", "terms", "counts"])
    return run


def length_share(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents of ``n`` terms: 100 at average length, of which 75 grow with it."""
    if not len(n) or int(n.max()) * 75 * documents < 1 << 62:
        return 25 + 75 * n * documents // max(total, 1)
    return np.array([25 + 75 * x * documents // total for x in n.tolist()], np.int64)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Shard:
    """The postings of some documents by term, with a byte and the exact frequency share of each."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, terms: np.ndarray, doc: np.ndarray, tf: np.ndarray, vocabulary: int):
        order = np.argsort(terms, kind="stable")  # documents stay in order within a term
        self.ids, self.doc, tf = ids, doc[order], tf[order]
        self.share = TENFOLD * tf // (1000 * tf + 8 * m[self.doc])
        self.impact = (-(-TOP * self.share // FULL)).astype(np.uint8)
        self.bounds = np.searchsorted(terms[order], np.arange(vocabulary + 1))

    def best(self, terms: np.ndarray, weight: np.ndarray, k: int, reached: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all that can be among the k best of this shard and score ``reached`` or more."""
        upper, lower = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), np.int64)
        spans = [slice(self.bounds[t], self.bounds[t + 1]) for t in terms.tolist()]
        for span, w in zip(spans, weight.tolist()):
            impact = self.impact[span].astype(np.int64) * w
            upper[self.doc[span]] += impact
            lower[self.doc[span]] += np.maximum(impact - w, 0)
        # A byte stands for FULL / TOP: upper * FULL >= score * TOP > lower * FULL wherever bytes are above 0.
        least = -(-reached * TOP // FULL)
        if len(lower) > k:
            least = max(least, int(np.partition(lower, len(lower) - k)[len(lower) - k]))
        possible = np.flatnonzero(upper >= max(least, 1))
        score = np.zeros(len(possible), np.int64)
        for span, w in zip(spans, weight.tolist()):
            docs = self.doc[span]
            if len(docs):
                at = np.minimum(np.searchsorted(docs, possible), len(docs) - 1)
                score += np.where(docs[at] == possible, self.share[span][at] * w, 0)
        return possible[score > 0], score[score > 0]


def _searcher(asked, k: int):
    """The k best of a task's documents for each item."""
    def run(frames):
        items, vocabulary, documents, total = asked.value
        best: list[list[tuple]] = [[] for _ in items]
        for shard in _shards(frames, vocabulary, documents, total):
            for i, (terms, weight) in enumerate(items):
                full = best[i][k - 1][0] if len(best[i]) >= k else 0
                docs, scores = shard.best(terms, weight, k, -full)
                if len(docs):
                    found = [(-s, d is None, d or 0) for s, d in zip(scores.tolist(), (shard.ids[j] for j in docs.tolist()))]
                    best[i] = sorted(best[i] + found)[:k]
        rows = [(i, None if null else d, -s) for i, own in enumerate(best) for s, null, d in own]
        for at in range(0, len(rows), 100_000):
            item, doc, score = zip(*rows[at : at + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["item", "doc_id", "score"])
    return run


def _shards(frames, vocabulary: int, documents: int, total: int):
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += frame.num_rows
        if size >= SHARD:
            yield _shard(held, vocabulary, documents, total)
            held, size = [], 0
    if size:
        yield _shard(held, vocabulary, documents, total)


def _shard(frames: list, vocabulary: int, documents: int, total: int) -> Shard:
    rows = pa.Table.from_batches(frames).combine_chunks()
    terms, counts = rows.column("terms").combine_chunks(), rows.column("counts").combine_chunks()
    doc = np.repeat(np.arange(len(terms)), terms.value_lengths().to_numpy(zero_copy_only=False))
    m = length_share(rows.column("n").to_numpy(), documents, total)
    ids = np.array(rows.column("doc_id").to_pylist(), object)
    return Shard(ids, m, terms.flatten().to_numpy(), doc, counts.flatten().to_numpy(), vocabulary)


def _hashed():
    def run(frames):
        for frame in frames:
            got = Words(frame.column("text").to_pylist())
            offsets = pa.array(np.concatenate([[0], np.cumsum(got.counts)]), pa.int32())
            yield pa.RecordBatch.from_arrays([frame.column("item_id"), frame.column("text"), pa.ListArray.from_arrays(offsets, pa.array(got.hash.view(np.int64)))], ["item_id", "text", "words"])
    return run


def ranked(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """For each distinct row of ``items(item_id, text)`` the k best rows of ``docs(doc_id, text)``.

    Rows: item_id, rank from 1, doc_id, score. Terms are runs of ASCII digits and letters,
    A-Z lower-cased, and of anything beyond ASCII. Equal scores go by doc_id, null last; only
    scores above 0 are listed, so items and documents without terms, null or empty, are in no row.
    A term that an item repeats counts as often. Repeated items are one, items that share an
    id but not a text are ranked apart; each row of docs is a document. An empty table
    gives an empty result; other columns are ignored. Terms are told by 64-bit hashes. Items
    go in blocks of about ``block`` words, a bounded size to broadcast; each further block
    reads the texts again.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    distinct = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    asked = table(batches(distinct, _hashed(), "item_id long, text string, words array<long>").withColumn("item", F.xxhash64("item_id", "text")))
    blocks = max(1, -(-(asked.agg(F.sum(F.size("words"))).first()[0] or 0) // block))
    asked = asked.withColumn("block", F.pmod("item", F.lit(blocks)))
    out = None
    for b in range(blocks):
        rows = asked.where(F.col("block") == b).select("item", "item_id", "words").toArrow()
        own = [np.array(x, np.int64).view(np.uint64) for x in rows.column("words").to_pylist()]
        vocabulary = np.unique(np.concatenate([*own, np.zeros(0, np.uint64)]))
        postings = table(batches(slim, _counter(spark.sparkContext.broadcast(vocabulary)), "doc_id long, n long, terms array<int>, counts array<long>"))
        size = postings.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
        # At most one row for each term that is asked for, and these are the block's.
        df = {r[0]: r[1] for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow().to_pandas().itertuples(index=False)}
        weight = np.array([term_weight(size.documents, df.get(t, 0)) for t in range(len(vocabulary))], np.int64)
        queries = []
        for x in own:
            terms, repeats = np.unique(np.searchsorted(vocabulary, x), return_counts=True)
            queries.append((terms, weight[terms] * repeats))
        found = batches(postings, _searcher(spark.sparkContext.broadcast((queries, len(vocabulary), size.documents, int(size.total))), k), "item long, doc_id long, score long")
        names = spark.createDataFrame([(i, r) for i, r in enumerate(rows.column("item_id").to_pylist())], "item long, item_id long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        part = best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all ``documents`` for each item of ``benchmark``."""
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
t AS (SELECT rid, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
v AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM t, s GROUP BY term, big_n),
m AS (SELECT rid, doc_id, 25 + (75 * CAST(len(w) AS BIGINT) * big_n) // big_l AS m FROM d, s WHERE len(w) > 0),
b AS (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark),
q AS (SELECT item_id, text, term, CAST(count(*) AS BIGINT) AS c FROM (SELECT item_id, text,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM b) GROUP BY item_id, text, term),
p AS (SELECT item_id, text, doc_id, rid, CAST(sum(c * v.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN v USING (term) JOIN t USING (term) JOIN m USING (rid) GROUP BY item_id, text, doc_id, rid),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
