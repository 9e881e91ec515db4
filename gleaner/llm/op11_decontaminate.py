"""Benchmark decontamination by an FM-index of every training shard.

The words of a shard of documents are suffix-sorted; the word before each suffix, in that
order, is the Burrows-Wheeler transform, kept in a wavelet tree of bit vectors. A benchmark
window is found by backward search, two ranks a word, and where it stands by walking back to a
suffix whose position was sampled. The words of its occurrences are merged into the spans
that have to go.

Shards are built where the texts are read, so no text is shuffled. Windows of the benchmark
are dealt into blocks of a bounded size, and only a block is ever broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import batches, table
from gleaner.llm.terms import Words

WIDTH = 10
#: Words of a shard; windows of a block that is broadcast, at most some 100 bytes each; a sampled position in so many.
SHARD, BLOCK, SAMPLE = 1 << 20, 1 << 18, 16

SPANS = "array<struct<first: bigint, past: bigint, start: bigint, end: bigint>>"


class Bits:
    """A bit vector with rank: how many bits are set before a position."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        small = np.packbits(bits, bitorder="little")
        packed[: len(small)] = small
        self.words = packed.view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.total = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletTree:
    """Ranks of symbols below ``sigma``: at each level the symbols are parted by their next bit, zeros first."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for level in reversed(range(max(1, (sigma - 1).bit_length()))):
            ones = (symbols >> level) & 1 == 1
            bits = Bits(ones)
            self.levels.append((level, bits, len(symbols) - bits.total))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(sigma)
        self.start = self._down(every, np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where((symbol >> level) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``i``."""
        return self._down(symbol, i) - self.start[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at ``i``, its rank there)."""
        symbol = np.zeros(len(i), np.int64)
        for level, bits, zeros in self.levels:
            one = bits[i]
            symbol |= one.astype(np.int64) << level
            ones = bits.rank(i)
            i = np.where(one, zeros + ones, i - ones)
        return symbol, i - self.start[symbol]


def suffix_order(symbols: np.ndarray, sigma: int) -> np.ndarray:
    """Start positions of all suffixes in order; the last symbol must be one that stands nowhere else.

    Three symbols are compared at first, then twice as many in each round, and only suffixes
    that are not yet told apart are sorted again.
    """
    n, width = len(symbols), max(1, (sigma - 1).bit_length())
    known = max(1, min(3, 62 // width))
    padded = np.concatenate([symbols, np.zeros(known, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(known):
        key = (key << width) | padded[i : n + i]
    order = np.argsort(key)
    key = key[order]
    slots = np.arange(n)
    while True:
        # Equal keys at ``slots``, which hold the suffixes order[slots], are one group.
        first = np.ones(len(slots), bool)
        first[1:] = (key[1:] != key[:-1])
        lead = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        if len(slots) == n:
            rank = np.empty(n, np.int64)
        rank[order[slots]] = lead
        alone = first.copy()
        alone[:-1] &= first[1:]
        slots = slots[~alone]
        if not len(slots):
            return order
        at = order[slots]
        key = (rank[at] << 31) | rank[at + known]
        again = np.argsort(key)
        order[slots], key = at[again], key[again]
        known *= 2


class FMIndex:
    """Backward search over symbols below ``sigma``; the last symbol stands nowhere else."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        order = suffix_order(symbols, sigma)
        self.tree = WaveletTree(symbols[order - 1], sigma)
        self.first = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(symbols, minlength=sigma), out=self.first[1:])
        sampled = order % SAMPLE == 0
        self.sampled, self.positions = Bits(sampled), order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each row of ``phrases``, right-aligned and filled with -1."""
        live = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.first[-1])
        for column in range(phrases.shape[1] - 1, -1, -1):
            live = live[phrases[live, column] >= 0]
            symbol = phrases[live, column]
            both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low[live], high[live]]))
            low[live] = self.first[symbol] + both[: len(live)]
            high[live] = self.first[symbol] + both[len(live) :]
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in these places of the order, by steps back to a sampled one."""
        out = np.zeros(len(rows), np.int64)
        live, steps = np.arange(len(rows)), 0
        while len(live):
            found = self.sampled[rows]
            out[live[found]] = self.positions[self.sampled.rank(rows[found])] + steps
            live, rows = live[~found], rows[~found]
            symbol, rank = self.tree.access(rows)
            rows, steps = self.first[symbol] + rank, steps + 1
        return out


class Phrases:
    """Distinct windows as right-aligned rows of word hashes, and the items that each belongs to."""

    def __init__(self, rows: pa.Table, width: int):
        words, items = rows.column("words").combine_chunks(), rows.column("item_id").combine_chunks()
        size = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(size)), size)
        within = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        laid = np.zeros((len(size), width + 1), np.int64)
        laid[:, 0] = size
        laid[row, width + 1 - size[row] + within] = words.flatten().to_numpy()
        distinct, which = np.unique(laid, axis=0, return_inverse=True)
        self.lengths, self.words = distinct[:, 0], np.ascontiguousarray(distinct[:, 1:])
        named = items.is_valid().to_numpy(zero_copy_only=False)
        pairs = np.unique(np.column_stack([which.reshape(-1)[named], items.drop_null().to_numpy()]), axis=0)
        self.item = pairs[:, 1]
        self.bounds = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
        self.used = np.arange(width)[None, :] >= width - self.lengths[:, None]

    def items(self, phrase: int) -> list[int]:
        return self.item[self.bounds[phrase] : self.bounds[phrase + 1]].tolist()

    def in_symbols(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows whose words all are in the sorted vocabulary, their symbols, -1 where a row has no word)."""
        at = np.minimum(np.searchsorted(vocabulary, self.words), len(vocabulary) - 1)
        known = (vocabulary[at] == self.words) | ~self.used
        rows = np.flatnonzero(known.all(axis=1))
        return rows, np.where(self.used, at, -1)[rows]


def shards(words: Words, width: int):
    """(symbols, sigma, vocabulary, place of each symbol among the words or -1) for ``SHARD`` words at a time.

    Each text ends with a symbol of its own, so no phrase is found across two texts and copies
    are told apart where they end. Shards overlap by the words that a window can reach across.
    """
    ends = np.cumsum(words.counts)
    for first in range(0, len(words.hash), SHARD):
        past = min(first + SHARD + width - 1, len(words.hash))
        vocabulary, symbols = np.unique(words.hash[first:past].view(np.int64), return_inverse=True)
        cuts = np.unique(ends[(ends > first) & (ends < past)]) - first
        places = np.insert(np.arange(past - first), cuts, -1)
        laid = np.insert(symbols, cuts, len(vocabulary) + np.arange(len(cuts)))
        sigma = len(vocabulary) + len(cuts) + 1
        yield np.append(laid, sigma - 1).astype(np.int64), sigma, vocabulary, np.append(places, -1) + first


def _spans(covered: np.ndarray, words: Words) -> list[list[dict]]:
    """For each text the runs of covered words: their numbers in the text, and their code points."""
    out: list[list[dict]] = [[] for _ in range(words.n)]
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    base = np.concatenate([[0], np.cumsum(words.counts)])
    for first, past in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        while first < past:  # a run may go on in the next text
            text = int(words.text[first])
            stop = min(past, int(base[text + 1]))
            zero = int(words.bounds[text])
            out[text].append({"first": first - int(base[text]), "past": stop - int(base[text]),
                              "start": int(words.start[first]) - zero, "end": int(words.end[stop - 1]) - zero})
            first = stop
    return out


def _found(words: Words, phrases: Phrases) -> tuple[np.ndarray, list[set[int]]]:
    """(whether each word lies in an occurrence, items found in each text)."""
    width = phrases.words.shape[1]
    change = np.zeros(len(words.hash) + 1, np.int64)
    items: list[set[int]] = [set() for _ in range(words.n)]
    for symbols, sigma, vocabulary, places in shards(words, width):
        rows, asked = phrases.in_symbols(vocabulary)
        if not len(rows):
            continue
        index = FMIndex(symbols, sigma)
        low, high = index.search(asked)
        size = high - low
        which = np.repeat(rows, size)
        offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = places[index.locate(np.repeat(low, size) + offset)]
        np.add.at(change, at, 1)
        np.add.at(change, at + phrases.lengths[which], -1)
        pairs = np.unique(words.text[at] * len(phrases.lengths) + which)
        for text, phrase in zip((pairs // len(phrases.lengths)).tolist(), (pairs % len(phrases.lengths)).tolist()):
            items[text].update(phrases.items(phrase))
    return np.cumsum(change[:-1]) > 0, items


def _scanner(phrases):
    def run(frames):
        for frame in frames:
            words = Words(frame.column("text").to_pylist())
            covered, items = _found(words, phrases.value)
            yield pa.RecordBatch.from_arrays(
                [frame.column("row"), frame.column("doc_id"), pa.array(words.counts), pa.array(_spans(covered, words), pa.list_(pa.struct(
                    [(n, pa.int64()) for n in ("first", "past", "start", "end")]))), pa.array([sorted(x) for x in items], pa.list_(pa.int64()))],
                ["row", "doc_id", "n_words", "spans", "items"])
    return run


def _windows(width: int):
    def run(frames):
        for frame in frames:
            words = Words(frame.column("text").to_pylist())
            hashes, items, end = words.hash.view(np.int64).tolist(), frame.column("item_id").to_pylist(), 0
            for i, n in enumerate(words.counts.tolist()):
                own, end = hashes[end : end + n], end + n
                found = [own[j : j + width] for j in range(max(1, n - width + 1))] if n else []
                for j in range(0, len(found), 10_000):
                    part = found[j : j + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([items[i]] * len(part), pa.int64()), pa.array(part, pa.list_(pa.int64()))], ["item_id", "words"])
    return run


def _united(spans: Column) -> Column:
    """Spans of several blocks as runs of words that neither touch nor overlap."""
    # fold: extend the last run where the next one begins within or right after it
    return F.expr(f"""aggregate(array_sort(flatten(collect_list(spans))), CAST(array() AS {SPANS}), (out, s) ->
        IF(size(out) > 0 AND s.first <= element_at(out, -1).past,
           concat(slice(out, 1, size(out) - 1), array(named_struct('first', element_at(out, -1).first, 'past', greatest(element_at(out, -1).past, s.past),
                  'start', element_at(out, -1).start, 'end', greatest(element_at(out, -1).end, s.end)))),
           concat(out, array(s))))""")


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, spans, items.

    ``spans`` are the parts to remove, in order and apart from each other: words ``first`` to
    ``past`` of the document, code points ``start`` to ``end`` of its text. ``items`` are the sorted
    distinct item_ids of ``benchmark(item_id, text)`` with a window in the document. A window is
    ``width`` consecutive words of an item, or a shorter item as a whole.

    Null and empty texts have no words, no spans and no items; so have items without words,
    which are never found. An item without an id marks words but is not listed. Repeated
    items count once, repeated documents give a row each, also where they share a doc_id or
    have none. Long texts are indexed a shard of words at a time, with overlap. Words are
    told by 64-bit hashes. Empty tables give empty results, or documents without spans; other
    columns are ignored.
    """
    spark = docs.sparkSession
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    windows = table(batches(asked, _windows(width), "item_id long, words array<long>").distinct())
    blocks = max(1, -(-windows.count() // block))
    windows = windows.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    slim = docs.select(F.lit(None).cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if blocks > 1:  # a number for each row, written once, by which the blocks' findings meet
        slim = table(slim.withColumn("row", F.monotonically_increasing_id()))
    found = None
    for b in range(blocks):
        part = windows.where(F.col("block") == b).toArrow()
        phrases = spark.sparkContext.broadcast(Phrases(part, width))
        one = batches(slim, _scanner(phrases), f"row long, doc_id long, n_words long, spans {SPANS}, items array<long>")
        found = one if found is None else found.unionByName(one)
    if blocks > 1:
        found = found.groupBy("row", "doc_id", "n_words").agg(
            _united(F.col("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return found.drop("row")


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against all of ``benchmark``."""
    found = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, len(w) AS n_words FROM d),
p AS (SELECT rid, i, n_words, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o, lead(word, 6) OVER o, lead(word, 7) OVER o, lead(word, 8) OVER o, lead(word, 9) OVER o] AS w
      FROM t WINDOW o AS (PARTITION BY rid ORDER BY i)),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS phrase
      FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT n, phrase FROM q),
g AS (SELECT rid, i, n, array_to_string(list_slice(w, 1, n), ' ') AS phrase FROM p, (SELECT DISTINCT n FROM s) WHERE i + n - 1 <= n_words),
h AS (SELECT rid, i, n, phrase FROM g JOIN s USING (n, phrase)),
c AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS place FROM h) GROUP BY rid),
f AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h JOIN q USING (n, phrase) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN f USING (rid)
"""
