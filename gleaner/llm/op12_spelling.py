"""Spelling variants: words one edit apart, by a rare-first q-gram prefix filter.

Bigrams are ordered over all words by frequency. One edit destroys at most two of a word's
bigrams, so of the three rarest of either word at least one is left in the other, and the rarer of
the two prefixes holds it; repeats of the third go along, as their order is by position alone. Words
are joined on a bigram of both prefixes only where length and position allow one edit:
equal lengths and positions for a replaced letter, and one or none behind in the longer word
for an inserted one. Every pair that is left is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import batches, table

LEAST_LENGTH, LEAST_COUNT, PREFIX = 5, 3, 3
#: One run in so many is misspelt by the contract; distinct words that a task holds before it puts them out.
MISSPELT, HELD = 97, 200_000
#: How a bigram's rank, position and word length are summed to one number; beyond these sizes sums may meet by chance, which verifying mends.
LONGEST = 1 << 21
PLACE = LONGEST * LONGEST

_RUN = re.compile(rf"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")  # maximal, as no shorter run can give a word
_ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def misspelt(prefix: int, run: str) -> str:
    """The run, without one letter if the checksum of what stands for ``prefix`` and of the run says so."""
    h = zlib.crc32(run.encode(), prefix)
    if h % MISSPELT:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def _counter(frames):
    held: Counter = Counter()
    for frame in frames:
        for doc, text in zip(frame.column("doc_id").to_pylist(), frame.column("text").to_pylist()):
            prefix = zlib.crc32(b":" if doc is None else b"%d:" % doc)
            for run, n in Counter(_RUN.findall(text)).items():
                word = misspelt(prefix, run.lower() if run.isascii() else run.translate(_ASCII))
                if len(word) >= LEAST_LENGTH:
                    held[word] += n
            if len(held) >= HELD:
                yield _counted(held)
                held = Counter()
    if held:
        yield _counted(held)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


def lexicon(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least 5 letters that stand 3 times or more in ``docs(doc_id, text)``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).where("text is not null")
    counts = batches(slim, _counter, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def prefix_of(word: str, order: dict[str, int]) -> list[tuple[str, int]]:
    """The three rarest bigrams of a word with their positions, and repeats of the third."""
    grams = sorted((order[word[i : i + 2]], i) for i in range(len(word) - 1))
    last = grams[min(PREFIX, len(grams)) - 1][0]
    return [(word[i : i + 2], i) for rank, i in grams if rank <= last]


def letters(word: str) -> int:
    """Whether each letter, of 64 classes, stands in the word an odd number of times; one edit changes two bits at most."""
    bits = 0
    for ch in word:
        bits ^= 1 << (ord(ch) & 63)
    return bits - ((bits >> 63) << 64)


def _prefixes(order):
    """A row for each bigram of a word's prefix; ``place`` holds the bigram's rank, its position and the word's length."""
    def run(frames):
        for frame in frames:
            rows = []
            for w, n in zip(frame.column("word").to_pylist(), frame.column("n").to_pylist()):
                bits = letters(w)
                rows += [(w, n, bits, order.value[g] * PLACE + i * LONGEST + len(w)) for g, i in prefix_of(w, order.value)]
            for at in range(0, len(rows), 50_000):
                word, n, bits, place = zip(*rows[at : at + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n, pa.int64()), pa.array(bits, pa.int64()), pa.array(place, pa.int64())], ["word", "n", "bits", "place"])
    return run


def near(words: DataFrame) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of ``words(word, n)`` one edit apart, each once; a is the shorter, or the smaller of equal length.

    ``word`` is unique and of two characters at least.
    """
    spark = words.sparkSession
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, 2))).alias("gram"))
    # One row a bigram: at most 8,100 of the letters that words are made of.
    counted = grams.groupBy("gram").count().orderBy("count", "gram").toArrow().column("gram").to_pylist()
    order = spark.sparkContext.broadcast({g: i for i, g in enumerate(counted)})
    index = table(batches(words.select("word", "n"), _prefixes(order), "word string, n long, bits long, place long"))
    # Where the bigram can stand in the other word: same length and place, or one longer and as far or one further.
    steps = F.array(F.lit(0), F.lit(1), F.lit(LONGEST + 1))
    probe = index.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("own"), "place", F.explode(steps).alias("step"))
    probe = probe.select("a", "n_a", "own", (F.col("place") + F.col("step")).alias("place"), (F.col("step") > 0).alias("longer"))
    pairs = probe.join(index.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "bits", "place"), "place")
    few = F.bit_count(F.col("own").bitwiseXOR(F.col("bits"))) <= 2  # cheap, and lets no pair of one edit go
    return (
        pairs.where(few & (F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
        .select("a", "n_a", "b", "n_b").distinct()
    )


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: where the forms of forms end. Each round doubles the way that is known."""
    found = table(forms.select("word", F.col("form").alias("root")))
    while True:
        up = found.select(F.col("word").alias("root"), F.col("root").alias("_up"))
        found = table(found.join(up, "root", "left").select("word", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("moved")))
        if found.where("moved").isEmpty():
            return found.drop("moved")
        found = found.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """One row per word of ``docs(doc_id, text)``: word, form, root, n, n_near, form_n.

    Words are as in ``lexicon``; ``misspelt`` runs are counted under what is left of them. Two words
    are near if one inserted, deleted or replaced letter parts them. A word's form is the near word of
    largest n, ties by code points, where that n is at least twice its own; root follows forms to
    the last. Null and empty texts have no words, a null doc_id reads as nothing before the
    colon, repeated rows count again, an empty table gives an empty result; other columns are
    ignored. Forms at least double n, so no chain of forms is longer than 63.
    """
    words = table(lexicon(docs))
    pairs = table(near(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("other"))).alias("_best"))
    taken = -F.col("_best.m") >= 2 * F.col("n")
    linked = table(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("_best.other")).alias("form"), F.when(taken, -F.col("_best.m")).alias("form_n")))
    roots = rooted(linked.where("form is not null"))
    return linked.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all ``documents`` with their forms."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
        lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
r AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY doc_id, run),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM r, tab WHERE length(run) >= 5),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 97 = 0
        THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM h)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, b.word AS other, b.n AS m FROM x a JOIN x b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word AND length(a.word) = length(b.word)
      UNION SELECT x.word, w.word, w.n FROM x JOIN w ON x.cut = w.word
      UNION SELECT w.word, x.word, x.n FROM x JOIN w ON x.cut = w.word),
g AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n FROM w LEFT JOIN g USING (word)),
c AS (WITH RECURSIVE c(word, root, up) AS (SELECT word, word, form FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON c.up = f.word)
      SELECT word, root FROM c WHERE up IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM f JOIN c USING (word)
"""
