"""Personal data: fixed patterns, then bootstrapped contextual extraction, in native expressions.

What the fixed patterns find are seed entities. The words that stand before them, with the
shape of what follows, are lexical patterns. All instances in the corpus, number-like or
joined by @ or _, and the patterns they occur under form a bipartite graph. Scores go back and forth over it a fixed
number of rounds: a pattern is worth the share of its distinct instances that are believed,
once enough distinct ones support it; an instance is believed as far as one of its patterns
is. Instances under high-confidence patterns that no fixed pattern covers are the unseen
identifiers, returned as spans of their own kinds.

Edges are counted map-side before they are shuffled, instances and patterns are never
collected, and documents meet their discoveries through a hash of their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import spread_join, table
from gleaner.llm.spans import found, joined, located, placed

# Fixed patterns; the possessive forms match what the plain ones do, in linear time.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: Instances: a word with a digit and the number groups that follow it, or a word joined by @ or _.
INSTANCE = r"(?<!\S)(?:[^\s0-9]*+[0-9]\S*+(?:\x20[0-9().+-]++(?!\S))*+|[^\s0-9@_]++[@_]\S++)"
#: Instances that need no DIGITS digits: handles, mail and network addresses.
JOINED = r"\w[@_]\w|^[0-9]+(?:\.[0-9]+){3}(?![0-9])"

ROUNDS = 3
#: Digits that other instances must have, distinct seeds a pattern needs, and the score of confidence.
DIGITS, SUPPORT, CONFIDENT = 6, 3, 0.8


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = F.reverse(F.split(_digits(value), ""))
    digits = F.filter(digits, lambda d: d != "")
    weighed = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + x) % 10 == 0


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(p.try_cast("bigint"), F.lit(999)) <= 255)),
    "card": lambda m: F.length(_digits(m)).between(13, 19) & luhn(m),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _scanned(slim: DataFrame) -> DataFrame:
    """slim(_text, ...) with _base and the spans of each kind."""
    t = F.col("_text")
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE)))
    for kind, pattern in patterns.items():
        slim = slim.withColumn(f"_m_{kind}", found(t, pattern))
    for kind, pattern in patterns.items():
        slim = slim.withColumn(f"_s_{kind}", located(t, F.col(f"_m_{kind}"), pattern, VALID[kind]))
    return slim.withColumn("_base", F.concat(*[placed(F.col(f"_s_{k}"), k, i) for i, k in enumerate(KINDS)]))


def _candidates(text: Column, matches: Column) -> Column:
    """Places of the instances of a text, with the words before them."""
    wanted = lambda m: (F.length(_digits(m)) >= DIGITS) | m.rlike(JOINED)
    return F.transform(located(text, matches, INSTANCE, wanted, left=True), lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value"),
        # All that stands after the last space but one: at most two words, however long.
        F.substring_index(F.rtrim(F.regexp_replace(c["left"], r"\s+", " ")), " ", -2).alias("left")))


def _instances(once: DataFrame) -> DataFrame:
    """A row per instance of ``once(_h, _g, _base, _c)``: its text's key, place, value, kind if a seed, and patterns."""
    rows = once.where(F.size("_c") > 0).select("_h", "_g", "_base", F.explode("_c").alias("c"))
    inner = F.filter("_base", lambda b: (b["start"] < F.col("c.end")) & (F.col("c.start") < b["end"]))
    words = F.split(F.lower(F.col("c.left")), " ")
    word = lambda i: F.regexp_replace(F.coalesce(F.try_element_at(words, F.lit(i)), F.lit("")), r"[^\p{L}]", "")
    shape = F.regexp_replace(F.regexp_replace("c.value", "[0-9]", "9"), r"\p{L}+", "a")
    return (
        rows.withColumn("seed", F.when(F.size(inner) > 0, F.element_at(F.array_sort(inner), 1)["kind"]))
        .withColumn("w1", word(-1)).withColumn("w2", word(-2)).where(F.col("w1") != "")
        .select(
            "_h", "_g", F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.col("c.value").alias("value"), "seed",
            F.array(F.xxhash64(F.lit("shape"), "w1", shape), F.xxhash64(F.lit("words"), "w2", "w1")).alias("patterns"),
        )
    )


def bootstrap(instances: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confident: float = CONFIDENT) -> DataFrame:
    """(pattern, kind, confidence) of the patterns that end above ``confident``."""
    edges = table(
        instances.select(F.explode("patterns").alias("pattern"), F.xxhash64("value").alias("instance"), "seed")
        .groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    )
    # Only patterns that some seed occurs under, and the instances they reach, can ever score.
    believed = edges.where(F.col("seed").isNotNull()).groupBy("instance").agg(F.max("seed").alias("kind")).withColumn("belief", F.lit(1.0))
    scores = None
    for _ in range(rounds):
        reached = spread_join(edges.select("pattern", "instance"), believed, ["instance"], F.col("pattern"), how="left")
        per_kind = reached.groupBy("pattern", "kind").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("belief", F.lit(0.0))).alias("mass"))
        totals = per_kind.groupBy("pattern").agg(F.sum("n").alias("all"), F.max(F.when(F.col("kind").isNotNull(), F.struct("mass", "kind"))).alias("best"))
        scores = (
            totals.where(F.col("best.mass") >= support)
            .select("pattern", F.col("best.kind").alias("kind"), (F.col("best.mass") / F.col("all")).alias("confidence"))
            .where(F.col("confidence") >= confident)
        )
        scores = table(scores)
        spread = spread_join(edges.where(F.col("seed").isNull()), scores, ["pattern"], F.col("instance")).groupBy("instance").agg(
            F.max(F.struct(F.col("confidence").alias("belief"), "kind")).alias("b"))
        believed = believed.where(F.col("belief") == 1.0).unionByName(
            spread.select("instance", F.col("b.kind").alias("kind"), (F.col("b.belief") * 0.999).alias("belief")))
    return scores


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context.

    Spans are in code points, end exclusive; discovered ones have the kind of the seeds that
    led to them with ``_context`` added. A null or empty text has none; rows may repeat and
    ids may be null. An empty table gives an empty result; other columns are ignored.
    """
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    slim = slim.withColumn("_h", F.xxhash64("_text")).withColumn("_g", F.xxhash64(F.lit(9), F.reverse("_text")))
    with_instances = F.when(F.length("_text") > 0, found(F.col("_text"), INSTANCE)).otherwise(F.array().cast("array<string>"))
    # Texts are read once; from here on only places and what stands there are carried.
    once = table(
        _scanned(slim.withColumn("_m", with_instances)).select(
            "doc_id", "_h", "_g", *[F.size(f"_s_{k}").cast("long").alias(f"n_{k}") for k in KINDS], "_base",
            _candidates(F.col("_text"), F.col("_m")).alias("_c"))
    )
    instances = table(_instances(once))
    patterns = bootstrap(instances)
    discovered = (
        spread_join(instances.where(F.col("seed").isNull()).select("_h", "_g", "start", "end", F.explode("patterns").alias("pattern")),
                    patterns, ["pattern"], F.struct("_h", "start"))
        .groupBy("_h", "_g", "start", "end").agg(F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
        .groupBy("_h", "_g").agg(F.collect_list(F.struct(
            F.col("start"), (F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")) + 3).cast("int").alias("rank"),
            F.col("end"), F.concat("kind", F.lit("_context")).alias("kind"))).alias("_more"))
    )
    narrow = once.drop("_c").withColumn("base_sha256", F.sha2(joined(F.col("_base"), kind_first=True), 256))
    more = F.coalesce("_more", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))
    return spread_join(narrow, discovered, ["_h", "_g"], F.col("doc_id"), how="left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
        joined(F.concat("_base", more), kind_first=True).alias("spans"), F.size(more).cast("long").alias("n_context"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
