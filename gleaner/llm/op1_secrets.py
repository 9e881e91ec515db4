"""Secret scan: fixed patterns and a battery of randomness tests, all in native expressions.

Beside the pattern spans, every long token of key-like characters is tested. Its encoding is
inferred (hexadecimal, base-32, lower-case alphanumeric, base-64) and gives its alphabet.
Two tests weigh it against ordinary writing: the chi-squared distance from a uniform
alphabet, far smaller for keys than letter frequencies allow, and the runs of character
classes, far more frequent in keys than in words. Three tests check that it is consistent
with a uniform source: chi-squared, runs about the middle of the alphabet and lag-one serial
correlation. Which tokens count is then decided by Benjamini-Hochberg control of the false
discovery rate within strata of encoding and length, so short tokens need stronger proof.

The corpus-wide part is one histogram with a fixed number of cells (stratum by p-value bin).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import table
from gleaner.llm.spans import found, joined, located, masked, placed

# Fixed patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
LONG = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
KINDS = ("assign", "access", "hex")
MARK = "[SECRET]"

FALSE_DISCOVERIES = 0.001
#: Least p-value of the uniformity tests together.
UNIFORM = 0.001
#: Chance that ordinary writing changes character class from one character to the next.
CLASS_CHANGE = 0.1
#: Encodings: name, pattern, alphabet, sum of squared symbol shares in ordinary writing.
ENCODINGS = (
    ("hex", "^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.11),
    ("base32", "^[A-Z2-7]+=*$", "abcdefghijklmnopqrstuvwxyz234567", 0.066),
    ("lower", "^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789", 0.066),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.06),
)
BINS_PER_NAT, MOST_BINS = 4, 400


def _minus_log_normal_tail(z: Column) -> Column:
    """-ln P(N > z), by a closed approximation within a few per cent."""
    t = F.greatest(z, F.lit(0.0))
    tail = t * t / 2 + 0.5 * math.log(2 * math.pi) + F.log(0.661 * t + 0.339 * F.sqrt(t * t + 5.51))
    return F.when(z > 0, tail).otherwise(-F.log(1 - F.exp(-(z * z / 2 + 0.5 * math.log(2 * math.pi) + F.log(0.661 * -z + 0.339 * F.sqrt(z * z + 5.51))))))


def _symbols(alphabet: Column, text: Column) -> Column:
    return F.transform(F.filter(F.split(text, ""), lambda s: s != ""), lambda s: F.call_function("locate", s, alphabet).cast("double") - 1)


def tested(tokens: Column) -> Column:
    """For each token its stratum, the -ln p of being ordinary writing and that of being uniform."""
    alphabets = F.array(*[F.lit(e[2]) for e in ENCODINGS])
    shares = F.array(*[F.lit(e[3]) for e in ENCODINGS])

    def described(c: Column) -> Column:
        v = F.regexp_replace(c["value"], "=+$", "")
        chosen = F.lit(len(ENCODINGS) - 1)
        for i in range(len(ENCODINGS) - 2, -1, -1):
            chosen = F.when(c["value"].rlike(ENCODINGS[i][1]), F.lit(i)).otherwise(chosen)
        plain = F.when(chosen < 2, F.lower(v)).otherwise(F.translate(v, "-_", "+/"))
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), v.alias("value"), chosen.alias("encoding"), plain.alias("plain"),
            F.length(v).cast("double").alias("n"), F.length(F.element_at(alphabets, chosen + 1)).cast("double").alias("k"),
            F.element_at(shares, chosen + 1).alias("share"), _symbols(F.element_at(alphabets, chosen + 1), plain).alias("at"),
        )

    def counted(c: Column) -> Column:
        squares = F.aggregate(
            F.array_distinct(F.filter(F.split(c["plain"], ""), lambda s: s != "")), F.lit(0.0),
            lambda acc, s: acc + F.pow(F.length(c["plain"]) - F.length(F.replace(c["plain"], s, F.lit(""))), F.lit(2)),
        )
        middle = (c["k"] - 1) / 2
        walk = F.aggregate(
            c["at"],
            F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("lagged"), F.lit(0.0).alias("power"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("high")),
            lambda acc, x: F.struct(
                x.alias("last"),
                (acc["lagged"] + F.coalesce((acc["last"] - middle) * (x - middle), F.lit(0.0))).alias("lagged"),
                (acc["power"] + (x - middle) * (x - middle)).alias("power"),
                (acc["runs"] + F.when(acc["last"].isNull() | ((acc["last"] > middle) != (x > middle)), 1.0).otherwise(0.0)).alias("runs"),
                (acc["high"] + F.when(x > middle, 1.0).otherwise(0.0)).alias("high"),
            ),
        )
        changes = F.length(F.regexp_replace(c["value"], r"[a-z]++|[A-Z]++|[0-9]++|[^a-zA-Z0-9]++", "x")) - 1
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["encoding"].alias("encoding"), c["n"].alias("n"), c["k"].alias("k"), c["share"].alias("share"),
            (c["k"] / c["n"] * squares - c["n"]).alias("chi"), walk.alias("walk"), changes.cast("double").alias("changes"),
        )

    def judged(c: Column) -> Column:
        n, k = c["n"], c["k"]
        spread = n * (k * c["share"] - 1)
        ordinary_chi = _minus_log_normal_tail(-(c["chi"] - (k - 1) - spread) / F.sqrt(2 * (k - 1 + 2 * spread)))
        rate = F.least(F.greatest(c["changes"] / F.greatest(n - 1, F.lit(1.0)), F.lit(1e-6)), F.lit(1 - 1e-6))
        divergence = rate * F.log(rate / CLASS_CHANGE) + (1 - rate) * F.log((1 - rate) / (1 - CLASS_CHANGE))
        ordinary_runs = F.when(rate > CLASS_CHANGE, (n - 1) * divergence).otherwise(0.0)
        both = ordinary_chi + ordinary_runs
        ordinary = both - F.log(1 + both)
        uniform_chi = _minus_log_normal_tail((c["chi"] - (k - 1)) / F.sqrt(2 * (k - 1)))
        high = c["walk"]["high"]
        low = n - high
        expected = 2 * high * low / n + 1
        varied = F.greatest((expected - 1) * (expected - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(1e-6))
        uniform_runs = _minus_log_normal_tail(F.abs(c["walk"]["runs"] - expected) / F.sqrt(varied)) - math.log(2)
        serial = c["walk"]["lagged"] / F.greatest(c["walk"]["power"], F.lit(1e-9)) * F.sqrt(n)
        uniform_serial = _minus_log_normal_tail(F.abs(serial)) - math.log(2)
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"),
            (c["encoding"] * 16 + F.least(F.floor(F.log2(n)), F.lit(15)).cast("int")).alias("stratum"),
            F.greatest(F.lit(0), F.least(F.floor(ordinary * BINS_PER_NAT).cast("int"), F.lit(MOST_BINS))).alias("bin"),
            (F.greatest(uniform_chi, uniform_runs, uniform_serial) - math.log(3) <= -math.log(UNIFORM)).alias("uniform"),
        )

    # Numbers are not keys, and neither are tokens with next to no different characters.
    keylike = F.filter(tokens, lambda c: c["value"].rlike("[A-Za-z]") & c["value"].rlike("[0-9+/_A-Z-]"))
    return F.transform(F.transform(F.transform(keylike, described), counted), judged)


def _scanned(docs: DataFrame, text: str) -> DataFrame:
    """docs with _base (sortable spans), their counts and _tokens (tested tokens outside them)."""
    t = F.col(text)
    out = docs
    for kind, pattern in (*zip(KINDS, (ASSIGN, ACCESS, HEX)), ("long", LONG)):
        out = out.withColumn(f"_m_{kind}", found(t, pattern))
    valid = {
        "assign": lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12,
        "access": lambda m: F.length(m) >= 18,
        "hex": lambda m: F.length(m) >= 16,
        "long": lambda m: F.length(m) >= 20,
    }
    for kind, pattern in (*zip(KINDS, (ASSIGN, ACCESS, HEX)), ("long", LONG)):
        out = out.withColumn(f"_s_{kind}", located(t, F.col(f"_m_{kind}"), pattern, valid[kind]))
    base = F.concat(*[placed(F.col(f"_s_{kind}"), kind, i) for i, kind in enumerate(KINDS)])
    out = out.withColumn("_base", base)
    apart = F.filter("_s_long", lambda c: ~F.exists("_base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return out.withColumn("_tokens", tested(apart))


def thresholds(scanned: DataFrame, rate: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """Least p-value bin per stratum that keeps the false discovery rate, over all rows.

    The table that comes to the driver has at most one row per stratum and bin.
    """
    cells = (
        scanned.select(F.explode("_tokens").alias("t")).groupBy("t.stratum", "t.bin").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    strata: dict[int, dict[int, int]] = {}
    for r in cells:
        strata.setdefault(r["stratum"], {})[r["bin"]] = r["n"]
    out = {}
    for stratum, bins in strata.items():
        total, through = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            through += bins[b]
            if math.exp(-b / BINS_PER_NAT) * total <= rate * through:
                out[stratum] = b
    return out


def _decided(scanned: DataFrame, least: dict[int, int]) -> DataFrame:
    """scanned with _all: base spans and discovered ones."""
    limit = F.lit(None).cast("int")
    if least:
        table = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
        hits = F.filter("_tokens", lambda c: c["uniform"] & (c["bin"] >= F.coalesce(table[c["stratum"]], F.lit(MOST_BINS + 1))))
    else:
        hits = F.filter("_tokens", lambda c: limit.isNotNull())
    return scanned.withColumn("_all", F.concat("_base", placed(hits, "random", len(KINDS))))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Spans are in code points, end exclusive. Tokens are tested that have 20 characters or more,
    and letters as well as a digit, capital or sign among them; others are found only by the
    fixed patterns. A null or empty text has none; rows may repeat and ids may be null. An empty table gives an empty result; other columns are ignored.
    """
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    # Texts are read once; the decision takes what they hold from a table of spans.
    scanned = table(_scanned(slim, "_text").select(
        "doc_id", *[F.size(f"_s_{k}").cast("long").alias(f"n_{k}") for k in KINDS], "_base", "_tokens"))
    decided = _decided(scanned, thresholds(scanned))
    return decided.select(
        "doc_id", *[f"n_{k}" for k in KINDS],
        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"), joined(F.col("_all")).alias("spans"),
        (F.size("_all") - F.size("_base")).cast("long").alias("n_random"),
    )


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; all documents stay, ``n_chars`` follows the text."""
    # The whole rows are written beside their spans, which costs less than scanning them twice.
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    scanned = table(_scanned(kept, "_text").select("_row", "_base", "_tokens")).withColumn("_text", F.coalesce("_row.text", F.lit("")))
    decided = _decided(scanned, thresholds(scanned)).withColumn("_new", masked(F.col("_text"), F.col("_all"), MARK))
    changed = F.size("_all") > 0
    out = []
    for c in docs.columns:
        value = F.col("_row").getField(c)
        if c == "text":
            value = F.when(changed, F.col("_new")).otherwise(value)
        elif c == "n_chars":
            value = F.when(changed, F.length("_new")).otherwise(value).cast(docs.schema[c].dataType)
        out.append(value.alias(c))
    return decided.select(*out)
