"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key divided by its quality weight; the smallest keys of
a source come first. A source whose target exceeds its size is taken whole as many times
as fit (complete epochs), and the rest of its target is filled in key order up to the
budget. The prefix sum that finds the end of the budget is taken over a fixed number of
key bins per source, summed map-side; only the one bin in which the budget ends is sorted,
so no source is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import SPACE, spread_join, table

WEIGHTS = (5, 2, 1)
MOST = 3
BINS = 1 << 13
#: Least quality weight. Bins are even for rows of this weight; none holds more than 1 / (BINS * LEAST) of a source's rows
#: by expectation whatever their weights.
LEAST = 0.2
SEED = 7
#: Most sources whose plan is broadcast, about 100 bytes each; beyond, a salted join.
SOURCES = 20_000
_BLANKS = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of runs free of ASCII white space; 0 for null."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]*+[^{SPACE}]++", "x")
    return F.length(F.rtrim(marks, F.lit(_BLANKS))).cast("long")


def quality_weight(text: Column) -> Column:
    """Between LEAST and 1: falls with the share of characters that prose hardly uses."""
    text = F.coalesce(text, F.lit(""))
    kept = F.length(F.regexp_replace(text, r"[!#$%&*|<>{}\[\]\\^~`=@_]+", ""))
    return F.greatest(F.lit(LEAST), 1 - 3 * (1 - kept / F.greatest(F.length(text), F.lit(1))))


def sampling_key(doc_id: Column, text: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of the document."""
    drawn = F.shiftrightunsigned(F.xxhash64(doc_id, text, F.lit(seed)), 11)
    return -F.log((drawn.cast("double") + 0.5) / float(1 << 53)) / weight


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes(source, source_size)`` with ``target``: shares of the total by weight, capped.

    Weights go round the sources by code point, null last. A target above ``most`` times
    its source's size stops there and the excess goes to the others by weight. Raising the
    water level until no target is above its cap has a closed form over sources sorted by
    cap / weight. Source-level rows only: one per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("w", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    level = (
        (F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
         - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    )
    levelled = ranked.withColumn("level", level).withColumn(
        "level", F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))
    )
    water = F.first("level", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return levelled.withColumn("water", water).select(
        "source", "source_size",
        F.least("cap", F.coalesce(F.col("water") * F.col("w"), F.col("cap"))).alias("target"),
    )


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    """docs with their size and sampling key; the text is read once for both."""
    key = sampling_key(F.col("doc_id"), F.coalesce("text", F.lit("")), quality_weight(F.col("text")), seed)
    return (
        docs.withColumn("_size", word_count(F.col("text"))).withColumn("_key", key)
        .withColumn("_bin", F.floor((1 - F.exp(-F.col("_key") * LEAST)) * BINS).cast("int"))
    )


def _taken(rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``rows(source, doc_id, _size, _key, _bin, ...)`` with _source_size, _target, _epochs and _part.

    A row is taken whole _epochs times and then _part of its words. Rows with a payload ``_row`` also have
    a unique ``_id``.
    """
    same = F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull()
    summed = rows.groupBy("source", "_bin").agg(F.sum("_size").alias("words"))
    planned = targets(summed.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    wanted = F.round("target").cast("long")
    size = F.greatest("source_size", F.lit(1))
    planned = planned.withColumn("_epochs", F.floor(wanted / size)).withColumn("_rest", wanted - F.col("_epochs") * F.col("source_size"))
    bins = Window.partitionBy("source").orderBy("_bin")
    ends = (
        summed.withColumn("through", F.sum("words").over(bins))
        .join(planned.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        .where(F.col("through") >= F.col("_rest"))
        .groupBy("source").agg(
            F.min(F.struct("_bin", (F.col("through") - F.col("words")).alias("before"))).alias("end"),
            F.first("source_size").alias("_source_size"), F.first("target").alias("_target"),
            F.first("_epochs").alias("_epochs"), F.first("_rest").alias("_rest"),
        )
        .select(same[0].alias("_s"), same[1].alias("_n"), F.col("end._bin").alias("_end"), F.col("end.before").alias("_before"),
                "_source_size", "_target", "_epochs", "_rest")
    )
    # One row per source: broadcast where they are few, so that texts stay where they are.
    ends = table(ends)
    keyed = rows.withColumn("_s", same[0]).withColumn("_n", same[1])
    if ends.limit(SOURCES + 1).count() <= SOURCES:
        joined = keyed.join(F.broadcast(ends), ["_s", "_n"])
    else:
        joined = spread_join(keyed, ends, ["_s", "_n"], F.col("_key"), 64)
    clear = joined.where(F.col("_bin") != F.col("_end")).withColumn(
        "_part", F.when(F.col("_bin") < F.col("_end"), F.col("_size")).otherwise(F.lit(0)).cast("long")
    )
    order = Window.partitionBy("_s", "_n").orderBy("_key", "doc_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("_rest") - F.col("_before") - F.coalesce(F.sum("_size").over(order), F.lit(0))
    ending = joined.where(F.col("_bin") == F.col("_end"))
    # Whole rows stay out of the sort; those of the bins in which budgets end come back by their numbers.
    narrow = ending.drop("_row") if "_row" in rows.columns else ending
    last = narrow.withColumn("_part", F.greatest(F.lit(0), F.least(room, F.col("_size"))).cast("long"))
    if "_row" in rows.columns:
        last = last.join(ending.select("_id", "_row"), "_id")
    return clear.unionByName(last)


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``: doc_id, size, source_size, target, taken.

    ``size`` counts words (null text: 0). ``taken`` counts the words the mix takes, repeats
    counted: complete epochs first, then whole documents in key order, and of the document
    in which the budget ends as many words as are left. Ties in the key are broken by
    doc_id; equal rows are interchangeable. Null is a source of its own, after all others.
    Empty documents and sources take nothing. An empty table gives an empty result.
    """
    slim = docs.select(F.col("doc_id"), F.col("source"), F.col("text"))
    rows = table(_keyed(slim, seed).drop("text"))
    return _taken(rows, weights, most).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_epochs") * F.col("_size") + F.col("_part")).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document as often as it is taken.

    The last copy of the one document per source in which the budget ends holds its first
    words only, up to the budget. Columns beside doc_id, text and source are carried as they
    are, but ``n_chars``, where there is one, follows a shortened text. Names that start
    with an underscore and clash with working columns are set aside and restored.
    """
    names = docs.columns
    payload = docs.select(F.col("doc_id"), F.col("source"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    # Texts are counted and weighed once; the plan reads what is written beside them, and numbers that are written stay.
    keyed = table(_keyed(payload, seed).drop("text").withColumn("_id", F.monotonically_increasing_id()))
    rows = _taken(keyed, weights, most)
    whole = F.when(F.col("_epochs") > 0, F.array_repeat(F.lit(False), F.col("_epochs").cast("int"))).otherwise(F.array().cast("array<boolean>"))
    part = F.when(F.col("_part") > 0, F.array(F.col("_part") < F.col("_size"))).otherwise(F.array().cast("array<boolean>"))
    copies = rows.select("_row", "_part", F.explode(F.concat(whole, part)).alias("_short"))
    head = F.expr(f"regexp_extract(_row.text, concat('^(?:[{SPACE}]*+[^{SPACE}]++){{', _part, '}}+'), 0)".replace("\\", "\\\\"))
    text = F.when(F.col("_short"), head).otherwise(F.col("_row.text"))
    out = []
    for c in names:
        if c == "text":
            out.append(text.alias(c))
        elif c == "n_chars":
            out.append(F.when(F.col("_short"), F.length(text)).otherwise(F.col("_row.n_chars")).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col("_row").getField(c).alias(c))
    return copies.select(*out)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, sources weighing 5, 2, 1 in turn."""
    return mixed_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, with the columns they have.

    Null and empty texts are never taken. Rows without a source are a source of their own, and rows
    without an id are drawn by their text. Rows that repeat are documents of their own; equal ones are
    interchangeable. An empty table gives an empty one, and columns that clash with working names
    come back as they were.
    """
    return mixed_documents(docs)
