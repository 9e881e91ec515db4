"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import spread_join, table


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(id, component) for each id in ``edges(a, b)``; component is the smallest id reachable.

    Each round is a map-side combined minimum and a join in which the edges of a hub are dealt
    over several tasks, then a written table; the edge list never grows and stays
    distributed. Raises if ``max_rounds`` don't suffice,
    rather than return a partial labelling. Self loops and null ends are ignored; an empty
    list gives an empty result.
    """
    edges = table(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = None
    for _ in range(max_rounds):
        # Large star: every neighbour above u joins the smallest of u and its neighbours.
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            spread_join(both, low, ["u"], F.col("v")).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: every neighbour at or below u, and u itself, joins the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = spread_join(large, low, ["u"], F.col("v"))
        edges = table(
            hooked.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        now = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
