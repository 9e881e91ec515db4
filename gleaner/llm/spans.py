"""Regular-expression spans as native column expressions.

Spark extracts matches without their places. Splitting at the same pattern gives the text
between matches, so running lengths give each match's offsets in code points. Texts without
a match, nearly all of them, pay for one pass of the pattern only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"
#: Matches that are placed together.
BLOCK = 64
PLACED = "array<struct<start:int,rank:int,end:int,kind:string>>"


def found(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches, as strings."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def located(text: Column, matches: Column, pattern: str, valid: Callable[[Column], Column], left: bool = False) -> Column:
    """array<struct<start, end, value[, left]>> of the ``matches`` that are ``valid``.

    ``matches`` must be ``found(text, pattern)`` in a column of its own. ``left`` adds the
    text between the previous match and this one.
    """
    kind = "array<struct<start:int,end:int,value:string,left:string>>" if left else SPAN
    pairs = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)), matches, lambda p, m: F.struct(p.alias("gap"), m.alias("m")))
    nothing = F.array().cast(kind)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        fields = [start.alias("start"), end.alias("end"), x["m"].alias("value")] + ([x["gap"].alias("left")] if left else [])
        grown = F.concat(acc["out"], F.array(F.struct(*fields)))
        return F.struct(end.alias("at"), F.when(valid(x["m"]), grown).otherwise(acc["out"]).alias("out"))

    def through(blocks: Column) -> Column:
        """Spans block by block, so that no array grows with all the matches of a long text."""
        sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["m"])))
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(sizes, first, lambda acc, n: F.struct(
            (acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, starts, lambda b, at: F.aggregate(
            b, F.struct(at.alias("at"), nothing.alias("out")), step, lambda acc: acc["out"])))

    blocked = _bound(pairs, lambda p: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")), lambda i: F.slice(p, i * BLOCK + 1, F.lit(BLOCK))))
    return F.when(F.size(matches) > 0, _bound(blocked, through)).otherwise(nothing)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def placed(spans: Column, kind: str, rank: int, first_by_kind: bool = False) -> Column:
    """Spans as sortable structs of place and kind."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def joined(spans: Column, kind_first: bool = False) -> Column:
    """kind:start:end comma-joined, by start then kind, or by kind then start."""
    if kind_first:
        spans = F.transform(spans, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(
        F.array_sort(spans),
        lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
    ), ",")


def masked(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by ``mark``."""
    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        out = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, out).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(F.array_sort(spans), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
