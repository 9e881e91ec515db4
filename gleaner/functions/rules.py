"""Rule engines as single column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import config as C
from gleaner.functions.text import normalize_consulting


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: Column | str) -> Column:
    """Label of the first pattern that matches, in any case."""
    out = None
    for pattern, label in rules:
        hit = text.rlike(f"(?iu){pattern}")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    default = F.lit(default) if isinstance(default, str) else default
    return default if out is None else out.otherwise(default)


def seniority(title: Column) -> Column:
    return first_match(F.coalesce(title, F.lit("")), C.SENIORITY_RULES, "Unknown")


def salary_seniority(salary: Column) -> Column:
    """A coarse level from a salary; below 1000 it is in thousands. Null without a positive one."""
    s = F.when(salary < 1000, salary * 1000).otherwise(salary)
    out = F.when(salary.isNull() | (salary <= 0), F.lit(None).cast("string"))
    for least, level in C.SALARY_BANDS:
        out = out.when(s >= least, level)
    return out.otherwise("Intern")


def merged_seniority(by_title: Column, by_model: Column, salary: Column) -> Column:
    """Model over title unless it is unknown; salary where both are."""
    best = F.coalesce(F.when(by_model.isin(*[s for s in C.SENIORITIES if s != "Unknown"]), by_model), F.nullif(by_title, F.lit("Unknown")))
    return F.coalesce(best, salary_seniority(salary), F.lit("Unknown"))


def category(title: Column, company: Column, description: Column) -> Column:
    text = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.substring(F.coalesce(description, F.lit("")), 1, 500))
    fallback = F.when(normalize_consulting(company).isin(*C.CONSULTING_COMPANIES), "Consulting").otherwise("General PA")
    return first_match(text, C.CATEGORY_RULES, fallback)


def multi_label(text: Column, patterns: Sequence[tuple[str, str]] = C.TOOL_PATTERNS) -> Column:
    """All labels whose pattern occurs, in the order of the patterns."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), name) for name, p in patterns]))


def best_confidence(text: Column, patterns: Sequence[tuple[str, str, float]] = C.ARRANGEMENT_PATTERNS,
                    order: dict[str, int] = C.RESTRICTIVENESS, scope: int = 2000) -> Column:
    """struct<value, confidence> of the surest pattern in the first characters; ties to the lower order."""
    head = F.substring(text, 1, scope)
    hits = F.array_compact(F.array(*[
        F.when(head.rlike(f"(?iu){p}"), F.struct(F.lit(-float(conf)).alias("c"), F.lit(order.get(v, 3)).alias("o"), F.lit(v).alias("v")))
        for p, v, conf in patterns
    ]))
    best = F.array_min(hits)
    return F.struct(best["v"].alias("value"), F.coalesce(-best["c"], F.lit(0.0)).alias("confidence"))


def publish_decision(kind: Column, confidence: Column) -> Column:
    return (
        F.when(kind.isin("RELEVANT", "PARTIALLY_RELEVANT") & (confidence >= 70), "publish")
        .when((kind == "PARTIALLY_RELEVANT") & (confidence >= 40), "publish_flag").otherwise("reject")
    )


def keyword_fallback(score: Column) -> Column:
    """struct<kind, confidence> where no classifier answers."""
    return (
        F.when(score >= 50, F.struct(F.lit("RELEVANT").alias("kind"), F.lit(70).alias("confidence")))
        .when(score >= 25, F.struct(F.lit("PARTIALLY_RELEVANT").alias("kind"), F.lit(50).alias("confidence")))
        .otherwise(F.struct(F.lit("NOT_RELEVANT").alias("kind"), F.lit(50).alias("confidence")))
    )
