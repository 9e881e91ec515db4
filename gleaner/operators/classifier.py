"""External classifier answers: parsing, validation, provider order and fallback.

Answers are data, (external_id, provider, raw) rows; how they are fetched is an adapter's
matter. The first provider with a valid answer wins, else the keyword score decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import config as C
from gleaner.functions.rules import keyword_fallback
from gleaner.functions.stats import clamp
from gleaner.functions.text import whole_json

KINDS = ("RELEVANT", "PARTIALLY_RELEVANT", "NOT_RELEVANT")
PROVIDERS = ("groq", "gemini", "openai")
SNIPPET_PENALTY = 10


def parsed(raw: Column) -> Column:
    """struct<kind, confidence, reasoning, seniority, remote, salary_hint>, or null if it is no valid answer.

    Code fences are dropped. The class must be a known one and the confidence a number, which
    is clamped to 0..100; the hints are each checked on their own.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(raw), r"^```[A-Za-z]*\s*", ""), r"\s*```$", "")
    v = whole_json(bare)
    get = lambda path: F.try_variant_get(v, path, "string")
    kind = F.upper(F.trim(F.coalesce(get("$.classification"), F.lit(""))))
    confidence = F.try_variant_get(v, "$.confidence", "double").cast("int")
    among = lambda c, allowed: F.when(c.isin(*allowed), c)
    return F.when(kind.isin(*KINDS) & confidence.isNotNull(), F.struct(
        kind.alias("kind"), clamp(confidence).alias("confidence"), get("$.reasoning").alias("reasoning"),
        among(get("$.seniority"), C.SENIORITIES).alias("seniority"), among(F.lower(get("$.remote")), ("remote", "hybrid", "onsite")).alias("remote"),
        get("$.salary_hint").alias("salary_hint"),
    ))


def classified(df: DataFrame, answers: DataFrame | None = None, key: str = "external_id") -> DataFrame:
    """df(keyword_score, description_is_snippet) with llm_classification, llm_confidence, llm_provider and hints."""
    if answers is None:
        df = df.withColumn("_a", F.lit(None).cast("struct<kind:string,confidence:int,reasoning:string,seniority:string,remote:string,salary_hint:string>")).withColumn(
            "_p", F.lit(None).cast("string"))
    else:
        place = F.array_position(F.array(*[F.lit(p) for p in PROVIDERS]), F.col("provider"))
        valid = answers.withColumn("_a", parsed(F.col("raw"))).where(F.col("_a").isNotNull() & (place > 0))
        first = valid.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(place))).where("_rn = 1").select(key, "_a", F.col("provider").alias("_p"))
        df = df.join(first, key, "left")
    fallback = keyword_fallback(F.col("keyword_score"))
    less = F.when(F.coalesce("description_is_snippet", F.lit(False)), SNIPPET_PENALTY).otherwise(0)
    answered = F.col("_a").isNotNull()
    return df.withColumns({
        "llm_classification": F.when(answered, F.col("_a.kind")).otherwise(fallback["kind"]),
        "llm_confidence": F.when(answered, F.greatest(F.lit(0), F.col("_a.confidence") - less)).otherwise(fallback["confidence"]),
        "llm_provider": F.coalesce("_p", F.lit("keyword_only")), "llm_reasoning": F.col("_a.reasoning"),
        "llm_seniority": F.col("_a.seniority"), "llm_remote": F.col("_a.remote"), "llm_salary_hint": F.col("_a.salary_hint"),
    }).drop("_a", "_p")
