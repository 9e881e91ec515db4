"""A training corpus from raw documents: clean, deduplicate, mask, mix and pack.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a
DataFrame, which is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import op1_secrets, op2_mixing, op4_packing, op5_quality, op7_minhash
from gleaner.llm.common import shared_dir

STAGES = [
    ("quality classifier", op5_quality.stage),
    ("near duplicates", op7_minhash.stage),
    ("secret scan", op1_secrets.stage),
    ("source mix", op2_mixing.stage),
    ("packing", op4_packing.stage),
]

#: A trained classifier, MinHash, tokenizer ids and sampling have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
