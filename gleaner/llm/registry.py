"""Queries of this subpackage and their SQL, for the entry module to add."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from gleaner.llm.op10_licenses import op10_licenses
from gleaner.llm.op11_decontaminate import SQL as OP11_SQL
from gleaner.llm.op11_decontaminate import op11_decontaminate
from gleaner.llm.op12_spelling import SQL as OP12_SQL
from gleaner.llm.op12_spelling import op12_spelling
from gleaner.llm.op13_lexical import SQL as OP13_SQL
from gleaner.llm.op13_lexical import op13_lexical
from gleaner.llm.op1_secrets import op1_secrets
from gleaner.llm.op2_mixing import op2_mixing
from gleaner.llm.op3_embeddings import op3_embeddings
from gleaner.llm.op4_packing import op4_packing
from gleaner.llm.op5_quality import op5_quality
from gleaner.llm.op6_topk import SQL as OP6_SQL
from gleaner.llm.op6_topk import op6_topk
from gleaner.llm.op7_minhash import op7_minhash
from gleaner.llm.op8_toxicity import op8_toxicity
from gleaner.llm.op9_pii import op9_pii


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secrets": op1_secrets,
        "op2_mixing": op2_mixing,
        "op3_embeddings": op3_embeddings,
        "op4_packing": op4_packing,
        "op5_quality": op5_quality,
        "op6_topk": op6_topk,
        "op7_minhash": op7_minhash,
        "op8_toxicity": op8_toxicity,
        "op9_pii": op9_pii,
        "op10_licenses": op10_licenses,
        "op11_decontaminate": op11_decontaminate,
        "op12_spelling": op12_spelling,
        "op13_lexical": op13_lexical,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_topk": OP6_SQL,
        "op11_decontaminate": OP11_SQL,
        "op12_spelling": OP12_SQL,
        "op13_lexical": OP13_SQL,
    }
