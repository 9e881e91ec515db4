"""Queries against their SQL on small tables of odd rows."""

import datetime

import duckdb
from pyspark.sql import functions as F

from gleaner.plans import catalogue

ORDER = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


def orders(keys_and_prices):
    return [(k, 1, "O", float(price), datetime.datetime(2001, 7, 1), "1-URGENT") for k, price in keys_and_prices]


def equals_sql(name, spark, folder, table, df):
    path = f"{folder}/{table}.parquet"
    df.write.mode("overwrite").parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/*.parquet'")
    out = con.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in out.description]
    want = sorted(map(repr, out.fetchall()))
    got = sorted(repr(tuple(r[c] for c in names)) for r in catalogue.queries()[name](spark, str(folder)).collect())
    assert got == want and want


def test_halves_of_prices_are_rounded_as_casts_do(spark, tmp_path):
    rows = orders((i, price) for i, price in enumerate([24.5, 25.5, 49.5, 50.5, 124.5, 149.5, 24.49, 49.51, 1e6 + 0.5]))
    equals_sql("routing", spark, tmp_path, "orders", spark.createDataFrame(rows, ORDER))


def test_what_follows_a_json_value_makes_it_none(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "<p></p>") for i in (468, 832, 1560, 364, 13, 26, 20, 2184)], "page_id long, url string, html string")
    equals_sql("jsonld_extract", spark, tmp_path, "pages", pages)


def test_whole_json_is_one_value(spark):
    from gleaner.functions.text import whole_json

    good = ['{"a":1}', "[1, 2]", " 3 ", '"x"', "null", "[]", "{}"]
    bad = ['{"a":1}}', "[1]]", "1 2", "1, 2", '1, "k": 2', "1] [2", '1}, {"v": 2', "", "] [1", "[1", '{"a":1} x', "1,", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "x string")
    got = {r.x: r.v for r in df.select("x", whole_json(F.col("x")).isNotNull().alias("v")).collect()}
    assert [x for x in good if not got[x]] == [] and [x for x in bad if got[x]] == []


def test_an_answer_with_more_after_it_is_none(spark):
    from gleaner.operators.classifier import parsed

    answer = '{"classification":"relevant","confidence":80}'
    df = spark.createDataFrame([(answer,), (f"```json\n{answer}\n```",), (answer + "}",), (answer + " that is all",)], "raw string")
    assert [r[0] for r in df.select(parsed(F.col("raw"))["confidence"]).collect()] == [80, 80, None, None]


def test_salaries_are_looked_for_once(spark, tmp_path):
    from gleaner.config import SALARY_PATTERNS

    rows = orders((i, i) for i in range(430))
    equals_sql("enrichment_fill", spark, tmp_path, "orders", spark.createDataFrame(rows, ORDER))
    plan = catalogue.queries()["enrichment_fill"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("regexp_extract") <= 2 * 2 * len(SALARY_PATTERNS)  # two amounts of hint and description


def test_long_texts_that_compress_well_are_joined_in_many_tasks(spark, tmp_path, monkeypatch):
    from gleaner.operators import publish

    monkeypatch.setattr(publish, "TASK_CHARS", 50_000, raising=False)
    equals_sql("receiver_upsert", spark, tmp_path, "orders", spark.createDataFrame(orders((i, i) for i in range(120)), ORDER))
    assert catalogue.queries()["receiver_upsert"](spark, str(tmp_path)).rdd.getNumPartitions() >= 9  # of 450,000 characters and more


def test_workers_read_long_texts_in_small_batches(spark):
    import pandas as pd

    from gleaner.operators import scoring
    from gleaner.plans.composite import SPANS

    @F.pandas_udf("long")
    def together(texts: pd.Series) -> pd.Series:
        return pd.Series([len(texts)] * len(texts))

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    text = F.concat(F.repeat(F.lit("word "), 20_000), F.col("id").cast("string"))
    docs = spark.range(0, 200, 1, 1).select(F.lit("the").alias("title"), text.alias("description"), F.lit("c").alias("company"), F.lit("x").alias("source_name"))
    scored = scoring.score_records(docs, SPANS)
    assert scored.select(F.max(together("description"))).first()[0] < 100
    assert {r.keyword_score for r in scored.collect()} == {7}
