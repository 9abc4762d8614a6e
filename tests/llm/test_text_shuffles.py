"""Pipeline stages and line dedup do not move texts more often than they must."""

import corpus_pipeline as cp
from stratalake.llm import linedup
from tests.conftest import SF_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_near_stage_takes_rows_out_without_a_shuffle(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert "Exchange hashpartitioning" not in plan(cp.near_stage(spark, docs, SF_DIR))


def test_mix_stage_shuffles_only_rows_at_a_budgets_end(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert plan(cp.mix_stage(spark, docs, SF_DIR)).count("Exchange hashpartitioning") <= 1


def test_line_dedup_joins_each_text_once(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert " AS _text#" not in plan(linedup.line_dedup(docs))
