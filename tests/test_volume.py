"""What queries move and store: plans and files that must stay narrow."""

import os

import pytest

import __spark_entry__ as entry
from entry_queries.frames import joined
from stratalake.session import shared_dir
from tests.conftest import SF_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, label", [("s15_layer_run", "run"), ("s4_feature_load", "features")])
def test_raw_records_are_stored_compressed(spark, name, label):
    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    assert entry.queries()[name](spark, SF_DIR).count() > 0
    (folder,) = [f for f in set(os.listdir(root)) - before if f.startswith(f"stratalake-{label}-")]
    raw = [f for _, _, files in os.walk(f"{root}/{folder}") for f in files if f.startswith("part-") and ".json" in f]
    assert raw and all(f.endswith(".json.gz") for f in raw)


@pytest.mark.parametrize("name", ["p15_hash_in_array", "p17_silver_layer"])
def test_records_of_a_case_are_not_shuffled_again(spark, name):
    above, found, _ = plan(entry.queries()[name](spark, SF_DIR)).partition("Join ")
    assert found and "Exchange" not in above


def test_line_items_are_shuffled_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        above, found, _ = plan(joined(spark, SF_DIR)).partition("/lineitem.parquet")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found and above.count("Exchange hashpartitioning") == 1
