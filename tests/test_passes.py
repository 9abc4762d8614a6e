"""How often raw lines are parsed: once in every pass, and in as few passes as the job needs."""

import json

import pytest

from stratalake.plans import layers
from stratalake.sources import files
from tests.conftest import rows

LINES = [json.dumps({"caseNumber": str(i), "n": {"k": i}, "n2": i / 2}) for i in range(4)]
SCHEMA = "caseNumber string, n struct<k: bigint>"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_line_is_parsed_once_in_a_scan(spark, write_lines):
    root = write_lines({"a.json": [*LINES, "", "{bad", "[1]", "null", "5", '{"caseNumber":"9","n":7}']})
    good, bad = files.scan_jsonl_tolerant(spark, f"{root}/a.json", SCHEMA)
    assert plan(good).count("from_json(") == 1 and plan(bad).count("from_json(") == 1
    assert sorted(rows(good.select("caseNumber", "n.k"))) == [("0", 0), ("1", 1), ("2", 2), ("3", 3), ("9", None)]
    assert sorted(rows(bad.select(files.CORRUPT))) == [("5",), ("[1]",), ("null",), ("{bad",)]


@pytest.mark.parametrize("extra", [[], ["{bad", "[1]", "  "]])
def test_bronze_reads_again_only_where_lines_are_bad(spark, write_lines, monkeypatch, extra):
    stored = []

    def store(bad, layer):
        stored.append(plan(bad))
        return files.store_bad_lines(bad, layer)

    monkeypatch.setattr(layers, "store_bad_lines", store)
    root = write_lines({"raw/1.json": LINES[:2], "raw/2.json": [*LINES[2:], *extra]})
    out = layers.build_bronze(spark, f"{root}/raw/*.json", f"{root}/bronze", SCHEMA)
    assert sorted(rows(out.select("caseNumber"))) == [("0",), ("1",), ("2",), ("3",)]
    bad = files.scan_parquet(spark, files.bad_lines_path(f"{root}/bronze"))
    assert bad.columns == [files.SOURCE_FILE, files.CORRUPT]
    assert sorted(rows(bad.select(files.CORRUPT))) == [(line,) for line in sorted(extra) if line.strip()]
    assert [("from_json(" in text) for text in stored] == [bool(extra)]


def test_bad_lines_of_an_earlier_build_go(spark, write_lines, tmp_path):
    root = write_lines({"raw/1.json": [*LINES, "{bad"]})
    args = (spark, f"{root}/raw/*.json", f"{root}/bronze", SCHEMA)
    layers.build_bronze(*args)
    write_lines({"raw/1.json": LINES})
    layers.build_bronze(*args)
    assert files.scan_parquet(spark, files.bad_lines_path(f"{root}/bronze")).count() == 0
