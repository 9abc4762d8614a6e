import json

import pytest
from pyspark.sql import functions as F

from stratalake.operators import validate
from tests.conftest import rows

SCHEMA = {
    "type": "object",
    "properties": {
        "id": {"type": "string"},
        "n": {"type": "integer"},
        "d": {
            "anyOf": [
                {"type": "null"},
                {"type": "object", "properties": {"t": {"type": "string"}}, "required": ["t"]},
            ]
        },
        "a": {"type": "array", "items": {"type": "object", "required": ["k"]}},
    },
    "required": ["id", "a"],
}
LINES = {
    '{"id":"1","n":1,"d":null,"a":[]}': None,
    '{"id":"2","n":1.0,"a":[{"k":"x"}]}': None,
    '{"n":1,"a":[]}': "required id",
    '{"id":4,"a":[]}': "type of id",
    '{"id":null,"a":[]}': "type of id",
    '{"id":"6","d":{},"a":[]}': "required d.t",
    '{"id":"7","a":[{"k":"x"},{}]}': "required a[].k",
    '{"id":"8","a":{}}': "type of a",
    '{"id":"9","a":[],"n":1,"n":2}': None,
    "   ": "skipped",
    "{bad": "decode",
}


def check(spark, schema, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    return {r.value: r.error for r in validate.validate_json(df, "value", schema).collect()}


def test_each_line(spark):
    found = check(spark, SCHEMA, LINES)
    assert found == {line: error for line, error in LINES.items() if error != "skipped"}
    assert sum(e is None for e in found.values()) == 3 and len(found) == 10


def test_all_errors_are_kept(spark):
    df = spark.createDataFrame([('{"n":"x","d":5,"a":[{},{}]}',)], "value string")
    errors = validate.validate_json(df, "value", SCHEMA).first().errors
    assert sorted(errors) == ["required a[].k", "required a[].k", "required id", "type of d", "type of n"]


@pytest.mark.parametrize(
    "schema, value, ok",
    [
        ({"type": "integer"}, "1e3", True),
        ({"type": "integer"}, "1.5", False),
        ({"type": "integer"}, "12345678901234567890", True),
        ({"type": "number"}, "1.5", True),
        ({"type": "number"}, '"1"', False),
        ({"type": "boolean"}, "true", True),
        ({"type": ["null", "string"]}, "null", True),
        ({"type": ["null", "string"]}, "[]", False),
        ({"type": ["array", "object"]}, "{}", True),
        ({"type": "object"}, "[]", False),
        ({"anyOf": [{"type": "string"}, {"type": "integer"}]}, "7", True),
        ({"anyOf": [{"type": "string"}, {"type": "integer"}]}, "[7]", False),
        ({"anyOf": [{"type": "null"}, {"type": "array", "items": {"type": "string"}}]}, '["a",1]', False),
        ({"anyOf": [{"type": "null"}, {"type": "array", "items": {"type": "string"}}]}, "null", True),
    ],
)
def test_types(spark, schema, value, ok):
    record = {"type": "object", "properties": {"v": schema}}
    found = check(spark, record, [f'{{"v":{value}}}'])
    assert (list(found.values())[0] is None) == ok


def test_records_that_are_no_objects(spark):
    assert set(check(spark, SCHEMA, ["[1]", "5", '"x"']).values()) == {"type of record"}


def test_unsupported_keywords_are_refused():
    with pytest.raises(ValueError):
        validate.compile_errors(F.col("v"), {"type": "string", "pattern": "x"})


def test_sampling_takes_first_files_and_lines(spark, write_lines):
    root = write_lines({f"f {i}[x].jsonl": [f'{{"i":{i},"l":{j}}}' for j in range(1, 8)] for i in range(4)})
    found = validate.sample_files(spark, f"{root}/*.jsonl", n_files=2, n_lines=3)
    got = sorted(rows(found.select("line", "value")))
    assert got == sorted((j, f'{{"i":{i},"l":{j}}}') for i in range(2) for j in range(1, 4))
    assert validate.sample_files(spark, f"{root}/*.jsonl", 0, 0).count() == 28


def sequential_errors(files, limit=10):
    """What a reader that goes file by file and line by line reports."""
    out, total = [], 0
    for name in sorted(files):
        for number, kind in enumerate(files[name], start=1):
            if kind == "ok":
                continue
            total += 1
            out.append((name, number))
            if kind == "decode" or total > limit:
                break
    return sorted(out)


@pytest.mark.parametrize("limit", [0, 2, 5, 10, 100])
def test_reported_errors_follow_the_sequential_reader(spark, limit):
    kinds = {
        "a": ["ok", "bad", "bad", "ok", "bad", "decode", "bad"],
        "b": ["bad"] * 6,
        "c": ["ok", "ok"],
        "d": ["bad", "bad", "decode"],
        "e": ["ok", "decode", "bad"],
    }
    data = [
        (name, i, {"ok": None, "bad": "type of id", "decode": "decode"}[k])
        for name, ks in kinds.items()
        for i, k in enumerate(ks, start=1)
    ]
    checked = spark.createDataFrame(data, "source_file string, line bigint, error string")
    found = validate.reported_errors(checked, limit)
    assert sorted(rows(found.select("source_file", "line"))) == sequential_errors(kinds, limit)


def test_gate(spark):
    good = spark.createDataFrame([(None,)], "error string")
    validate.gate(good)
    with pytest.raises(validate.SchemaViolation):
        validate.gate(spark.createDataFrame([("decode",)], "error string"))


def test_files_without_input_only_warn(spark, write_lines):
    root = write_lines({"schema.json": [json.dumps(SCHEMA)]})
    assert validate.validate_files(spark, f"{root}/none/*.jsonl", f"{root}/schema.json") is None
