"""Types of raw lines: found with one parse a line, from JSON objects only."""

from stratalake.sources import schemas


def test_types_come_from_objects_only(spark):
    lines = [
        ' \t\r{"a": 1, "s": {"t": "x"}}', '{"a": 2.5, "l": [{"b": 1}]}', '{"a": 1} rest', "{bad", '{"cut": ', "[{\"no\": 1}]",
        '"{\\"no\\": 1}"', "5", "null", "", "   ", ' {"no": 1}', '\ufeff{"no": 1}', "x{\"no\": 1}", None,
    ]
    kind = schemas.infer_jsonl_schema(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {f.name: f.dataType.simpleString() for f in kind} == {"a": "double", "s": "struct<t:string>", "l": "array<struct<b:bigint>>"}


def test_no_object_gives_no_field(spark):
    for lines in ([], [("[1]",), ("{bad",)], [("{}",)]):
        assert len(schemas.infer_jsonl_schema(spark.createDataFrame(lines, "value string"))) == 0


def test_a_line_is_parsed_once_for_its_type(spark):
    lines = spark.createDataFrame([('{"a": 1}',)], "value string")
    text = schemas._merged_type(lines, "value")._jdf.queryExecution().executedPlan().toString()
    (kept,) = [line for line in text.splitlines() if "Filter " in line]
    assert "parseJson" not in kept and "schemaOfVariant(" not in text
