import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from stratalake.plans.layers import LayerPaths, build_bronze, run_layers
from stratalake.sources import catalog, files, schemas
from stratalake.streaming import ingest
from tests.conftest import rows

BRONZE = [
    {"caseNumber": "TR24-0417", "hearingDate": "02/06/2024, 01:45 PM", "name": "Ola Brandt"},
    {"caseNumber": "TR24-0552", "hearingDate": "03/19/2024, 08:30 AM", "name": None},
    {"caseNumber": "GV23-9001", "name": "Ilse Moran"},
]


def lines(records):
    return [json.dumps(r) for r in records]


def test_bronze_writes_every_row(spark, write_lines, tmp_path):
    root = write_lines({"in/2024/01/15.json": lines(BRONZE)})
    out = build_bronze(spark, f"{root}/in/*/*/*.json", f"{root}/bronze")
    assert out.count() == 3
    assert {"caseNumber", "hearingDate", "name", "filename", "source_file"} == set(out.columns)


def test_bronze_without_input_writes_nothing(spark, tmp_path):
    assert build_bronze(spark, f"{tmp_path}/none/*.json", f"{tmp_path}/bronze") is None
    assert not (tmp_path / "bronze").exists()


def test_scan_unions_keys_and_keeps_digit_text(spark, write_lines):
    root = write_lines({"a.json": ['{"caseNumber":"2100000100"}'], "b.json": ['{"caseNumber":"1","extra":5}']})
    found = files.scan_jsonl(spark, f"{root}/*.json")
    assert sorted(rows(found.select("caseNumber", "extra"))) == [("1", 5), ("2100000100", None)]
    assert found.filter("filename = source_file").count() == 2


def test_inference_survives_repeated_keys_and_nulls(spark, write_lines):
    root = write_lines({"a.json": ['{"k":1,"k":2,"n":null,"s":{"t":"x"}}', '{"a":[{"b":1}]}', "{bad"]})
    schema = schemas.infer_jsonl_schema(spark.read.text(f"{root}/a.json"))
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "a": "array<struct<b:bigint>>",
        "k": "bigint",
        "n": "string",
        "s": "struct<t:string>",
    }


def test_tolerant_scan_splits_good_and_bad(spark, write_lines):
    root = write_lines(
        {"a.json": ['{"caseNumber":"CR001","k":1,"k":2}', "", "   ", "{bad", '{"caseNumber":"CR3","k":"x"}', "[1]"]}
    )
    good, bad = files.scan_jsonl_tolerant(spark, f"{root}/a.json", "caseNumber string, k bigint")
    assert sorted(rows(good.select("caseNumber", "k"))) == [("CR001", 2), ("CR3", None)]
    assert sorted(r[1] for r in rows(bad)) == ["[1]", "{bad"]


def test_json_schema_becomes_a_struct():
    kind = schemas.struct_from_json_schema(
        {
            "type": "array",
            "items": {
                "type": "object",
                "properties": {
                    "a": {"type": ["null", "string"]},
                    "n": {"type": "integer"},
                    "d": {"anyOf": [{"type": "null"}, {"type": "object", "properties": {"x": {"type": "number"}}}]},
                    "l": {"type": "array", "items": {"type": "object", "properties": {"b": {"type": "boolean"}}}},
                },
            },
        }
    )
    assert kind == T.StructType(
        [
            T.StructField("a", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("d", T.StructType([T.StructField("x", T.DoubleType())])),
            T.StructField("l", T.ArrayType(T.StructType([T.StructField("b", T.BooleanType())]))),
        ]
    )


def test_write_by_date_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "dated")
    first = spark.createDataFrame([(1, dt.date(2024, 5, 1)), (2, dt.date(2024, 5, 2))], "id int, d date")
    files.write_by_date(first, path, "d")
    files.write_by_date(spark.createDataFrame([(3, dt.date(2024, 5, 2))], "id int, d date"), path, "d")
    assert sorted(rows(spark.read.parquet(path).select("id", "year", "month", "day"))) == [
        (1, 2024, 5, 1),
        (3, 2024, 5, 2),
    ]


def test_append_keeps_the_last_partial_chunk(spark, tmp_path):
    path = str(tmp_path / "append")
    files.append_records(spark.range(250), path, chunk=files.CHUNK)
    files.append_records(spark.range(5), path)
    assert spark.read.schema("id bigint").json(path).count() == 255


def test_compaction_keeps_batch_and_line_order(spark, write_lines):
    root = write_lines(
        {
            "2024-05-01_batch_2.jsonl": ["c1", "c2"],
            "2024-05-01_batch_10.jsonl": ["b1", "b2"],  # names are ordered as text
            "2024-05-01_batch_0.jsonl": ["a1", "a2", "a3"],
            "2024-05-02_batch_0.jsonl": ["z"],
        }
    )
    files.compact_by_date(spark, f"{root}/*_batch_*.jsonl", f"{root}/out", drop_parts=True)
    day = sorted((p for p in __import__("pathlib").Path(root, "out/date=2024-05-01").glob("part-*")), key=lambda p: p.name)
    assert "".join(p.read_text() for p in day).split() == ["a1", "a2", "a3", "b1", "b2", "c1", "c2"]
    assert not files.has_input(spark, f"{root}/*_batch_*.jsonl")


def test_compaction_of_another_date_keeps_the_first(spark, write_lines):
    root = write_lines({"in/2024-07-01_batch_0.jsonl": ["p", "q"]})
    files.compact_by_date(spark, f"{root}/in/*", f"{root}/out", drop_parts=True)
    write_lines({"in/2024-07-02_batch_0.jsonl": ["r"]})
    files.compact_by_date(spark, f"{root}/in/*", f"{root}/out", drop_parts=True)
    kept = {r["value"] for r in spark.read.text(f"{root}/out").collect()}
    assert kept == {"p", "q", "r"}
    write_lines({"in/undated.jsonl": ["s"]})
    with pytest.raises(ValueError):
        files.compact_by_date(spark, f"{root}/in/*", f"{root}/out", drop_parts=True)
    assert files.has_input(spark, f"{root}/in/undated.jsonl")


def test_dimension_scans_keep_leading_zeros(spark, write_lines):
    root = write_lines(
        {
            "courts.json": ['[{"fipsCode4":"001C","fipsCode":"001"},', '{"fipsCode4":"003G","fipsCode":"003"}]'],
            "urls.csv": ["fipsCode4,url", "001C,u1", "999Z,u9"],
        }
    )
    courts = files.scan_dim_json(spark, f"{root}/courts.json", "fipsCode4 string, fipsCode string")
    assert rows(courts.orderBy("fipsCode4")) == [("001C", "001"), ("003G", "003")]
    assert rows(files.scan_dim_csv(spark, f"{root}/urls.csv").orderBy("url")) == [("001C", "u1"), ("999Z", "u9")]


def test_catalog(spark, tmp_path):
    frame = spark.range(50).select("id", F.lit("x").alias("s"))
    catalog.register(frame, "some_view")
    assert ("some_view", True) in rows(catalog.list_tables(spark))
    assert rows(catalog.describe(spark, "some_view")) == [("id", "bigint"), ("s", "string")]
    assert catalog.preview(spark, "some_view", 3).count() == 3
    result, n = catalog.run_sql(spark, "SELECT id FROM some_view WHERE id < 7")
    assert n == 7 and result.columns == ["id"]


CASE = {
    "qualifiedFips": "117D", "courtLevel": "D", "divisionType": "T", "caseNumber": "TR24-0417",
    "formattedCaseNumber": "TR-24-417", "name": "Ola Brandt", "offenseDate": "11/28/2023", "chargeAmended": "Y",
    "codeSection": "46.2-301", "chargeDesc": "Driving suspended", "caseType": "M",
    "hearingDate": "02/06/2024, 01:45 PM", "locality": {"localityName": "Norwick"},
    "caseParticipant": [
        {"participantCode": "PLT", "personalDetails": {"race": "A", "gender": None}},
        {"contactInformation": {"personName": {"fullName": "Mira Kessel"}}, "participantCode": "DEF"},
    ],
    "financialInformation": None, "caseHearing": None, "disposition": None,
}
REQUIRED_NAME = {"type": "object", "properties": {"caseNumber": {"type": "string"}}, "required": ["caseNumber"]}


def test_layers_from_raw_to_gold(spark, write_lines):
    root = write_lines(
        {
            "raw/2024/01/15.jsonl": lines([CASE]),
            "raw/2024/01/16.jsonl": lines([{**CASE, "name": "Later"}, {**CASE, "caseNumber": "TR24-0552"}]),
            "schema.json": [json.dumps({"type": "array", "items": REQUIRED_NAME})],
        }
    )
    paths = LayerPaths(f"{root}/raw/*/*/*.jsonl", f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/schema.json")
    built = run_layers(spark, paths, schemas.CASE_SCHEMA)
    assert built["bronze"].count() == 3 and built["silver"].count() == 2
    assert rows(built["hearings_per_case_distribution"]) == [(1, 2)]
    assert len(built) == 8 and spark.table("monthly_locality_summary").count() == 1


def test_layers_stop_on_invalid_records_and_missing_schema(spark, write_lines):
    root = write_lines({"raw/1.jsonl": ['{"x":1}'], "schema.json": [json.dumps(REQUIRED_NAME)]})
    paths = LayerPaths(f"{root}/raw/*.jsonl", f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/schema.json")
    with pytest.raises(ValueError):
        run_layers(spark, paths)
    paths.schema_json = f"{root}/missing.json"
    with pytest.raises(FileNotFoundError):
        run_layers(spark, paths)
    paths.schema_json, paths.raw_glob = None, f"{root}/nothing/*.jsonl"
    with pytest.raises(FileNotFoundError):
        run_layers(spark, paths)


def test_layers_keep_the_whole_record(spark, write_lines):
    more = {"appealCase": {"appealDate": "02/01/2024"}, "financialInformation": {"fines": {"paidDate": {"date": 1}, "amount": {"decimal": 5}}}}
    document = {"type": "object", "properties": {"probation": {"type": "object", "properties": {"years": {"type": "integer"}}}, "free": {"type": "object"}}}
    root = write_lines({"raw/1.jsonl": lines([{**CASE, **more, "free": {"x": 1}, "serviceInfo": [{"way": "mail"}]}]), "schema.json": [json.dumps(document)]})
    paths = LayerPaths(f"{root}/raw/*.jsonl", f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/schema.json")
    built = run_layers(spark, paths)
    row = built["bronze"].first().asDict(True)
    assert row["appealCase"] == {"appealDate": "02/01/2024"} and row["serviceInfo"] == [{"way": "mail"}] and row["free"] == {"x": 1}
    assert "probation" in row and row["disposition"] is None
    assert built["silver"].first().financialInformation.fines.paidDate.date == 1


def test_feature_load_keeps_the_whole_record(spark, write_lines):
    from stratalake.plans.analysis import load_case_features

    root = write_lines({"a.jsonl": lines([{**CASE, "restitution": {"amount": 2.5}}])})
    row = load_case_features(spark, f"{root}/a.jsonl").first()
    assert float(row.restitution.amount) == 2.5 and row.netSentenceDays == 0


def test_merged_types_hold_both():
    merged = schemas.merge_types(files.as_struct("a bigint, s struct<x: string>, l array<struct<k: bigint>>, t string"), files.as_struct("a double, s struct<y: bigint>, l array<struct<k: string>>, t struct<z: string>, b boolean"))
    assert merged == files.as_struct("a double, s struct<x: string, y: bigint>, l array<struct<k: string>>, t struct<z: string>, b boolean")


def test_bad_lines_are_no_bronze_rows_but_stored(spark, write_lines):
    root = write_lines({"raw/1.jsonl": [*lines([CASE]), "{bad", "[1]", "", '{"cut":']})
    paths = LayerPaths(f"{root}/raw/*.jsonl", f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    built = run_layers(spark, paths)
    assert built["bronze"].count() == 1 and built["silver"].count() == 1
    bad = files.scan_parquet(spark, files.bad_lines_path(paths.bronze))
    assert sorted(r[0] for r in rows(bad.select(files.CORRUPT))) == ["[1]", '{"cut":', "{bad"]
    assert files.scan_jsonl(spark, paths.raw_glob, "caseNumber string").count() == 1


def test_stream_sets_bad_lines_aside(spark, write_lines):
    from stratalake.streaming import ingest

    root = write_lines({"in/a.jsonl": ['{"caseNumber":"1","hearingDate":"01/15/2024, 09:00 AM"}', "{bad"]})
    schema = files.as_struct("caseNumber string, hearingDate string")
    ingest.ingest_stream(spark, f"{root}/in", f"{root}/bronze", schema, f"{root}/checkpoint").awaitTermination()
    assert rows(ingest.read_bronze(spark, f"{root}/bronze", schema).select("caseNumber")) == [("1",)]
    assert [r[1] for r in rows(ingest.read_bad_lines(spark, f"{root}/bronze"))] == ["{bad"]


def test_ingest_by_date_parses_text_and_sets_bad_lines_aside(spark, write_lines):
    from stratalake.plans.layers import ingest_by_date

    day = {"date": "01/15/2024, 09:00 AM"}
    made = [
        {**day, "caseNumber": "1", "locality": '{"localityName":"Norwick","localityCode":"7"}', "tags": "['a', None]"},
        {**day, "caseNumber": "2", "locality": "{'localityName': None}", "tags": '"quoted"'},
        {**day, "caseNumber": "3", "locality": "plain", "tags": "{no"},
    ]
    root = write_lines({"in.jsonl": [*lines(made), "{bad"]})
    out = ingest_by_date(spark, f"{root}/in.jsonl", f"{root}/out")
    found = rows(out.orderBy("case_number").select("case_number", "locality_name", "locality_code", "locality", "tags", "day"))
    assert [r[:5] for r in found] == [("1", "Norwick", 7, None, '["a",null]'), ("2", None, None, None, "quoted"), ("3", None, None, "plain", "{no")]
    assert files.scan_parquet(spark, files.bad_lines_path(f"{root}/out")).count() == 1


def test_inferred_types(spark):
    lines = [('{"VOID": null, "fine": 1.5, "n": 3, "mixed": 1, "OBJECT": {"a<b": [2.25, 1]}}',), ('{"VOID": null, "mixed": {"x": 1}, "n": 4}',)]
    kind = schemas.infer_jsonl_schema(spark.createDataFrame(lines, "value string"))
    wanted = {"VOID": "string", "fine": "double", "n": "bigint", "mixed": "string", "OBJECT": "struct<a<b:array<double>>"}
    assert {f.name: f.dataType.simpleString() for f in kind} == wanted


def test_stream_lists_only_the_days_it_touches(spark, write_lines, tmp_path):
    line = '{{"caseNumber": "{}", "hearingDate": "{}"}}'
    root = write_lines({"in/a.json": [line.format(1, "01/05/2024, 09:00 AM"), line.format(2, "01/06/2024, 09:00 AM"), '{"caseNumber": "3"}']})
    args = (f"{root}/in", f"{root}/bronze", schemas.CASE_SCHEMA, f"{root}/checkpoint", f"{root}/silver")
    ingest.ingest_stream(spark, *args).awaitTermination()
    (tmp_path / "in/b.json").write_text(line.format(4, "01/05/2024, 10:00 AM") + "\n")
    ingest.ingest_stream(spark, *args).awaitTermination()
    found = sorted((r.hearing_day or "", r.batch_id) for r in ingest.read_manifest(spark, f"{root}/bronze").collect())
    assert found == [("", 0), ("2024-01-05", 0), ("2024-01-05", 1), ("2024-01-06", 0)]
    day = ingest.read_days(spark, f"{root}/bronze", T.StructType.fromDDL(schemas.CASE_SCHEMA), ["2024-01-05", None])
    assert all("2024-01-06" not in name for name in day.inputFiles())
    assert sorted(r.caseNumber for r in day.collect()) == ["1", "3", "4"]
    silver = spark.read.parquet(f"{root}/silver").groupBy(F.col("hearing_day").cast("string")).count().collect()
    assert sorted((r[0] or "", r[1]) for r in silver) == [("", 1), ("2024-01-05", 2), ("2024-01-06", 1)]
