import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratalake.functions import cases, dates, hashing, jsontext, scalars
from stratalake.operators import normalize
from stratalake.plans import silver
from tests.conftest import rows

OLA = "bdc03ffd3f7457902835438a837a90c4ea6d18da79799c54ec4441b406e97c08"
MIRA = "1b89800b7bbe4e7808400fcad898ee18720abea616a70a4a6bd9447132afa308"
BRONZE = """
qualifiedFips string, courtLevel string, divisionType string, caseNumber string,
formattedCaseNumber string, name string, offenseDate string, chargeAmended string,
codeSection string, chargeDesc string, caseType string, hearingDate string,
locality struct<localityName: string>,
caseParticipant array<struct<contactInformation: struct<personName: struct<fullName: string>>,
  participantCode: string, personalDetails: struct<race: string, gender: string>>>,
financialInformation string, caseHearing string, disposition string, source_file string
"""


def bronze_row(name="Ola Brandt", people=(((("Mira Kessel",),), "PLT", ("A", "M")),), number="TR24-0417", source="a"):
    return (
        "117D", "D", "T", number, "TR-24-417", name, "11/28/2023", "N", "46.2-301", "Driving suspended", "M",
        "02/06/2024, 01:45 PM", ("Norwick",), list(people) if people is not None else None, None, None, None, source,
    )


def test_silver_keeps_one_hashed_typed_row(spark):
    bronze = spark.createDataFrame([bronze_row(), bronze_row("Zoe Brandt", ())], BRONZE)
    out = silver.to_silver(bronze, tiebreak=[F.col("name").asc()])
    assert len(out.columns) == 18
    (row,) = out.collect()
    assert row.defendant_name_hash == OLA
    assert row.offense_date == dt.date(2023, 11, 28)
    assert row.hearing_timestamp == dt.datetime(2024, 2, 6, 13, 45)
    assert dict(out.dtypes)["hearing_timestamp"] == "timestamp_ntz"
    assert row.locality_name == "Norwick" and row.anonymization_method == "hashed_sha256"
    (person,) = row.participants_anonymized
    assert tuple(person) == (MIRA, "PLT", "A", "M")


def test_later_source_wins_and_null_keys_are_equal(spark):
    bronze = spark.createDataFrame(
        [bronze_row("old", number=None, source="2024/01"), bronze_row("new", number=None, source="2024/02")], BRONZE
    )
    (row,) = silver.to_silver(bronze).collect()
    assert row.defendant_name_hash == hashing_of(spark, "new")


def hashing_of(spark, text):
    return spark.range(1).select(hashing.hash_text(F.lit(text))).first()[0]


def test_default_tiebreak_does_not_depend_on_row_order(spark):
    a, b = bronze_row("A"), bronze_row("B")
    picks = {
        silver.to_silver(spark.createDataFrame(order, BRONZE)).first().defendant_name_hash for order in ([a, b], [b, a])
    }
    assert len(picks) == 1


def test_hash_in_array_keeps_nulls(spark):
    df = spark.createDataFrame(
        [(1, None), (2, [None]), (3, [(None, "x")])], "id int, a array<struct<name: string, role: string>>"
    )
    out = {r.id: r.h for r in df.select("id", hashing.hash_in_array(F.col("a"), "name", {"role": "role"}, "hash").alias("h")).collect()}
    assert out[1] is None
    assert [tuple(x) for x in out[2]] == [(None, None)] and [tuple(x) for x in out[3]] == [(None, "x")]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("01/15/2024, 09:00 AM", dt.datetime(2024, 1, 15, 9)),
        ("1/5/2024, 1:30 pm", dt.datetime(2024, 1, 5, 13, 30)),
        ("12/31/2024, 12:00 AM", dt.datetime(2024, 12, 31)),
        ("02/30/2024, 09:00 AM", None),
        ("01/15/24, 09:00 AM", None),
        ("bad", None),
        (None, None),
    ],
)
def test_parse_ts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(dates.parse_ts(F.col("t"))).first()[0] == expected


def test_date_lists(spark):
    listed = lambda *a: [r[0] for r in dates.date_list(spark, *a).collect()]
    assert len(listed("2024-05-01", "2024-05-03")) == 3
    assert listed("2024-05-01", "2024-05-03", False) == [dt.date(2024, 5, 1), dt.date(2024, 5, 2)]
    assert listed("2024-05-03", "2024-05-01") == [] and listed("2024-05-01", "2024-05-01", False) == []


def test_day_names_and_indexes(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 14 + i),) for i in range(7)], "d date")
    got = rows(df.select(dates.day_index(F.col("d")), dates.day_name(F.col("d"))))
    assert got == list(enumerate(["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]))


# --- features ---------------------------------------------------------------------------------

PERSON = """array<struct<participantCode: string, personalDetails: struct<race: string, gender: string>,
  attorneyDetails: array<struct<attorneyBusinessName: struct<businessName: string>,
    judicialOfficialCategoryText: string>>>>"""


@pytest.mark.parametrize(
    "people, expected",
    [
        ([("DEF", (None, "M"), None), ("DEF", ("W", "F"), None)], ("W", "M", "Private/None")),
        ([("WIT", ("W", "F"), None)], (None, None, None)),
        ([("DEF", None, [(("Office of the Public Defender",), None)])], (None, None, "Public Defender")),
        ([("DEF", None, [(("Updike LLC",), None)])], (None, None, "Public Defender")),
        ([("DEF", None, [(None, "P")])], (None, None, "Public Defender")),
        ([("DEF", None, [(("Smith LLC",), "R"), (None, None)])], (None, None, "Private/None")),
        ([("DEF", None, [])], (None, None, "Private/None")),
        ([("DEF", None, None), ("DEF", None, [(None, "P")])], (None, None, "Private/None")),
        ([], (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_first_defendant(spark, people, expected):
    df = spark.createDataFrame([(people,)], f"p {PERSON}")
    found = df.select(cases.first_defendant(F.col("p")).alias("d")).first().d
    assert (tuple(found) if found else (None, None, None)) == expected


@pytest.mark.parametrize(
    "sentence, suspended, days",
    [
        ((1, 2, 3), (1, 0, 0), 63),
        ((0, 0, 10), (1, 0, 0), 0),
        (None, None, 0),
        ((None, 1, None), None, 30),
    ],
)
def test_net_sentence_days(spark, sentence, suspended, days):
    kind = "struct<years: bigint, months: bigint, days: bigint>"
    df = spark.createDataFrame([(sentence, suspended)], f"a {kind}, b {kind}")
    assert df.select(cases.net_sentence_days(F.col("a"), F.col("b"))).first()[0] == days


def test_total_financial(spark):
    kind = """fin struct<fines: struct<imposedAmount: struct<decimal: double>>,
              costs: struct<amount: struct<decimal: double>>>"""
    df = spark.createDataFrame([((((100.0,),), ((50.5,),)),), ((None, ((1.0,),)),), (None,)], kind)
    assert [r[0] for r in df.select(cases.total_financial(F.col("fin"))).collect()] == [150.5, 1.0, 0.0]


def test_days_and_flags(spark):
    df = spark.createDataFrame([("2024-01-10", "2024-01-05", None), ("2024-01-01", "2024-01-31", "D")], "a string, b string, c string")
    a, b = F.col("a").cast("date"), F.col("b").cast("date")
    got = rows(df.select(dates.days_between_nonneg(a, b), dates.days_between(a, b), scalars.is_code(F.col("c"))))
    assert got == [(None, -5, False), (30, 30, True)]


def test_add_features_on_a_record(spark):
    from stratalake.sources.schemas import CASE_SCHEMA

    record = """{"caseNumber":"1","offenseDate":"01/10/2024","chargeDesc":"Theft","disposition":{"dispositionInfo":
      {"dispositionDate":"2024-02-10","dispositionText":"D"}},"caseParticipant":[{"participantCode":"DEF",
      "personalDetails":{"race":"B","gender":"M"}}],"sentencingInformation":{"sentence":{"days":4}}}"""
    df = spark.createDataFrame([(record,)], "v string").select(F.from_json("v", CASE_SCHEMA).alias("r")).select("r.*")
    row = silver.add_features(df).first()
    assert (row.daysToDisposition, row.race, row.attorneyType, row.netSentenceDays) == (31, "B", "Private/None", 4)
    assert row.totalFinancial == 0.0 and row.charge == "Theft" and row.dispositionText == "D"
    flat = silver.to_flat_view(df).first()
    assert (flat.disposition_text, flat.race, flat.offense_date) == ("D", "B", dt.date(2024, 1, 10))


# --- normalisation -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, snake",
    [
        ("caseTrackingID", "case_tracking_id"),
        ("caseCharge_chargeFilingDate", "case_charge_charge_filing_date"),
        (" some-Name/x y ", "some_name_x_y"),
        ("HTMLParser", "html_parser"),
        ("fipsCode4", "fips_code4"),
        ("a1B", "a1_b"),
        ("ABC", "abc"),
    ],
)
def test_snake_case(name, snake):
    assert normalize.snake_case(name) == snake


def test_dedupe_names():
    assert normalize.dedupe_names(["a", "b", "a", "a"]) == ["a", "b", "a_dup_1", "a_dup_2"]


RAW = """{"caseNumber":"C1","offenseDate":"01/02/2024","hearingDate":"01/15/2024, 09:00 AM",
 "caseCharge":{"chargeFilingDate":"1/3/2024","offenseDate":"01/04/2024"},
 "locality":{"localityName":"Albemarle","localityCode":"%s"},"caseActiveIndicator":{"value":"%s"},
 "caseTrackingID":"T","financialInformation":{"fines":{"paidDate":{"date":1704067200000}}},
 "appealCase":{"appealDate":"02/01/2024"},"items":[{"k":1,"z":null}]}"""
RAW_SCHEMA = """caseNumber string, offenseDate string, hearingDate string,
 caseCharge struct<chargeFilingDate: string, offenseDate: string>,
 locality struct<localityName: string, localityCode: string>, caseActiveIndicator struct<value: string>,
 caseTrackingID string, financialInformation struct<fines: struct<paidDate: struct<date: bigint>>>,
 appealCase struct<appealDate: string>, items array<struct<k: bigint, z: string>>"""


def raw(spark, code="003", active="Y"):
    df = spark.createDataFrame([(RAW % (code, active),)], "v string")
    return df.select(F.from_json("v", RAW_SCHEMA).alias("r")).select("r.*")


def test_normalize_cases(spark):
    out = normalize.normalize_cases(raw(spark))
    row = out.first()
    assert row.case_tracking_id == "T" and row.case_number == "C1"
    assert row.filed_date == dt.datetime(2024, 1, 3)
    assert row.offense_date == dt.datetime(2024, 1, 2) and row.offense_date_dup_1 == "01/04/2024"
    assert row.hearing_date == dt.datetime(2024, 1, 15, 9)
    assert row.locality_name == "Albemarle" and row.locality_code == 3
    assert row.is_active is True and row.is_appeal is None and row.appeal_date == dt.datetime(2024, 2, 1)
    assert row.fines_paid_date is None  # integer dates are not read by default
    assert row["items"] == '[{"k":1,"z":null}]'
    types = dict(out.dtypes)
    for field in normalize.GOLDEN_SCHEMA:
        assert types[field.name] == field.dataType.simpleString()


def test_normalize_options(spark):
    row = normalize.normalize_cases(raw(spark), epoch_ms=True, appeal_from_struct=True).first()
    assert row.fines_paid_date == dt.datetime(2024, 1, 1) and row.is_appeal is True


def test_bad_values_are_null_and_counted(spark):
    flat = normalize.rename(normalize.snake_case_columns(normalize.flatten_structs(raw(spark, "x1", "T"))))
    row = normalize.enforce_schema(flat).first()
    assert row.locality_code is None and row.is_active is None
    assert rows(normalize.cast_failures(flat)) == [("locality_code", 1)]


def test_boolean_map(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("true",), ("false",), ("T",), (None,), ("1",), ("0",), ("1.0",)], "v string")
    assert [r[0] for r in df.select(scalars.yn_to_bool(F.col("v"))).collect()] == [True, False, True, False, None, None, None, None, None]
    numbers = spark.createDataFrame([(1,), (0,), (2,)], "v int")
    assert [r[0] for r in numbers.select(scalars.yn_to_bool(F.col("v"))).collect()] == [True, False, None]


def test_null_normalisation(spark):
    df = spark.createDataFrame([("x",), ("",), (None,), ("N/A",)], "v string")
    got = [r[0] for r in df.select(scalars.normalize_nulls(F.col("v"), ["", "N/A", None], "?")).collect()]
    assert got == ["x", "?", "?", "?"]
    assert [r[0] for r in df.select(scalars.normalize_nulls(F.col("v"), [""], None)).collect()] == ["x", None, None, "N/A"]


def test_void_columns_become_text(spark):
    out = normalize.null_cols_to_string(spark.range(1).select(F.lit(None).alias("v"), "id"))
    assert out.dtypes == [("v", "string"), ("id", "bigint")]


@pytest.mark.parametrize(
    "text, a",
    [
        ('{"a": 1}', 1),
        ("{'a': 2}", 2),
        ("{'a': None, 'b': True}", None),
        ("  {'a': 3, 'b': \"O'Brien, None\"}", 3),
        ("plain {", None),
        ("{broken", None),
        (None, None),
    ],
)
def test_parse_json_text_typed(spark, text, a):
    df = spark.createDataFrame([(text,)], "t string")
    found = df.select(jsontext.parse_json_text(F.col("t"), "a bigint, b string").alias("p")).first().p
    assert (found.a if found else None) == a
    if text and "Brien" in text:
        assert found.b == "O'Brien, None"


def test_parse_json_text_untyped_keeps_other_text(spark):
    df = spark.createDataFrame([("{'k': True}",), ("note",), ("{broken",)], "t string")
    got = [r[0] for r in df.select(F.to_json(jsontext.parse_json_text(F.col("t")))).collect()]
    assert got == ['{"k":true}', '"note"', '"{broken"']


def test_small_scalars(spark):
    df = spark.createDataFrame([("059", "C", "CR1", dt.date(2024, 5, 1), [[1, 2], None, [3]])], "f string, d string, n string, day date, l array<array<int>>")
    row = df.select(
        scalars.case_url(F.col("f"), F.col("d"), F.col("n"), "u=").alias("url"),
        dates.date_path(F.col("day")).alias("path"),
        scalars.flatten_lists(F.col("l")).alias("flat"),
        scalars.label_when(F.col("n").isNull(), "a", "b").alias("label"),
    ).first()
    assert tuple(row) == ("u=059CCR1", "output/2024/05/01.jsonl", [1, 2, 3], "b")
