import math

import pytest
from pyspark.sql import functions as F

from stratalake.operators import model as m
from stratalake.plans import analysis
from stratalake.sources.files import as_struct
from stratalake.streaming import ingest
from tests.conftest import rows


@pytest.fixture(scope="module")
def people(spark):
    """Dismissal is likelier for g = 'b'; the third column has many rare values."""
    return spark.range(1200).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"),
        F.concat(F.lit("c"), F.least(F.col("id") % 50, F.lit(9) + F.col("id") % 30)).alias("code"),
        (F.pmod(F.xxhash64("id"), F.lit(10)) < F.when(F.col("id") % 2 == 0, 2).otherwise(7)).alias("y"),
        "id",
    )


def test_top_n_or_other(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",), ("d",)], "v string")
    assert dict(rows(m.top_n_or_other(df, "v", 2).groupBy("v").count())) == {"a": 3, "b": 2, "Other": 2}


def test_row_split_is_exact_and_repeatable(people):
    first, again = (m.stratified_split(people, "y", ["id"]) for _ in range(2))
    for row in first.groupBy("y").agg(F.count_if("is_train").alias("t"), F.count(F.lit(1)).alias("n")).collect():
        assert row.t == round(row.n * 0.8)
    assert first.columns == [*people.columns, "is_train"]
    assert sorted(rows(first.select("id", "is_train"))) == sorted(rows(again.select("id", "is_train")))
    other = m.stratified_split(people, "y", ["id"], seed=7)
    assert sorted(rows(other.select("id", "is_train"))) != sorted(rows(first.select("id", "is_train")))


def test_combination_split_is_exact_per_class_and_proportional(people):
    split = m.split_combinations(people.select("g", "code", "y"), "y")
    totals = split.groupBy("y").agg(F.sum("n_train").alias("t"), F.sum(F.col("n_train") + F.col("n_test")).alias("n"))
    for row in totals.collect():
        assert row.t == round(row.n * 0.8)
    assert split.filter("n_train < 0 OR n_test < 0").count() == 0
    assert split.filter("abs(n_train - 0.8 * (n_train + n_test)) > 1").count() == 0


def test_one_hot_drops_the_first_and_zeroes_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), ("new",)], "v string")
    out = m.one_hot_drop_first(df, {"v": ["a", "b", "c"]})
    assert rows(out) == [("b", 1.0, 0.0), ("a", 0.0, 0.0), ("new", 0.0, 0.0)]


def loss_gradient(data, coefficients, intercept):
    """Gradient of sum(log loss) + |w|²/2, zero at the optimum."""
    grad, free = coefficients[0], 0.0
    for x, y, n in data:
        p = 1 / (1 + math.exp(-(intercept + coefficients[0] * x)))
        grad += n * (p - y) * x
        free += n * (p - y)
    return grad, free


def test_fit_is_the_penalised_optimum_and_weights_equal_rows(people):
    by_rows = m.fit_logistic(people, ["g"], "y")
    counts = people.groupBy("g", "y").agg(F.count(F.lit(1)).alias("n"))
    by_weight = m.fit_logistic(counts, ["g"], "y", "n")
    w, b = list(by_rows.model.coefficients), by_rows.model.intercept
    assert w == pytest.approx(list(by_weight.model.coefficients), rel=1e-6)
    data = [(float(r.g == "b"), float(r.y), r.n) for r in counts.collect()]
    assert loss_gradient(data, w, b) == (pytest.approx(0, abs=0.05), pytest.approx(0, abs=0.05))
    (odds,) = m.odds_with_direction(m.odds_ratios(by_rows, people)).collect()
    assert odds.feature == "g_b" and odds.odds_ratio == pytest.approx(math.exp(w[0])) and odds.direction == "higher"


def test_too_many_levels_are_refused(spark):
    df = spark.range(1500).select(F.col("id").cast("string").alias("v"), (F.col("id") % 2 == 0).alias("y"))
    with pytest.raises(ValueError):
        m.fit_logistic(df, ["v"], "y")


def test_dismissal_model(people):
    out = analysis.fit_dismissal_model(people, ["g", "code"], "y", ["code"])
    accuracy = out["accuracy"].first()
    assert accuracy.model_accuracy > accuracy.baseline_accuracy
    odds = rows(out["odds_ratios"])
    assert odds[0][0] == "g_b" and [r[1] for r in odds] == sorted((r[1] for r in odds), reverse=True)
    few = analysis.fit_dismissal_model(people.limit(40), ["g", "code"], "y", [])
    assert few == {"accuracy": None, "odds_ratios": None}


FEATURES = """race string, gender string, attorneyType string, codeSection string, dispositionText string,
netSentenceDays bigint, totalFinancial double, daysToDisposition bigint"""


def test_whole_analysis(spark):
    data = [
        (("W", "B", "H", "A")[i % 4], "MF"[i % 2], ("Public Defender", "Private/None")[i % 3 == 0], f"s{i % 7}",
         "D" if i % 5 in (0, i % 4) else "G", i % 40, float(i % 9), i % 11 if i % 2 else None)
        for i in range(400)
    ]
    out = analysis.analyse(spark.createDataFrame(data, FEATURES))
    assert {r.measure for r in out["descriptive"].collect()} == set(analysis.MEASURES)
    assert out["race_by_dismissal"].count() == 3 and out["chi_square"].first().dof == 2
    assert out["mann_whitney"].first().verdict in ("significant", "not significant")
    assert out["accuracy"].count() == 1 and out["odds_ratios"].count() > 5


def test_eda_reports(spark):
    from entry_queries.frames import records
    from stratalake.plans.silver import to_flat_view

    reports = analysis.eda_reports(to_flat_view(records(spark, "/root/testdata/sf0.001")), min_count=10)
    assert len(reports) == 10 and all(not r.isEmpty() for r in reports.values())


def test_feature_load_exit_codes(spark, write_lines, tmp_path):
    with pytest.raises(SystemExit) as missing:
        analysis.load_case_features(spark, f"{tmp_path}/none.jsonl")
    root = write_lines({"empty.jsonl": [""], "one.jsonl": ['{"caseNumber":"7"}']})
    with pytest.raises(SystemExit) as empty:
        analysis.load_case_features(spark, f"{root}/empty.jsonl")
    assert (missing.value.code, empty.value.code) == (1, 0)
    assert analysis.load_case_features(spark, f"{root}/one.jsonl").first().netSentenceDays == 0


def test_stream_loads_new_files_once_and_rebuilds_touched_days(spark, write_lines):
    from stratalake.sources.schemas import CASE_SCHEMA

    line = '{{"caseNumber":"{}","hearingDate":"{}, 09:00 AM","name":"{}"}}'
    root = write_lines({"in/a.jsonl": [line.format("1", "01/15/2024", "x"), line.format("2", "01/16/2024", "y"), line.format("3", "bad", "q")]})
    paths = (f"{root}/in", f"{root}/bronze", as_struct(CASE_SCHEMA), f"{root}/checkpoint", f"{root}/silver")
    ingest.ingest_stream(spark, *paths).awaitTermination()
    silver = spark.read.parquet(f"{root}/silver")
    assert silver.count() == 3
    before = {r[0] for r in rows(silver.filter("caseNumber = '2'").select(F.col("_metadata.file_path")))}
    write_lines({"in/b.jsonl": [line.format("1", "01/15/2024", "z"), line.format("4", "01/15/2024", "w")]})
    ingest.ingest_stream(spark, *paths).awaitTermination()
    bronze = ingest.read_bronze(spark, f"{root}/bronze", paths[2])
    assert bronze.count() == 5
    silver = spark.read.parquet(f"{root}/silver")
    assert sorted(r[0] for r in rows(silver.select("caseNumber"))) == ["1", "2", "3", "4"]
    newest = silver.filter("caseNumber = '1'").first().defendant_name_hash
    assert newest == spark.range(1).select(F.sha2(F.lit("z"), 256)).first()[0]
    after = {r[0] for r in rows(silver.filter("caseNumber = '2'").select(F.col("_metadata.file_path")))}
    assert after == before  # the other day was not rewritten
