import datetime as dt
import itertools
import random
import statistics

import math

import pytest
from pyspark.sql import functions as F

from stratalake.operators import aggregates as agg, plotdata, quantiles, stats
from tests.conftest import rows

GOLD = """locality_name string, caseNumber string, chargeDesc string, offense_date date, hearing_timestamp timestamp_ntz,
financialInformation struct<fines: struct<amount: struct<decimal: double>>>,
disposition struct<dispositionInfo: struct<dispositionText: string>>"""


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(
        [
            ("Norwick", "TR24-0417", "Driving suspended", dt.date(2024, 1, 8), dt.datetime(2024, 1, 15, 9), (((80.0,),),), (("Fined",),)),
            ("Norwick", "TR24-0552", "Trespass", dt.date(2024, 1, 6), dt.datetime(2024, 1, 16, 10), (((130.0,),),), (("Fined",),)),
        ],
        GOLD,
    )


def test_gold_tables(silver):
    got = {name: rows(build(silver)) for name, build in agg.GOLD_TABLES.items()}
    assert len(got) == 6
    assert got["monthly_locality_summary"] == [("Norwick", dt.datetime(2024, 1, 1), 2, 105.0, 2)]
    assert sorted(got["charge_outcome_profile"]) == [("Driving suspended", "Fined", 1), ("Trespass", "Fined", 1)]
    assert got["locality_efficiency"] == [("Norwick", 8.5)]
    assert got["day_of_week_summary"] == [("Monday", 1, 1), ("Tuesday", 2, 1)]
    assert got["disposition_summary"] == [("Fined", 2)]
    assert got["hearings_per_case_distribution"] == [(1, 2)]


def test_month_counts_add_up_with_null_groups(spark, silver):
    nulls = silver.withColumn("locality_name", F.lit(None).cast("string")).withColumn(
        "hearing_timestamp", F.lit(None).cast("timestamp_ntz")
    )
    out = agg.monthly_locality_summary(silver.unionByName(nulls))
    assert out.agg(F.sum("case_count")).first()[0] == 4
    assert out.filter("locality_name IS NULL AND month IS NULL").count() == 1


def test_reports(spark):
    df = spark.createDataFrame(
        [("a", "D", "W", 10.0), ("a", None, "W", 0.0), ("b", "D", None, 30.0), ("a", "G", "B", 20.0)],
        "chargeDesc string, disposition_text string, race string, fine_amount double",
    )
    assert rows(agg.value_share(df, "disposition_text", "d")) == [("D", 2, 50.0), ("G", 1, 25.0), (None, 1, 25.0)]
    assert rows(agg.dismissal_rate_by(df, min_count=1)) == [("W", 2, 50.0)]
    assert rows(agg.fine_distribution(df)) == [(10.0, 30.0, 20.0, 20.0)]
    profile = agg.charge_profile(df, n=1)
    assert rows(profile) == [("a", "D", 1), ("a", "G", 1), ("a", None, 1)]
    assert rows(agg.pivot_counts(profile, "chargeDesc", "disposition_text", ["D", "G", None])) == [("a", 1, 1, 1)]
    assert agg.pivot_counts(profile, "chargeDesc", "disposition_text").columns == ["chargeDesc", "null", "D", "G"]
    assert rows(agg.dismissal_rate(df, "disposition_text")) == [(4, 2, 50.0)]
    assert rows(agg.dismissal_rate(df.limit(0), "disposition_text")) == [(0, 0, 0.0)]
    assert rows(agg.representation_share(df, "race")) == [("Attorney", 3, 75.0), ("No Attorney", 1, 25.0)]


def test_descriptive_stats(spark):
    df = spark.createDataFrame([(1.0, 1, 5.0), (2.0, None, 5.0), (2.0, None, 5.0), (10.0, None, 5.0)], "x double, y int, z double")
    got = {r.measure: r for r in stats.describe_measures(df.withColumn("none", F.lit(None).cast("double")), ["x", "y", "z", "none"]).collect()}
    x = got["x"]
    assert (x.n, x.mean, x.median, x.q1, x.q3, x.iqr) == (4, 3.75, 2.0, 1.75, 4.0, 2.25)
    assert x["skew"] == pytest.approx(1.9225217141)
    assert got["y"].n == 1 and got["y"]["skew"] is None and got["z"]["skew"] is None
    assert "none" not in got


def exact(values, p):
    v = sorted(values)
    rank = (len(v) - 1) * p
    low = int(rank)
    return v[low] + (v[min(low + 1, len(v) - 1)] - v[low]) * (rank - low)


@pytest.mark.parametrize("shape", ["uniform", "ties", "one hot group", "single", "odd numbers"])
def test_quantiles(spark, shape):
    rnd = random.Random(7)
    data = {
        "uniform": [(g, rnd.uniform(-5, 5)) for g in "abc" for _ in range(200)],
        "ties": [(g, float(rnd.randint(0, 3))) for g in "ab" for _ in range(300)],
        "one hot group": [("a", rnd.gauss(0, 1)) for _ in range(900)] + [(None, 1.0), (None, 4.0)],
        "single": [("a", 3.5)],
        "odd numbers": [("a", v) for v in (-1e300, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0 + 2**-52, 1e300)],
    }[shape]
    df = spark.createDataFrame(data + [("a", None)], "g string, v double")
    probs = {"p0": 0.0, "q1": 0.25, "m": 0.5, "q9": 0.9, "p100": 1.0}
    for group in ([], ["g"]):
        found = quantiles.exact_quantiles(df, "v", probs, group).collect()
        wanted = {}
        for g, v in data:
            wanted.setdefault(g if group else "all", []).append(v)
        assert len(found) == len(wanted)
        for row in found:
            values = wanted[row.g if group else "all"]
            for name, p in probs.items():
                assert row[name] == pytest.approx(exact(values, p), abs=1e-9)


def test_quantiles_of_many_distinct_values(spark):
    """One group of more values than a single sort should see, against DuckDB."""
    import duckdb

    df = spark.range(260_000).selectExpr("if(id % 50 = 0, null, 'hot') as g", "(hash(id) * 0.001 + id % 7) * if(id % 3 = 0, 1e-9, 1) as v")
    probs = {"q1": 0.25, "m": 0.5, "q9": 0.9}
    rows_ = df.toPandas()  # noqa: F841 - read by the SQL
    wanted = dict((g, q) for g, *q in duckdb.sql("SELECT g, quantile_cont(v, 0.25), quantile_cont(v, 0.5), quantile_cont(v, 0.9) FROM rows_ GROUP BY g").fetchall())
    found = {r.g: [r.q1, r.m, r.q9] for r in quantiles.exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert found.keys() == wanted.keys()
    assert all(found[g] == pytest.approx(wanted[g], rel=1e-12) for g in found)


def test_crosstab_and_counts(spark):
    df = spark.createDataFrame([("W", True), ("W", False), ("W", False), ("B", True), (None, True)], "race string, d boolean")
    assert sorted(rows(stats.crosstab(df, "race", "d", [False, True]))) == [("B", 0, 1), ("W", 2, 1)]
    percent = rows(plotdata.percent_crosstab(df, "race", "d", [False, True], sort_by="true"))
    assert [r[0] for r in percent] == ["W", "B"] and percent[0][1] == pytest.approx(200 / 3)
    assert rows(stats.value_counts(df, "race", 1)) == [("W", 3)]
    assert sorted(rows(stats.expected_counts(df, "race", "d"))) == [("B", True, 1, 0.5), ("W", False, 2, 1.5), ("W", True, 1, 1.5)]


def table_rows(spark, cells):
    data = [(a, b) for (a, b), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(data, "a string, b string")


def test_chi_square_with_yates(spark):
    df = table_rows(spark, {("x", "t"): 10, ("x", "f"): 20, ("y", "t"): 20, ("y", "f"): 10})
    row = stats.chi_square(df, "a", "b").first()
    assert (row.statistic, row.dof, row.n) == (pytest.approx(5.4), 1, 60)
    assert row.p_value == pytest.approx(0.0201367516) and row.significant
    assert stats.chi_square(df, "a", "b", correction=False).first().statistic == pytest.approx(6.6667, abs=1e-4)


def test_chi_square_larger_tables(spark):
    cells = {("x", "t"): 10, ("x", "f"): 20, ("y", "t"): 20, ("y", "f"): 10, ("z", "t"): 15, ("z", "f"): 15}
    row = stats.chi_square(table_rows(spark, cells), "a", "b").first()
    assert (row.statistic, row.dof) == (pytest.approx(6.6667, abs=1e-4), 2)
    assert row.p_value == pytest.approx(0.0356739934)
    # an empty cell and a rare fourth group that top=3 leaves out
    holes = {("x", "t"): 10, ("y", "t"): 20, ("y", "f"): 10, ("z", "t"): 15, ("z", "f"): 15, ("w", "f"): 1}
    row = stats.chi_square(table_rows(spark, holes), "a", "b", top=3).first()
    observed = [[10, 0], [20, 10], [15, 15]]
    total = sum(map(sum, observed))
    want = sum(
        (o - sum(r) * c / total) ** 2 / (sum(r) * c / total)
        for r in observed
        for o, c in zip(r, (45, 25))
    )
    assert row.statistic == pytest.approx(want) and row.n == 70


def test_chi_square_tail_against_known_values():
    known = {(3.841458820694124, 1): 0.05, (7.814727903251179, 3): 0.05, (9.487729036781154, 4): 0.05, (18.307038053275146, 10): 0.05, (11.070497693516351, 5): 0.05}
    for (x, dof), p in known.items():
        assert stats._chi_square_tail(x, dof) == pytest.approx(p, rel=1e-9)


def test_chi_square_tail_of_large_tables():
    # against the Wilson-Hilferty value, which is close for many degrees of freedom
    for x, dof in ((1500.0, 1400), (1300.0, 1401), (3000.0, 2900)):
        z = ((x / dof) ** (1 / 3) - (1 - 2 / (9 * dof))) / (2 / (9 * dof)) ** 0.5
        assert stats._chi_square_tail(x, dof) == pytest.approx(math.erfc(z / 2**0.5) / 2, rel=2e-3)


def test_chi_square_of_one_row_and_clashing_names(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "r string, o string")
    row = stats.chi_square(df, "r", "o").first()
    assert (row.statistic, row.dof, row.p_value, row.significant) == (0.0, 0, 1.0, False)


def groups(spark, x, y):
    return spark.createDataFrame([("x", float(v)) for v in x] + [("y", float(v)) for v in y] + [(None, 1.0)], "g string, v double")


def test_mann_whitney_with_ties(spark):
    df = groups(spark, [1, 2, 2, 3, 4, 5, 6, 7, 8], [2, 3, 5, 9, 10, 11, 12, 13, 14])
    row = stats.mann_whitney(df, "g", "v", "x").first()
    assert (row.u1, row.u2, row.tie_term) == (16.0, 65.0, 36.0)
    assert row.sigma == pytest.approx(11.2896360594) and row.z == pytest.approx(2.1258435501)
    assert row.p_value == pytest.approx(0.0335162885) and row.verdict == "significant"
    assert (row.median_first, row.median_other) == (4.0, 10.0)


def test_mann_whitney_needs_more_than_five(spark):
    row = stats.mann_whitney(groups(spark, range(5), range(20)), "g", "v", "x").first()
    assert row.verdict == "insufficient" and row.p_value is None


def test_mann_whitney_exact_for_small_untied_groups(spark):
    from itertools import combinations

    x, y = [1, 4, 6, 9, 12, 15], [2, 3, 5, 7, 8, 10, 11]
    row = stats.mann_whitney(groups(spark, x, y), "g", "v", "x").first()
    pool = sorted(x + y)
    us = []
    for pick in combinations(range(len(pool)), len(x)):
        ranks = sum(i + 1 for i in pick)
        us.append(ranks - len(x) * (len(x) + 1) / 2)
    top = max(row.u1, row.u2)
    want = min(1.0, 2 * sum(u >= top for u in us) / len(us))
    assert row.p_value == pytest.approx(want)


def test_histogram_boxes_and_density(spark):
    values = [1.0, 2.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 5.0), ("a", None)], "g string, v double")
    only = df.filter("g = 'a'")
    bins = rows(plotdata.histogram(only, "v", 3).orderBy("bin"))
    assert [b[3] for b in bins] == [5, 0, 1] and bins[0][1] == 1.0 and bins[-1][2] == pytest.approx(100.0)
    box = plotdata.box_stats(only, "v").first()
    assert (box.q1, box.median, box.q3) == (2.0, 2.5, 3.75)
    assert (box.whisker_low, box.whisker_high, box.outliers) == (1.0, 4.0, 1)
    by = {r.g: r for r in plotdata.box_stats_by(df, "g", "v").collect()}
    assert by["a"].mean == pytest.approx(statistics.mean(values)) and by["b"].outliers == 0
    curve = rows(plotdata.density(only, "v", 50).orderBy("x"))
    assert len(curve) == 50 and max(curve, key=lambda r: r[1])[0] < 20
    assert plotdata.auto_bins(only, "v") >= 1


def test_density_integrates_to_about_one(spark):
    df = spark.range(2000).select(F.randn(3).alias("v"))
    curve = rows(plotdata.density(df, "v").orderBy("x"))
    step = curve[1][0] - curve[0][0]
    assert sum(d for _, d in curve) * step == pytest.approx(1, abs=0.02)


@pytest.mark.parametrize("n1,n2", [(1, 1), (2, 5), (3, 9), (8, 4)])
def test_exact_rank_tail_counts_all_orders(n1, n2):
    places = list(itertools.combinations(range(n1 + n2), n1))
    ranks = [sum(p) - n1 * (n1 - 1) // 2 for p in places]
    for u in range(n1 * n2 + 1):
        assert stats._exact_rank_tail(u, n1, n2) == pytest.approx(sum(r >= u for r in ranks) / len(ranks))


def test_exact_rank_tail_of_large_groups():
    n = 40_000_000
    assert stats._exact_rank_tail(4 * n, 8, n) == pytest.approx(0.5, abs=1e-6)
    assert stats._exact_rank_tail(0, 8, n) == 1.0
