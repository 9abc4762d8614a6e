import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from stratalake.operators import joins, quality, ranking, sequences
from tests.conftest import rows


def hearings(spark):
    days = [("A", "2024-01-01"), ("A", "2024-01-31"), ("A", "2024-01-11"), ("B", "2024-03-01"), ("C", None)]
    return spark.createDataFrame(days, "case string, day string").select("case", F.col("day").cast("date").alias("day"))


def test_velocity_latest_and_order(spark):
    df = hearings(spark)
    assert dict(rows(sequences.mean_gap_days(df, ["case"], "day"))) == {"A": 15.0, "B": None, "C": None}
    last = dict(rows(sequences.latest_record(df, ["case"], "day")))
    assert last["A"] == dt.date(2024, 1, 31)
    placed = rows(sequences.ordered_children(df.filter("case = 'A'"), ["case"], "day").orderBy("position"))
    assert [r[1].day for r in placed] == [1, 11, 31] and [r[2] for r in placed] == [1, 2, 3]


def test_batches_of_300(spark):
    df = spark.range(601).select(F.lit("2024-05-01").alias("date"), "id")
    out = sequences.assign_batches(df, ["date"], "id")
    assert rows(out.groupBy("batch").count().orderBy("batch")) == [(0, 300), (1, 300), (2, 1)]
    assert out.filter("batch != floor(id / 300)").count() == 0


@pytest.mark.parametrize("kind", ["int", "double", "date", "timestamp_ntz", "string"])
def test_numbering_equals_the_plain_window(spark, kind):
    rnd = random.Random(kind)
    data = [("hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None]), rnd.randint(0, 400), i) for i in range(1500)]
    df = spark.createDataFrame(data, "g string, n int, id int")
    n = F.when(F.col("n") % 50 != 7, F.col("n"))  # some nulls
    order = {
        "int": n,
        "double": n / 7 - 20,
        "date": F.date_add(F.lit("2024-01-01").cast("date"), n),
        "timestamp_ntz": F.date_add(F.lit("2024-01-01").cast("date"), n).cast("timestamp_ntz"),
        "string": F.concat(F.lit("CR-"), n.cast("string")),
    }[kind]
    df = df.withColumn("o", order)
    plain = Window.partitionBy("g").orderBy(F.col("o").asc_nulls_last(), "id")
    want = dict(rows(df.select("id", F.row_number().over(plain))))
    for ranges in (1, 7, 64):
        found = ranking.numbered(df, ["g"], "o", ["id"], "rn", ranges=ranges)
        assert found.columns == [*df.columns, "rn"]
        assert dict(rows(found.select("id", "rn"))) == want


def test_one_tied_hot_key_is_split_over_ranges(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ranking, "cut_lineage", lambda df: seen.append(df) or df)
    df = spark.range(2000).select(F.lit("hot").alias("g"), F.lit(1).alias("o"), "id")
    found = ranking.numbered(df, ["g"], "o", ["id"], "rn", ranges=8)
    assert found.filter("rn != id + 1").count() == 0
    sizes = [n for _, n in rows(seen[0].groupBy(ranking.BUCKET).count())]
    assert len(sizes) == 8 and max(sizes) < 1000


def test_numbering_without_groups(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("v"))
    found = ranking.numbered(df, [], "v", name="rn")
    assert found.filter("rn != v + 1").count() == 0 and found.count() == 500


def test_running_totals(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), F.lit(2).alias("n"))
    found = ranking.running(df, "v", ["n"], ["g"], ranges=9)
    assert found.filter("before_n != floor(v / 3) * 2").count() == 0


def test_hot_key_dedupe_keeps_one_row_and_limits_the_shuffle(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), "id")
    out = sequences.latest_per_key(df, ["k"], "id")
    assert out.count() == out.select("k").distinct().count()
    assert out.filter("k = 0 AND id > 0").first().id == 19999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


# --- joins -------------------------------------------------------------------------------------


@pytest.fixture
def courts(spark):
    return spark.createDataFrame(
        [("001C", "001", "A Circuit", "C"), ("003G", "003", "B General", "G")],
        "fipsCode4 string, fipsCode string, courtName string, courtTypeCode string",
    )


def test_outer_merge(spark, courts):
    urls = spark.createDataFrame([("001C", "u1"), ("999Z", "u9")], "fipsCode4 string, url string")
    got = {r.fipsCode4: r for r in joins.outer_merge(courts, urls, "fipsCode4").collect()}
    assert set(got) == {"001C", "003G", "999Z"}
    assert got["001C"].fipsCode == "001" and got["003G"].url is None and got["999Z"].courtName is None


def test_lookups(spark, courts):
    assert joins.lookup(courts, "fipsCode4", "001C", first=True).first().courtName == "A Circuit"
    assert joins.lookup(courts, "fipsCode4", ["001C", "003G", "x"]).count() == 2
    many = [f"k{i}" for i in range(1500)] + ["003G"]
    assert rows(joins.lookup(courts, "fipsCode4", many).select("fipsCode")) == [("003",)]
    assert joins.lookup(courts, "fipsCode4", courts.select("fipsCode4")).count() == 2
    rows_with = spark.createDataFrame([("001C",), ("zzz",)], "court string")
    found = joins.court_for(rows_with, courts, "court")
    assert dict(rows(found.select("court", "courtName"))) == {"001C": "A Circuit", "zzz": None}
    assert joins.all_courts(courts.union(courts)).count() == 4


def test_enrich_prefers_details_and_drops_failed(spark):
    stubs = spark.createDataFrame([(1, "old", "s1"), (2, "old", "s2")], "id int, name string, stub string")
    details = spark.createDataFrame([(1, "new", 9)], "id int, name string, extra int")
    out = joins.enrich(stubs, details, ["id"])
    assert out.columns == ["id", "name", "stub", "extra"] and rows(out) == [(1, "new", "s1", 9)]


def test_star_and_delete_propagation(spark):
    courts = spark.createDataFrame([(1, "VA059")], "court_id int, fips string")
    cases = spark.createDataFrame([(10, 1, "CR-2026-00451A")], "case_id int, court_id int, number string")
    links = spark.createDataFrame([(10, 7, "Felony")], "case_id int, charge_id int, kind string")
    charges = spark.createDataFrame([(7, "18.2-248")], "charge_id int, code string")
    row = joins.star(cases, courts, links, charges).first()
    assert (row.fips, row.code) == ("VA059", "18.2-248")
    kept, _ = quality.propagate_delete(cases, "case_id", {"links": (links, "case_id")})
    assert kept["links"].count() == 0 and charges.count() == 1
    _, blocked = quality.propagate_delete(charges, "charge_id", {}, {"links": (links, "charge_id")})
    assert rows(blocked) == [(7, "links")]


# --- audits ------------------------------------------------------------------------------------


def test_audits(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, 1), (1, "a", -1, 9), (2, None, None, None), (2, None, 3, 1)], "k int, s string, money int, fk int"
    )
    assert rows(quality.unique_violations(df, ["k", "s"])) == [(1, "a", 2)]
    broken = quality.assert_rows(df, {"money": F.col("money") >= 0, "key": F.col("k") < 2}, ["k"])
    assert dict(rows(quality.count_by_rule(broken))) == {"money": 1, "key": 2}
    parents = spark.createDataFrame([(1,)], "id int")
    found = sorted(rows(quality.fk_violations(df, parents, "fk", "id")), key=str)
    assert found == [(9, 1, "missing parent"), (None, 1, "null key")]
    columns = rows(quality.column_violations(df, ["s", "money"], {"s": 0}))
    assert columns == [("s", "not null", 2), ("money", "not null", 1), ("s", "max length 0", 2)]
    summary = quality.failure_summary(df.withColumn("bad", F.col("money") < 0), ["k"], "bad")
    assert sorted(rows(summary)) == [(1, 1, 1), (2, 2, 0)]
