"""Joins (J1–J9), windows and sequences (W1–W6), sorts and limits (T1–T3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.frames import table
from entry_queries.registry import query
from stratalake.functions import dates
from stratalake.operators import joins, sequences

PER_PARTY = """SELECT o_custkey AS party, count(*) AS {n} FROM orders WHERE o_orderstatus = '{s}' GROUP BY 1"""


def per_party(spark, sf, status, name):
    rows = table(spark, sf, "orders").filter(F.col("o_orderstatus") == status)
    return rows.groupBy(F.col("o_custkey").alias("party")).agg(F.count(F.lit(1)).alias(name))


@query(
    "j1_outer_merge",
    f"""SELECT coalesce(a.party, b.party) AS party, closed, open FROM ({PER_PARTY.format(n='closed', s='F')}) a
    FULL JOIN ({PER_PARTY.format(n='open', s='O')}) b ON a.party = b.party""",
)
def j1(spark, sf):
    return joins.outer_merge(per_party(spark, sf, "F", "closed"), per_party(spark, sf, "O", "open"), "party")


@query(
    "j2_feature_join",
    """SELECT c_custkey, c_mktsegment, closed FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS closed FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey""",
)
def j2(spark, sf):
    counts = per_party(spark, sf, "F", "closed").withColumnRenamed("party", "c_custkey")
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment").join(counts, "c_custkey", "left")


@query(
    "j3_semi_join",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
    (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def j3(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi(table(spark, sf, "customer"), urgent, "c_custkey").select("c_custkey", "c_name")


@query(
    "j4_lookup",
    """SELECT p_partkey, p_brand, 'bulk' AS kind FROM part WHERE p_brand IN ('Brand#2', 'Brand#4')
    UNION ALL SELECT p_partkey, p_brand, 'bulk by frame' FROM part WHERE p_partkey IN
      (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)
    UNION ALL (SELECT p_partkey, p_brand, 'single' FROM part WHERE p_brand = 'Brand#17' ORDER BY p_partkey LIMIT 1)""",
)
def j4(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    wanted = table(spark, sf, "lineitem").filter("l_quantity = 50").select("l_partkey")
    bulk = joins.lookup(parts, "p_brand", ["Brand#2", "Brand#4"]).withColumn("kind", F.lit("bulk"))
    framed = joins.lookup(parts, "p_partkey", wanted).withColumn("kind", F.lit("bulk by frame"))
    one = joins.lookup(parts, "p_brand", "Brand#17", first=True, tiebreak=["p_partkey"])
    return bulk.unionByName(framed).unionByName(one.withColumn("kind", F.lit("single")))


@query(
    "j5_court_for",
    """SELECT s_suppkey, s_nationkey, n_name FROM supplier LEFT JOIN
    (SELECT * FROM nation WHERE n_regionkey <> 0) ON s_nationkey = n_nationkey""",
)
def j5(spark, sf):
    courts = table(spark, sf, "nation").filter("n_regionkey <> 0")
    found = joins.court_for(table(spark, sf, "supplier"), courts, "s_nationkey", "n_nationkey")
    return found.select("s_suppkey", "s_nationkey", "n_name")


@query(
    "j6_enrich",
    """SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice * 2 AS doubled
    FROM orders WHERE o_orderpriority <> '5-LOW'""",
)
def j6(spark, sf):
    orders = table(spark, sf, "orders")
    stubs = orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    details = orders.filter("o_orderpriority <> '5-LOW'").selectExpr(
        "o_orderkey", "lower(o_orderstatus) AS o_orderstatus", "o_totalprice * 2 AS doubled"
    )
    return joins.enrich(stubs, details, ["o_orderkey"])


@query(
    "j7_star",
    """SELECT c_mktsegment, p_brand, count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def j7(spark, sf):
    found = joins.star(
        table(spark, sf, "orders").selectExpr("o_orderkey AS case_id", "o_custkey AS court_id"),
        table(spark, sf, "customer").selectExpr("c_custkey AS court_id", "c_mktsegment"),
        table(spark, sf, "lineitem").selectExpr("l_orderkey AS case_id", "l_partkey AS charge_id"),
        table(spark, sf, "part").selectExpr("p_partkey AS charge_id", "p_brand"),
    )
    return found.groupBy("c_mktsegment", "p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("j8_all_courts", "SELECT n_nationkey, n_name FROM nation ORDER BY 1")
def j8(spark, sf):
    return joins.all_courts(table(spark, sf, "nation").select("n_nationkey", "n_name"))


@query(
    "j9_anti_join",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def j9(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(table(spark, sf, "customer"), urgent, "c_custkey").select("c_custkey", "c_name")


# --- windows ------------------------------------------------------------------------------------


@query(
    "w1_latest_per_key",
    """SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def w1(spark, sf):
    latest = sequences.latest_per_key(
        table(spark, sf, "events"), ["user_id", "event_type"], "ts", [F.col("event_id").desc()]
    )
    return latest.select("user_id", "event_type", "event_id", "value")


@query(
    "w2_hearing_velocity",
    """SELECT l_orderkey, round(avg(gap), 6) AS mean_gap_days FROM (SELECT l_orderkey, date_diff('day',
      lag(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate), l_shipdate) AS gap FROM lineitem)
    GROUP BY 1""",
)
def w2(spark, sf):
    gaps = sequences.mean_gap_days(table(spark, sf, "lineitem"), ["l_orderkey"], "l_shipdate")
    return gaps.withColumn("mean_gap_days", F.round("mean_gap_days", 6))


@query(
    "w3_latest_hearing",
    """SELECT l_orderkey, l_shipdate, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_extendedprice DESC) = 1""",
)
def w3(spark, sf):
    last = sequences.latest_record(
        table(spark, sf, "lineitem"),
        ["l_orderkey"],
        "l_shipdate",
        [F.col("l_linenumber").desc(), F.col("l_extendedprice").desc()],
    )
    return last.select("l_orderkey", "l_shipdate", "l_linenumber", "l_extendedprice")


@query(
    "w4_case_delay",
    "SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS delay_days FROM orders",
)
def w4(spark, sf):
    delay = dates.age_days(F.col("o_orderdate"), F.lit("2002-01-01").cast("date"))
    return table(spark, sf, "orders").select("o_orderkey", delay.alias("delay_days"))


@query(
    "w5_batches",
    """SELECT date, batch, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM (
    SELECT CAST(ts AS DATE) AS date, event_id,
    (row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) - 1) // 300 AS batch FROM events)
    GROUP BY 1, 2""",
)
def w5(spark, sf):
    rows = table(spark, sf, "events").select(F.col("ts").cast("date").alias("date"), "ts", "event_id")
    batched = sequences.assign_batches(rows, ["date"], "ts", tiebreak=["event_id"])
    return batched.groupBy("date", "batch").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query(
    "w6_ordered_hearings",
    """SELECT l_orderkey, l_linenumber, l_shipdate, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate, l_linenumber, l_extendedprice) AS position FROM lineitem""",
)
def w6(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    placed = sequences.ordered_children(rows, ["l_orderkey"], "l_shipdate", ["l_linenumber", "l_extendedprice"])
    return placed.drop("l_extendedprice")


# --- sorts and limits -----------------------------------------------------------------------------


@query(
    "t1_sorted_aggregate",
    "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand NULLS LAST",
)
def t1(spark, sf):
    counts = table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.col("p_brand").asc_nulls_last())


@query("t2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def t2(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)
