"""Validation and data-quality queries (V1–V9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.frames import HEARINGS_SQL as H, hearings, joined, JOINED_SQL, table
from entry_queries.registry import query
from stratalake.operators import quality, validate
from stratalake.session import new_path

ORDER_SCHEMA = {
    "type": "array",
    "items": {
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
            "a": {
                "type": "array",
                "items": {"type": "object", "properties": {"k": {"type": ["string", "null"]}}, "required": ["k"]},
            },
        },
        "required": ["id", "a"],
    },
}


def order_lines(spark, sf):
    """Orders as JSON lines; what is wrong with a line follows from its status and priority."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        """CASE
             WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN concat('{bad', o_orderkey)
             WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN '   '
             WHEN o_orderpriority = '1-URGENT' THEN concat('{"n":', o_custkey, ',"a":[]}')
             WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN concat('{"id":', o_orderkey, ',"a":[]}')
             WHEN o_orderpriority = '2-HIGH' THEN concat('{"id":"', o_orderkey, '","d":{},"a":[]}')
             WHEN o_orderpriority = '3-MEDIUM' THEN concat('{"id":"', o_orderkey, '","a":[{"k":"x"},{}]}')
             WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN
               concat('{"id":"', o_orderkey, '","n":', o_custkey, '.5,"a":[]}')
             WHEN o_orderpriority = '4-NOT SPECIFIED' THEN
               concat('{"id":"', o_orderkey, '","n":', o_custkey, '.0,"d":null,"a":[{"k":null}]}')
             ELSE concat('{"id":"', o_orderkey, '","a":[],"n":"first","n":', o_custkey, '}') END AS value""",
    )


ERROR_SQL = """CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'decode'
    WHEN o_orderpriority = '1-URGENT' THEN 'required id'
    WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 'type of id'
    WHEN o_orderpriority = '2-HIGH' THEN 'required d.t'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'required a[].k'
    WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'type of n' END"""
NOT_BLANK = "NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')"


@query(
    "v1_schema_check",
    f"""SELECT {ERROR_SQL} AS error, count(*) AS records FROM orders WHERE {NOT_BLANK} GROUP BY 1""",
)
def v1(spark, sf):
    checked = validate.validate_json(order_lines(spark, sf), "value", ORDER_SCHEMA)
    return checked.groupBy("error").agg(F.count(F.lit(1)).alias("records"))


@query("v2_sampled_check")
def v2(spark, sf):
    # which lines lie first in which file depends on the write, so there is no SQL form
    path = new_path(spark, "lines")
    order_lines(spark, sf).select("value").write.text(path)
    checked = validate.validate_json(validate.sample_files(spark, path), "value", ORDER_SCHEMA)
    return validate.reported_errors(checked).groupBy("error").agg(F.count(F.lit(1)).alias("reported"))


@query(
    "v3_gate",
    f"""SELECT count(*) AS records, count({ERROR_SQL}) AS failed, FALSE AS passed FROM orders WHERE {NOT_BLANK}""",
)
def v3(spark, sf):
    checked = validate.validate_json(order_lines(spark, sf), "value", ORDER_SCHEMA)
    try:
        validate.gate(checked)
        passed = True
    except validate.SchemaViolation:
        passed = False
    return checked.agg(
        F.count(F.lit(1)).alias("records"), F.count("error").alias("failed"), F.lit(passed).alias("passed")
    )


@query(
    "v4_row_assertions",
    f"""SELECT rule, count(*) AS violations FROM (
    SELECT 'offense before hearing' AS rule FROM {JOINED_SQL} WHERE l_shipdate < o_orderdate
    UNION ALL SELECT 'money not negative' FROM {JOINED_SQL} WHERE c_acctbal < 0) GROUP BY 1""",
)
def v4(spark, sf):
    rules = {
        "offense before hearing": F.col("o_orderdate") <= F.col("l_shipdate"),
        "money not negative": F.col("c_acctbal") >= 0,
    }
    return quality.count_by_rule(quality.assert_rows(joined(spark, sf), rules, ["l_orderkey", "l_linenumber"]))


@query(
    "v5_unique_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def v5(spark, sf):
    return quality.unique_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "v6_foreign_keys",
    """WITH c AS (SELECT CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS key FROM lineitem)
    SELECT key, count(*) AS rows, CASE WHEN key IS NULL THEN 'null key' ELSE 'missing parent' END AS reason FROM c
    WHERE key IS NULL OR key NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1, 3""",
)
def v6(spark, sf):
    child = table(spark, sf, "lineitem").selectExpr("CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS fk")
    parent = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    return quality.fk_violations(child, parent, "fk", "o_orderkey")


@query(
    "v7_columns",
    H + """SELECT 'race' AS "column", 'not null' AS rule, count(*) FILTER (race IS NULL) AS violations FROM h
    UNION ALL SELECT 'fine_amount', 'not null', count(*) FILTER (fine_amount IS NULL) FROM h
    UNION ALL SELECT 'chargeDesc', 'max length 8', count(*) FILTER (length("chargeDesc") > 8) FROM h""",
)
def v7(spark, sf):
    return quality.column_violations(hearings(spark, sf), ["race", "fine_amount"], {"chargeDesc": 8})


@query(
    "v8_delete_propagation",
    """SELECT 'kept ' || l_returnflag AS what, count(*) AS n FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1
    UNION ALL SELECT 'blocked', count(*) FROM part WHERE p_type = 'ECONOMY'
    AND p_partkey IN (SELECT l_partkey FROM lineitem)""",
)
def v8(spark, sf):
    lines = table(spark, sf, "lineitem")
    kept, _ = quality.propagate_delete(
        table(spark, sf, "orders").filter("o_orderstatus = 'P'"), "o_orderkey", {"lines": (lines, "l_orderkey")}
    )
    _, blocked = quality.propagate_delete(
        table(spark, sf, "part").filter("p_type = 'ECONOMY'"), "p_partkey", {}, {"lines": (lines, "l_partkey")}
    )
    count = F.count(F.lit(1)).alias("n")
    return (
        kept["lines"]
        .groupBy(F.concat(F.lit("kept "), "l_returnflag").alias("what"))
        .agg(count)
        .unionByName(blocked.groupBy(F.lit("blocked").alias("what")).agg(count))
    )


@query(
    "v9_failure_counts",
    """SELECT CAST(ts AS DATE) AS date, event_type, count(*) FILTER (NOT value < 5) AS written,
    count(*) FILTER (value < 5) AS failed FROM events GROUP BY 1, 2""",
)
def v9(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("date"), "event_type", (F.col("value") < 5).alias("failed_now")
    )
    return quality.failure_summary(rows, ["date", "event_type"], "failed_now")
