"""Projection queries (P1–P31) and predicates (F1–F7)."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from entry_queries.frames import HEARINGS_SQL as H, LATEST_SQL, RECORDS_SQL, hearings, records, table
from entry_queries.registry import query
from stratalake.functions import cases, dates, hashing, jsontext, scalars
from stratalake.operators import model, normalize
from stratalake.plans import silver

R = f"WITH {RECORDS_SQL} "


def features(spark, sf):
    return silver.add_features(records(spark, sf))


@query(
    "p1_nested_access",
    R + """SELECT "caseNumber", "codeSection", locality_name, disposition_text, fine_amount FROM r""",
)
def p1(spark, sf):
    return records(spark, sf).select(
        "caseNumber",
        "codeSection",
        scalars.field("locality.localityName").alias("locality_name"),
        scalars.field("disposition.dispositionInfo.dispositionText").alias("disposition_text"),
        scalars.field("financialInformation.fines.amount.decimal").alias("fine_amount"),
    )


@query(
    "p2_snake_case_columns",
    """SELECT o_orderkey AS case_tracking_id, o_custkey AS party_number, o_orderstatus AS hearing_result
    FROM orders""",
)
def p2(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return normalize.snake_case_columns(rows.toDF("caseTrackingID", " party-Number", "hearing/Result"))


@query(
    "p3_flatten_structs",
    """SELECT o_orderkey AS "case_number", o_orderstatus AS "case_state_code",
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS "fin_fines_amount" FROM orders""",
)
def p3(spark, sf):
    nested = table(spark, sf, "orders").selectExpr(
        "named_struct('number', o_orderkey, 'state', named_struct('code', o_orderstatus)) AS case",
        """CASE WHEN o_orderpriority <> '5-LOW' THEN named_struct('fines', named_struct('amount', o_totalprice)) END
           AS fin""",
    )
    return normalize.flatten_structs(nested)


@query(
    "p4_rename",
    """SELECT o_orderkey AS case_number, o_orderdate AS filed_date, o_orderstatus AS is_active, o_custkey FROM orders""",
)
def p4(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS case_number",
        "o_orderdate AS case_charge_charge_filing_date",
        "o_orderstatus AS case_active_indicator_value",
        "o_custkey",
    )
    return normalize.rename(rows)


@query(
    "p5_collision_suffix",
    """SELECT o_orderdate AS offense_date, o_orderdate + INTERVAL 1 DAY AS offense_date_dup_1,
    o_orderkey AS case_number FROM orders""",
)
def p5(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderdate AS offense_date",
        "o_orderdate + INTERVAL 1 DAY AS case_charge_offense_date",
        "o_orderkey AS case_number",
    )
    return normalize.rename(rows)


@query(
    "p6_enforce_schema",
    """SELECT CAST(o_orderkey AS VARCHAR) AS case_number,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate + INTERVAL 9 HOUR END AS hearing_date,
    CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_active,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END AS locality_code,
    o_totalprice AS extra, CAST(NULL AS VARCHAR) AS commenced_by FROM orders""",
)
def p6(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS case_number",
        """CASE WHEN o_orderpriority = '5-LOW' THEN 'pending'
             ELSE date_format(o_orderdate + INTERVAL 9 HOUR, 'MM/dd/yyyy, hh:mm a') END AS hearing_date""",
        "CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' ELSE 'T' END AS is_active",
        """CASE WHEN o_orderpriority = '1-URGENT' THEN concat('x', o_custkey)
             ELSE cast(o_custkey AS string) END AS locality_code""",
        "o_totalprice AS extra",
    )
    wanted = ("case_number", "hearing_date", "is_active", "locality_code", "commenced_by")
    core = T.StructType([f for f in normalize.GOLDEN_SCHEMA if f.name in wanted])
    return normalize.enforce_schema(rows, core)


@query(
    "p7_boolean_map",
    """SELECT l_returnflag, l_linestatus, CASE l_returnflag WHEN 'A' THEN TRUE WHEN 'N' THEN FALSE END AS as_flag,
    l_linestatus = 'O' AS from_bool, count(*) AS n FROM lineitem GROUP BY 1, 2, 3, 4""",
)
def p7(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        scalars.yn_to_bool(F.expr("CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'false' ELSE 'T' END")).alias("as_flag"),
        scalars.yn_to_bool(F.col("l_linestatus") == "O").alias("from_bool"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p8_parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS as_date,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate + INTERVAL 13 HOUR END AS as_ts FROM orders""",
)
def p8(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.parse_date(
            F.expr("""CASE WHEN o_orderpriority = '5-LOW' THEN date_format(o_orderdate, 'yyyyMMdd')
                        ELSE date_format(o_orderdate, 'M/d/yyyy') END""")
        ).alias("as_date"),
        dates.parse_ts(
            F.expr("""CASE WHEN o_orderpriority = '1-URGENT' THEN date_format(o_orderdate, 'MM/dd/yyyy')
                        ELSE date_format(o_orderdate + INTERVAL 13 HOUR, 'MM/dd/yyyy, hh:mm a') END""")
        ).alias("as_ts"),
    )


@query(
    "p9_safe_cast",
    """SELECT p_partkey, TRY_CAST(CASE WHEN p_type = 'ECONOMY' THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS BIGINT)
    AS size, p_type = 'ECONOMY' AS failed FROM part""",
)
def p9(spark, sf):
    text = F.expr("CASE WHEN p_type = 'ECONOMY' THEN 'n/a' ELSE cast(p_size AS string) END")
    return table(spark, sf, "part").select(
        "p_partkey",
        scalars.safe_cast(text, "bigint").alias("size"),
        scalars.cast_failed(text, "bigint").alias("failed"),
    )


@query(
    "p10_complex_to_json",
    """SELECT p_partkey, '["' || p_brand || '","' || p_type || '"]' AS tags,
    '{"size":' || p_size || ',"note":null}' AS facts FROM part""",
)
def p10(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "array(p_brand, p_type) AS tags",
        "named_struct('size', p_size, 'note', cast(NULL AS string)) AS facts",
    )
    return jsontext.complex_to_json(rows)


@query("p11_null_column_to_string", "SELECT s_suppkey, CAST(NULL AS VARCHAR) AS remark FROM supplier")
def p11(spark, sf):
    return normalize.null_cols_to_string(table(spark, sf, "supplier").select("s_suppkey", F.lit(None).alias("remark")))


@query(
    "p12_null_values",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN NULL ELSE c_mktsegment END AS segment,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance FROM customer""",
)
def p12(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        scalars.normalize_nulls(F.col("c_mktsegment"), ["HOUSEHOLD", "FURNITURE"], None).alias("segment"),
        scalars.nan_to_null(F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))).alias("balance"),
    )


@query(
    "p13_parse_json_text",
    """SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL
    WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
    event_type = 'signup' AS kept_as_text FROM events""",
)
def p13(spark, sf):
    text = F.expr(
        """CASE event_type WHEN 'signup' THEN concat('note ', props)
             WHEN 'view' THEN translate(props, '"', "'")
             WHEN 'error' THEN "{'k': None, 'seen': True}" ELSE props END"""
    )
    rows = table(spark, sf, "events").select("event_id", text.alias("t"))
    loose = jsontext.parse_json_text(F.col("t"))
    return rows.select(
        "event_id",
        jsontext.parse_json_text(F.col("t"), "k bigint")["k"].alias("k"),
        (F.schema_of_variant(loose) == "STRING").alias("kept_as_text"),
    )


@query("p14_hash_names", "SELECT c_custkey, sha256(c_name) AS name_hash FROM customer")
def p14(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", hashing.hash_text(F.col("c_name")).alias("name_hash"))


@query(
    "p15_hash_in_array",
    f"""WITH {RECORDS_SQL}, p AS (SELECT "caseNumber", 'WIT' AS role, sha256(s_name) AS participant_hash FROM r
    UNION ALL SELECT "caseNumber", CASE WHEN first_is_def THEN 'DEF' ELSE 'CMP' END, sha256(name) FROM r
    UNION ALL SELECT "caseNumber", CASE WHEN second_is_def THEN 'DEF' ELSE 'WIT' END, NULL FROM r)
    SELECT "caseNumber", role, participant_hash, count(*) AS n FROM p GROUP BY 1, 2, 3""",
)
def p15(spark, sf):
    hashed = hashing.hash_in_array(
        F.col("caseParticipant"),
        "contactInformation.personName.fullName",
        {"role": "participantCode", "race": "personalDetails.race"},
        "participant_hash",
    )
    people = records(spark, sf, by_case=True).select("caseNumber", F.inline(hashed))
    return people.groupBy("caseNumber", "role", "participant_hash").agg(F.count(F.lit(1)).alias("n"))


@query("p16_lineage_column", "SELECT n_nationkey, n_name, 'hashed_sha256' AS anonymization_method FROM nation")
def p16(spark, sf):
    rows = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return hashing.with_lineage(rows, "anonymization_method", silver.ANONYMIZATION)


@query(
    "p17_silver_layer",
    f"""WITH {LATEST_SQL} SELECT "qualifiedFips", 'C' AS "courtLevel", "divisionType", "caseNumber",
    'CR-' || "caseNumber" AS "formattedCaseNumber", sha256(name) AS defendant_name_hash, offense_date,
    "chargeAmended", "codeSection", "chargeDesc", "divisionType" AS "caseType", hearing_timestamp, locality_name,
    sha256(s_name) AS first_hash, 3 AS participants, fine_amount, disposition_text,
    'hashed_sha256' AS anonymization_method FROM d""",
)
def p17(spark, sf):
    people = F.col("participants_anonymized")
    # nested columns are shown by some of their parts
    return silver.to_silver(records(spark, sf, by_case=True)).select(
        "*",
        people[0]["participant_hash"].alias("first_hash"),
        F.size(people).cast("int").alias("participants"),
        F.col("financialInformation.fines.amount.decimal").alias("fine_amount"),
        F.col("disposition.dispositionInfo.dispositionText").alias("disposition_text"),
    ).drop("participants_anonymized", "financialInformation", "caseHearing", "disposition")


@query(
    "p18_labels",
    H + """SELECT "caseNumber", CASE WHEN attorney_type IS NOT NULL THEN 'Attorney' ELSE 'No Attorney' END AS label,
    CASE WHEN disposition_text = 'F' THEN 1 ELSE 0 END AS flag, count(*) AS n FROM h GROUP BY 1, 2, 3""",
)
def p18(spark, sf):
    rows = hearings(spark, sf).select(
        "caseNumber",
        scalars.label_when(F.col("attorney_type").isNotNull(), "Attorney", "No Attorney").alias("label"),
        F.when(F.col("disposition_text") == "F", 1).otherwise(0).alias("flag"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p19_dismissal_flag",
    H + "SELECT coalesce(disposition_text = 'F', FALSE) AS is_dismissed, count(*) AS n FROM h GROUP BY 1",
)
def p19(spark, sf):
    flag = scalars.is_code(F.col("disposition_text"), "F").alias("is_dismissed")
    return hearings(spark, sf).groupBy(flag).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p20_disposition_fields",
    R + """SELECT "caseNumber", "codeSection", disposition_text AS "dispositionText",
    disposition_date AS "dispositionDate" FROM r""",
)
def p20(spark, sf):
    return silver.disposition_fields(records(spark, sf)).select(
        "caseNumber", "codeSection", "dispositionText", "dispositionDate"
    )


@query(
    "p21_days_to_disposition",
    R + """SELECT "caseNumber", CASE WHEN date_diff('day', offense_date, disposition_date) >= 0
    THEN date_diff('day', offense_date, disposition_date) END AS "daysToDisposition" FROM r""",
)
def p21(spark, sf):
    return features(spark, sf).select("caseNumber", "daysToDisposition")


@query(
    "p22_net_sentence_days",
    R + """SELECT "caseNumber", CAST(net_sentence_days AS BIGINT) AS "netSentenceDays" FROM r""",
)
def p22(spark, sf):
    return features(spark, sf).select("caseNumber", "netSentenceDays")


@query("p23_total_financial", R + """SELECT "caseNumber", round(total_financial, 4) AS "totalFinancial" FROM r""")
def p23(spark, sf):
    return features(spark, sf).select("caseNumber", F.round("totalFinancial", 4).alias("totalFinancial"))


@query("p24_first_defendant", R + """SELECT "caseNumber", race, gender FROM r""")
def p24(spark, sf):
    who = cases.first_defendant(F.col("caseParticipant"))
    return records(spark, sf).select("caseNumber", who["race"].alias("race"), who["gender"].alias("gender"))


@query("p25_attorney_type", R + """SELECT attorney_type, count(*) AS n FROM r GROUP BY 1""")
def p25(spark, sf):
    return features(spark, sf).groupBy(F.col("attorneyType").alias("attorney_type")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p26_top_n_or_other",
    """WITH top AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)
    SELECT CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand ELSE 'Other' END AS p_brand, p_type,
    count(*) AS n FROM part GROUP BY 1, 2""",
)
def p26(spark, sf):
    reduced = model.top_n_or_other(table(spark, sf, "part"), "p_brand")
    return reduced.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p27_urls_and_paths",
    f"""SELECT o_orderkey, '{scalars.CASE_URL}' || o_custkey || o_orderstatus || o_orderkey AS url,
    'output/' || strftime(o_orderdate, '%Y/%m/%d') || '.jsonl' AS path FROM orders""",
)
def p27(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        scalars.case_url(F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_orderkey")).alias("url"),
        dates.date_path(F.col("o_orderdate")).alias("path"),
    )


@query(
    "p28_flat_view",
    R + """SELECT "caseNumber", locality_name, "chargeDesc", disposition_text, race, gender, attorney_type, fine_amount,
    offense_date, hearing_timestamp FROM r""",
)
def p28(spark, sf):
    return silver.to_flat_view(records(spark, sf)).drop("participants")


@query(
    "p29_unnest",
    """SELECT p_partkey, p_brand AS element FROM part WHERE p_type <> 'ECONOMY'
    UNION ALL SELECT p_partkey, p_name FROM part WHERE p_type <> 'ECONOMY'""",
)
def p29(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey", "CASE WHEN p_type <> 'ECONOMY' THEN array(p_brand, p_name) END AS words"
    )
    return silver.unnest(rows, "words")


@query(
    "p30_date_list",
    """SELECT date, count(*) AS open_cases FROM (SELECT unnest(generate_series(CAST(o_orderdate AS DATE),
    CAST(o_orderdate AS DATE) + (l_linenumber - 3), INTERVAL 1 DAY))::DATE AS date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1""",
)
def p30(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    start = F.col("o_orderdate").cast("date")
    days = dates.dates_in_range(start, F.date_add(start, F.col("l_linenumber") - 3))
    return rows.select(F.explode(days).alias("date")).groupBy("date").agg(F.count(F.lit(1)).alias("open_cases"))


@query(
    "p31_flatten_lists",
    """SELECT word, count(*) AS n FROM (SELECT p_brand AS word FROM part UNION ALL SELECT p_type FROM part
    UNION ALL SELECT p_name FROM part WHERE p_size > 25) GROUP BY 1""",
)
def p31(spark, sf):
    lists = F.expr("array(array(p_brand, p_type), CASE WHEN p_size > 25 THEN array(p_name) END)")
    flat = table(spark, sf, "part").select(F.explode(scalars.flatten_lists(lists)).alias("word"))
    return flat.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --- predicates -------------------------------------------------------------------------------


@query("f1_not_null", H + """SELECT race, count(*) AS n FROM h WHERE race IS NOT NULL AND fine_amount IS NOT NULL GROUP BY 1""")
def f1(spark, sf):
    return hearings(spark, sf).dropna(subset=["race", "fine_amount"]).groupBy("race").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f2_comparisons",
    H + """SELECT gender, count(*) AS n FROM h WHERE disposition_text = 'F' AND race <> 'MACHINERY' AND fine_amount > 0
    GROUP BY 1""",
)
def f2(spark, sf):
    rows = hearings(spark, sf).filter(
        (F.col("disposition_text") == "F") & (F.col("race") != "MACHINERY") & (F.col("fine_amount") > 0)
    )
    return rows.groupBy("gender").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f3_in_list",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def f3(spark, sf):
    rows = table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return rows.select("o_orderkey", "o_orderpriority")


@query(
    "f4_in_subquery",
    """SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_custkey IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""",
)
def f4(spark, sf):
    return spark.sql(
        """SELECT o_orderstatus, count(*) AS n FROM {orders} WHERE o_custkey IN
           (SELECT c_custkey FROM {customer} WHERE c_mktsegment = 'BUILDING') GROUP BY 1""",
        orders=table(spark, sf, "orders"),
        customer=table(spark, sf, "customer"),
    )


@query("f5_having", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 70")
def f5(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).filter("n > 70")


@query(
    "f6_computed_filter",
    """SELECT p_type, round(p_retailprice * 2, 2) AS doubled FROM part WHERE round(p_retailprice * 2, 2) > 2000""",
)
def f6(spark, sf):
    doubled = F.round(F.col("p_retailprice") * 2, 2)
    return table(spark, sf, "part").filter(doubled > 2000).select("p_type", doubled.alias("doubled"))


@query("f7_substring", "SELECT p_partkey, p_name FROM part WHERE contains(upper(p_name), 'RING')")
def f7(spark, sf):
    return table(spark, sf, "part").filter(F.upper("p_name").contains("RING")).select("p_partkey", "p_name")
