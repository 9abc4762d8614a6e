"""Aggregation queries (A1–A23) over the hearings frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.frames import HEARINGS_SQL as H, RECORDS_SQL, hearings, records
from entry_queries.registry import query
from entry_queries.shapes import features
from stratalake.functions.scalars import is_code
from stratalake.operators import aggregates as agg, stats

R6 = 6


@query(
    "a1_monthly_locality_summary",
    H + """SELECT locality_name, date_trunc('month', hearing_timestamp)::TIMESTAMP AS month, count(*) AS case_count,
    avg(fine_amount) AS avg_fine, count(DISTINCT "caseNumber") AS distinct_cases FROM h GROUP BY 1, 2""",
)
def a1(spark, sf):
    return agg.monthly_locality_summary(hearings(spark, sf), fine="fine_amount")


@query(
    "a2_charge_outcome_profile",
    H + """SELECT "chargeDesc", disposition_text, count(*) AS case_count FROM h GROUP BY 1, 2""",
)
def a2(spark, sf):
    return agg.charge_outcome_profile(hearings(spark, sf), disposition="disposition_text")


@query(
    "a3_locality_efficiency",
    H + """SELECT locality_name, round(avg(date_diff('day', offense_date, hearing_timestamp::DATE)), 6)
    AS avg_days_to_hearing FROM h WHERE offense_date IS NOT NULL GROUP BY 1""",
)
def a3(spark, sf):
    out = agg.locality_efficiency(hearings(spark, sf))
    return out.withColumn("avg_days_to_hearing", F.round("avg_days_to_hearing", R6))


@query(
    "a4_day_of_week_summary",
    H + """SELECT dayname(hearing_timestamp) AS day_name, dayofweek(hearing_timestamp) AS day_index,
    count(*) AS hearing_count FROM h WHERE hearing_timestamp IS NOT NULL GROUP BY 1, 2 ORDER BY 2""",
)
def a4(spark, sf):
    return agg.day_of_week_summary(hearings(spark, sf))


@query(
    "a5_disposition_summary",
    H + """SELECT disposition_text, count(*) AS count FROM h WHERE disposition_text IS NOT NULL
    GROUP BY 1 ORDER BY 2 DESC""",
)
def a5(spark, sf):
    return agg.disposition_summary(hearings(spark, sf), "disposition_text")


@query(
    "a6_hearings_per_case",
    H + """SELECT num_hearings, count(*) AS cases_with_this_count FROM
    (SELECT "caseNumber", count(*) AS num_hearings FROM h GROUP BY 1) GROUP BY 1 ORDER BY 1""",
)
def a6(spark, sf):
    return agg.hearings_per_case_distribution(hearings(spark, sf))


@query("a7_total_rows", H + "SELECT count(*) AS total_cases FROM h")
def a7(spark, sf):
    return agg.total_rows(hearings(spark, sf))


@query(
    "a8_top_localities",
    H + "SELECT locality_name, count(*) AS count FROM h GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def a8(spark, sf):
    return agg.top_values(hearings(spark, sf), "locality_name", 10)


@query(
    "a9_outcome_share",
    H + """SELECT disposition_text, count(*) AS count,
    round(count(*) * 100 / CAST((SELECT count(*) FROM h) AS DOUBLE), 2) AS percentage FROM h GROUP BY 1""",
)
def a9(spark, sf):
    return agg.value_share(hearings(spark, sf), "disposition_text", "disposition_text")


@query(
    "a10_participant_roles",
    f"""WITH {RECORDS_SQL} SELECT role, count(*) AS count FROM (
    SELECT 'WIT' AS role FROM r UNION ALL
    SELECT CASE WHEN first_is_def THEN 'DEF' ELSE 'CMP' END FROM r UNION ALL
    SELECT CASE WHEN second_is_def THEN 'DEF' ELSE 'WIT' END FROM r) GROUP BY 1""",
)
def a10(spark, sf):
    return agg.role_counts(records(spark, sf), "caseParticipant", "participantCode")


@query(
    "a11_dismissal_rate_by_race",
    H + """SELECT race, count(*) AS total_cases,
    round(avg(CASE WHEN disposition_text = 'F' THEN 1 ELSE 0 END) * 100, 2) AS dismissal_rate
    FROM h WHERE race IS NOT NULL GROUP BY 1 HAVING count(*) > 100 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def a11(spark, sf):
    return agg.dismissal_rate_by(hearings(spark, sf), code="F")


@query(
    "a12_fine_distribution",
    H + """SELECT min(fine_amount) AS min_fine, max(fine_amount) AS max_fine, avg(fine_amount) AS avg_fine,
    round(median(fine_amount), 6) AS median_fine FROM h WHERE fine_amount > 0""",
)
def a12(spark, sf):
    out = agg.fine_distribution(hearings(spark, sf))
    return out.withColumn("median_fine", F.round("median_fine", R6))


@query(
    "a13_busiest_weekdays",
    H + """SELECT dayname(hearing_timestamp) AS weekday, dayofweek(hearing_timestamp) AS dow,
    round(count(*) / CAST(count(DISTINCT hearing_timestamp::DATE) AS DOUBLE), 0) AS avg_cases
    FROM h WHERE hearing_timestamp IS NOT NULL GROUP BY 1, 2 ORDER BY 2""",
)
def a13(spark, sf):
    return agg.busiest_weekdays(hearings(spark, sf))


@query(
    "a14_days_to_hearing_by_charge",
    H + """SELECT "chargeDesc", count(*) AS count,
    round(avg(date_diff('day', offense_date, hearing_timestamp::DATE)), 1) AS avg_days
    FROM h WHERE offense_date IS NOT NULL GROUP BY 1 HAVING count(*) > 100 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def a14(spark, sf):
    return agg.days_to_hearing_by_charge(hearings(spark, sf))


@query(
    "a15_representation_share",
    H + """SELECT CASE WHEN attorney_type IS NOT NULL THEN 'Attorney' ELSE 'No Attorney' END AS representation,
    count(*) AS count, round(count(*) * 100 / CAST((SELECT count(*) FROM h) AS DOUBLE), 2) AS percentage
    FROM h GROUP BY 1""",
)
def a15(spark, sf):
    return agg.representation_share(hearings(spark, sf))


TOP_CHARGES = """, top AS (SELECT "codeSection" FROM r GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)"""


@query(
    "a16_charge_profile",
    f"""WITH {RECORDS_SQL}{TOP_CHARGES} SELECT "codeSection", disposition_text, count(*) AS count FROM r
    WHERE "codeSection" IN (SELECT "codeSection" FROM top) GROUP BY 1, 2""",
)
def a16(spark, sf):
    rows = records(spark, sf).select(
        "codeSection", F.col("disposition.dispositionInfo.dispositionText").alias("disposition_text")
    )
    return agg.charge_profile(rows, "codeSection")


@query(
    "a17_charge_profile_matrix",
    f"""WITH {RECORDS_SQL}{TOP_CHARGES} SELECT "codeSection",
    count(*) FILTER (disposition_text = 'F') AS "F", count(*) FILTER (disposition_text = 'O') AS "O",
    count(*) FILTER (disposition_text IS NULL) AS "null" FROM r
    WHERE "codeSection" IN (SELECT "codeSection" FROM top) GROUP BY 1""",
)
def a17(spark, sf):
    return agg.pivot_counts(a16(spark, sf), "codeSection", "disposition_text", ["F", "O", None])


@query(
    "a18_dismissal_rate",
    H + """SELECT count(*) AS total_cases, count(*) FILTER (disposition_text = 'F') AS dismissed,
    CASE WHEN count(*) > 0 THEN round(100.0 * count(*) FILTER (disposition_text = 'F') / CAST(count(*) AS DOUBLE), 6)
    ELSE 0.0 END AS dismissal_rate FROM h""",
)
def a18(spark, sf):
    out = agg.dismissal_rate(hearings(spark, sf), "disposition_text", "F")
    return out.withColumn("dismissal_rate", F.round("dismissal_rate", R6))


@query(
    "a19_top_charges",
    H + """SELECT "chargeDesc" AS charge, count(*) AS count FROM h GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def a19(spark, sf):
    rows = hearings(spark, sf).withColumnRenamed("chargeDesc", "charge")
    return agg.top_values(rows, "charge", 10)


DESCRIBE = """SELECT '{c}' AS measure, count({c}) AS n, round(avg({c}), 6) AS mean, round(median({c}), 6) AS median,
    round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.75), 6) AS q3,
    round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr, round(skewness({c}), 6) AS skew FROM h"""


@query(
    "a20_descriptive_stats",
    H + " UNION ALL ".join(DESCRIBE.format(c=c) for c in ("l_quantity", "l_extendedprice", "c_acctbal")),
)
def a20(spark, sf):
    out = stats.describe_measures(hearings(spark, sf), ["l_quantity", "l_extendedprice", "c_acctbal"])
    return out.select(
        "measure", "n", *[F.round(c, R6).alias(c) for c in ("mean", "median", "q1", "q3", "iqr", "skew")]
    )


@query(
    "a21_value_counts",
    H + "SELECT race, count(*) AS count FROM h WHERE race IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
)
def a21(spark, sf):
    return stats.value_counts(hearings(spark, sf), "race", 3)


@query(
    "a22_crosstab",
    H + """SELECT race, round(100.0 * count(*) FILTER (coalesce(disposition_text, '') <> 'F') / count(*), 6) AS "false",
    round(100.0 * count(*) FILTER (disposition_text = 'F') / count(*), 6) AS "true"
    FROM h WHERE race IS NOT NULL GROUP BY 1""",
)
def a22(spark, sf):
    rows = hearings(spark, sf).withColumn("is_dismissed", is_code(F.col("disposition_text"), "F"))
    wide = stats.crosstab(rows, "race", "is_dismissed", [False, True], normalize=True, sort_by="true")
    return wide.select("race", F.round("false", R6).alias("false"), F.round("true", R6).alias("true"))


@query(
    "a23_group_median",
    f"""WITH {RECORDS_SQL} SELECT attorney_type, round(median(net_sentence_days), 6) AS median FROM r
    WHERE net_sentence_days > 0 GROUP BY 1""",
)
def a23(spark, sf):
    rows = features(spark, sf).filter("netSentenceDays > 0")
    out = stats.group_median(rows.withColumnRenamed("attorneyType", "attorney_type"), "attorney_type", "netSentenceDays")
    return out.withColumn("median", F.round("median", R6))
