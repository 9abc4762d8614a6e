"""Tests, model (M1–M7, T3) and plot-ready aggregates (G1–G6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.frames import HEARINGS_SQL as H, RECORDS_SQL, hearings, joined, table
from entry_queries.registry import query
from entry_queries.shapes import features
from stratalake.operators import model, plotdata, stats
from stratalake.plans import analysis

FEATURES = ["o_orderpriority", "c_mktsegment", "n_name"]


def _round(df, *cols, digits=6):
    for c in cols:
        df = df.withColumn(c, F.round(c, digits))
    return df


@query(
    "m1_chi_square",
    H + """, t AS (SELECT race, coalesce(disposition_text = 'F', FALSE) AS f FROM h WHERE race IN
      (SELECT race FROM h WHERE race IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, race LIMIT 3)),
    c AS (SELECT race, f, count(*) AS o FROM t GROUP BY 1, 2),
    e AS (SELECT o, sum(o) OVER (PARTITION BY race) * sum(o) OVER (PARTITION BY f) / CAST(sum(o) OVER () AS DOUBLE) AS e
      FROM c), s AS (SELECT sum((o - e) * (o - e) / e) AS x, sum(o) AS n FROM e)
    SELECT round(x, 6) AS statistic, CAST(2 AS BIGINT) AS dof, CAST(n AS BIGINT) AS n, round(exp(-x / 2), 6) AS p_value,
    exp(-x / 2) < 0.05 AS significant FROM s""",
)
def m1(spark, sf):
    rows = hearings(spark, sf).withColumn("f", F.coalesce(F.col("disposition_text") == "F", F.lit(False)))
    return _round(stats.chi_square(rows, "race", "f", top=3), "statistic", "p_value")


@query(
    "m2_mann_whitney",
    f"""WITH {RECORDS_SQL}, x AS (SELECT CAST(net_sentence_days AS DOUBLE) AS v,
      attorney_type = 'Public Defender' AS f FROM r WHERE net_sentence_days > 0 AND attorney_type IS NOT NULL),
    k AS (SELECT v, f, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS mid,
      count(*) OVER (PARTITION BY v) AS t FROM x),
    s AS (SELECT CAST(count(*) FILTER (f) AS DOUBLE) AS n1, CAST(count(*) FILTER (NOT f) AS DOUBLE) AS n2,
      sum(mid) FILTER (f) AS r1, sum(CAST(t AS DOUBLE) * t - 1) AS ties FROM k),
    u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u1,
      sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS sigma FROM s),
    w AS (SELECT *, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / sigma AS w FROM u),
    -- the normal tail as the series of its odd powers over double factorials
    p AS (SELECT *, CASE WHEN w <= 0 THEN 1 WHEN w > 9 THEN 0 ELSE greatest(0, 1 - 2 * exp(-w * w / 2) / sqrt(2 * pi())
      * (SELECT sum(exp((2 * k + 1) * ln(w) - (k + 1) * ln(2) - lgamma(k + 1.5) + ln(pi()) / 2)) FROM range(400) r(k))) END AS p FROM w)
    SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, u1, n1 * n2 - u1 AS u2, ties AS tie_term,
    round(sigma, 4) AS sigma, round((greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / sigma, 6) AS z,
    (SELECT median(v) FROM x WHERE f) AS median_first, (SELECT median(v) FROM x WHERE NOT f) AS median_other,
    round(p, 6) AS p_value, CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END AS verdict FROM p""",
)
def m2(spark, sf):
    rows = features(spark, sf).filter("netSentenceDays > 0")
    out = stats.mann_whitney(rows, "attorneyType", "netSentenceDays", "Public Defender")
    return _round(_round(out, "z", "p_value"), "sigma", digits=4)


@query(
    "m3_one_hot",
    """SELECT o_orderkey, CAST(o_orderstatus = 'O' AS DOUBLE) AS "o_orderstatus_O",
    CAST(o_orderstatus = 'P' AS DOUBLE) AS "o_orderstatus_P" FROM orders""",
)
def m3(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    levels = model.categories(rows, ["o_orderstatus"])
    return model.one_hot_drop_first(rows, levels).drop("o_orderstatus")


def _model_rows(spark, sf):
    rows = joined(spark, sf).withColumn("is_dismissed", F.col("o_orderstatus") == "F")
    return model.prepare(rows, FEATURES, "is_dismissed", ["n_name"])


def _fitted(spark, sf):
    split = model.split_combinations(_model_rows(spark, sf), "is_dismissed")
    return split, model.fit_logistic(split, FEATURES, "is_dismissed", "n_train")


@query("m4_logistic_scores")
def m4(spark, sf):
    split, fitted = _fitted(spark, sf)
    return fitted.predict(split).select(*FEATURES, "is_dismissed", "prediction", F.round("probability_true", 6).alias("p"))


@query(
    "m5_stratified_split",
    """WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_orderstatus, TRUE AS is_train, CAST(round(n * 0.8) AS BIGINT) AS n FROM c
    UNION ALL SELECT o_orderstatus, FALSE, n - CAST(round(n * 0.8) AS BIGINT) FROM c""",
)
def m5(spark, sf):
    split = model.stratified_split(table(spark, sf, "orders"), "o_orderstatus", ["o_orderkey"])
    return split.groupBy("o_orderstatus", "is_train").agg(F.count(F.lit(1)).alias("n"))


@query("m6_accuracy_vs_majority")
def m6(spark, sf):
    split, fitted = _fitted(spark, sf)
    scored = fitted.predict(split.filter("n_test > 0"))
    return model.accuracy_vs_majority(scored, "is_dismissed", fitted.majority, weight="n_test")


@query("m7_odds_ratios")
def m7(spark, sf):
    split, fitted = _fitted(spark, sf)
    return model.odds_ratios(fitted, split)


@query("t3_sorted_odds")
def t3(spark, sf):
    return m7(spark, sf).orderBy(F.desc("odds_ratio"))


@query(
    "g1_histogram",
    """WITH e AS (SELECT min(l_quantity) AS lo, (max(l_quantity) - min(l_quantity)) / 7 AS w FROM lineitem),
    c AS (SELECT least(floor((l_quantity - lo) / w), 6) AS bin, count(*) AS n FROM lineitem, e GROUP BY 1)
    SELECT CAST(i AS BIGINT) AS bin, round(lo + i * w, 6) AS low, round(lo + (i + 1) * w, 6) AS high,
    coalesce(n, 0) AS count FROM range(7) t(i) CROSS JOIN e LEFT JOIN c ON bin = i""",
)
def g1(spark, sf):
    return _round(plotdata.histogram(table(spark, sf, "lineitem"), "l_quantity", 7), "low", "high")


BOX = """q AS (SELECT {g} quantile_cont(c_acctbal, 0.25) AS q1, median(c_acctbal) AS median,
      quantile_cont(c_acctbal, 0.75) AS q3 FROM customer {by}),
    j AS (SELECT customer.*, q1, median, q3, c_acctbal BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
      FROM customer JOIN q {on})
    SELECT {g} round(min(q1), 6) AS q1, round(min(median), 6) AS median, round(min(q3), 6) AS q3,
    min(c_acctbal) FILTER (ok) AS whisker_low, max(c_acctbal) FILTER (ok) AS whisker_high,
    count(*) FILTER (NOT ok) AS outliers, round(avg(c_acctbal), 6) AS mean FROM j {by}"""


@query("g2_box_stats", "WITH " + BOX.format(g="", by="", on="ON TRUE"))
def g2(spark, sf):
    return _round(plotdata.box_stats(table(spark, sf, "customer"), "c_acctbal"), "q1", "median", "q3", "mean")


@query(
    "g3_density",
    """WITH e AS (SELECT min(l_quantity) AS lo, (max(l_quantity) - min(l_quantity)) / 199 AS step, count(*) AS n,
      stddev_samp(l_quantity) * pow(count(*), -0.2) AS w FROM lineitem),
    v AS (SELECT l_quantity AS v, count(*) AS c FROM lineitem GROUP BY 1)
    SELECT round(lo + i * step, 6) AS x, round(sum(c * exp(-pow((lo + i * step - v) / w, 2) / 2))
      / (any_value(n) * any_value(w) * sqrt(2 * pi())), 8) AS density FROM range(200) t(i), e, v GROUP BY i, lo, step""",
)
def g3(spark, sf):
    return _round(_round(plotdata.density(table(spark, sf, "lineitem"), "l_quantity"), "x"), "density", digits=8)


@query(
    "g4_box_stats_by_group",
    "WITH " + BOX.format(g="c_mktsegment,", by="GROUP BY c_mktsegment", on="USING (c_mktsegment)"),
)
def g4(spark, sf):
    boxes = plotdata.box_stats_by(table(spark, sf, "customer"), "c_mktsegment", "c_acctbal")
    return _round(boxes, "q1", "median", "q3", "mean")


@query(
    "g5_percent_crosstab",
    """SELECT o_orderpriority, round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS "F",
    round(100.0 * count(*) FILTER (o_orderstatus = 'O') / count(*), 6) AS "O",
    round(100.0 * count(*) FILTER (o_orderstatus = 'P') / count(*), 6) AS "P" FROM orders GROUP BY 1""",
)
def g5(spark, sf):
    wide = plotdata.percent_crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])
    return _round(wide, "F", "O", "P")


@query("g6_odds_direction")
def g6(spark, sf):
    return model.odds_with_direction(m7(spark, sf))


@query("m8_dismissal_analysis")
def m8(spark, sf):
    rows = _model_rows(spark, sf)
    return analysis.fit_dismissal_model(rows, FEATURES, "is_dismissed", [])["odds_ratios"]
