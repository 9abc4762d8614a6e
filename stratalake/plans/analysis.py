"""The exploratory report set and the statistical analysis."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratalake.functions.cases import PUBLIC_DEFENDER
from stratalake.functions.scalars import is_code
from stratalake.operators import aggregates as agg, model as m, stats
from stratalake.plans.silver import add_features
from stratalake.sources.files import has_input, scan_jsonl_tolerant
from stratalake.sources.schemas import whole_schema

MEASURES = ("daysToDisposition", "netSentenceDays", "totalFinancial")
MODEL_FEATURES = ("race", "gender", "attorneyType", "codeSection")
REDUCED = ("race", "codeSection")
LABEL = "is_dismissed"


def eda_reports(flat: DataFrame, min_count: int = 100) -> dict[str, DataFrame]:
    """The ten reports over the flat view."""
    profile = agg.charge_profile(flat)
    return {
        "total_cases": agg.total_rows(flat),
        "top_localities": agg.top_values(flat, "locality_name"),
        "outcomes": agg.value_share(flat, "disposition_text", "disposition_text"),
        "participant_roles": agg.role_counts(flat, "participants", "participantCode"),
        "dismissal_by_race": agg.dismissal_rate_by(flat, min_count=min_count),
        "fines": agg.fine_distribution(flat),
        "weekdays": agg.busiest_weekdays(flat),
        "days_to_hearing": agg.days_to_hearing_by_charge(flat, min_count=min_count),
        "representation": agg.representation_share(flat),
        "charge_profile": agg.pivot_counts(profile, "chargeDesc", "disposition_text"),
    }


def load_case_features(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Feature frame of one JSON-lines file; a missing file ends with code 1, an empty one with 0.

    Without a schema all fields of the data are kept.
    """
    if not has_input(spark, path):
        sys.exit(1)
    if schema is None:
        schema = whole_schema(spark.read.text(path))
    good, _ = scan_jsonl_tolerant(spark, path, schema)
    if good.isEmpty():
        sys.exit(0)
    return add_features(good)


def analyse(features: DataFrame) -> dict[str, DataFrame | None]:
    """Descriptive statistics, both hypothesis tests and the odds-ratio model."""
    rows = features.withColumn(LABEL, is_code(F.col("dispositionText")))
    majors = stats.major_groups(rows, "race")
    sentenced = rows.filter(F.col("netSentenceDays") > 0)
    out = {
        "descriptive": stats.describe_measures(rows, MEASURES),
        "race_by_dismissal": stats.crosstab(majors, "race", LABEL, [False, True]),
        "chi_square": stats.chi_square(rows, "race", LABEL, top=3),
        "mann_whitney": stats.mann_whitney(sentenced, "attorneyType", "netSentenceDays", PUBLIC_DEFENDER),
    }
    out.update(fit_dismissal_model(rows))
    return out


def fit_dismissal_model(
    rows: DataFrame, features=MODEL_FEATURES, label: str = LABEL, reduce=REDUCED
) -> dict[str, DataFrame | None]:
    """Split, fit, compare with the majority class and list the odds ratios.

    From the split on, the data is a table of category combinations with row counts.
    """
    prepared = m.prepare(rows, features, label, reduce)
    split = m.split_combinations(prepared, label)
    n = split.agg(F.sum(F.col("n_train") + F.col("n_test"))).first()[0] or 0
    fitted = m.fit_logistic(split, features, label, "n_train") if n >= m.MIN_ROWS else None
    if fitted is None:
        return {"accuracy": None, "odds_ratios": None}
    scored = fitted.predict(split.filter("n_test > 0"))
    return {
        "accuracy": m.accuracy_vs_majority(scored, label, fitted.majority, weight="n_test"),
        "odds_ratios": m.odds_with_direction(m.odds_ratios(fitted, rows)),
    }
