"""Grouped aggregates: the gold tables and the exploratory reports.

Column names are parameters with the silver layout as default, so the same code runs on
any table with these roles. Every aggregate is combined before its shuffle; distinct counts
shuffle on (group, value) first, so a group holding a third of the rows stays spread out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions.dates import day_index, day_name, days_between, month_start
from stratalake.operators.quantiles import counted_values, quantiles_of
from stratalake.session import cut_lineage

FINE = "financialInformation.fines.amount.decimal"
DISPOSITION = "disposition.dispositionInfo.dispositionText"


def _n() -> Column:
    return F.count(F.lit(1))


def _share(n: Column, total: Column) -> Column:
    return F.round(n * 100 / total.cast("double"), 2)


# --- gold tables ---------------------------------------------------------------------------


def monthly_locality_summary(
    df: DataFrame,
    locality: str = "locality_name",
    ts: str = "hearing_timestamp",
    fine: str = FINE,
    case: str = "caseNumber",
) -> DataFrame:
    """Volume, mean fine and distinct cases by locality and month; nulls form groups."""
    return df.groupBy(F.col(locality).alias("locality_name"), month_start(F.col(ts)).alias("month")).agg(
        _n().alias("case_count"),
        F.avg(fine).alias("avg_fine"),
        F.countDistinct(case).alias("distinct_cases"),
    )


def charge_outcome_profile(df: DataFrame, charge: str = "chargeDesc", disposition: str = DISPOSITION) -> DataFrame:
    """Charge × disposition counts; nulls form groups."""
    return df.groupBy(F.col(charge).alias("chargeDesc"), F.col(disposition).alias("disposition_text")).agg(
        _n().alias("case_count")
    )


def locality_efficiency(
    df: DataFrame,
    locality: str = "locality_name",
    start: str = "offense_date",
    ts: str = "hearing_timestamp",
) -> DataFrame:
    """Mean days from offence to hearing; negative gaps count."""
    return (
        df.filter(F.col(start).isNotNull())
        .groupBy(F.col(locality).alias("locality_name"))
        .agg(F.avg(days_between(F.col(start), F.col(ts))).alias("avg_days_to_hearing"))
    )


def day_of_week_summary(df: DataFrame, ts: str = "hearing_timestamp") -> DataFrame:
    """Hearings per weekday, Sunday first."""
    when = F.col(ts)
    return (
        df.filter(when.isNotNull())
        .groupBy(day_name(when).alias("day_name"), day_index(when).alias("day_index"))
        .agg(_n().alias("hearing_count"))
        .orderBy("day_index")
    )


def disposition_summary(df: DataFrame, disposition: str = DISPOSITION) -> DataFrame:
    """Known dispositions by volume."""
    text = F.col(disposition)
    return (
        df.filter(text.isNotNull())
        .groupBy(text.alias("disposition_text"))
        .agg(_n().alias("count"))
        .orderBy(F.desc("count"), "disposition_text")
    )


def hearings_per_case_distribution(df: DataFrame, case: str = "caseNumber") -> DataFrame:
    """How many cases have 1, 2, … hearings; a null case number is one case."""
    per_case = df.groupBy(case).agg(_n().alias("num_hearings"))
    return per_case.groupBy("num_hearings").agg(_n().alias("cases_with_this_count")).orderBy("num_hearings")


GOLD_TABLES = {
    "monthly_locality_summary": monthly_locality_summary,
    "charge_outcome_profile": charge_outcome_profile,
    "locality_efficiency": locality_efficiency,
    "day_of_week_summary": day_of_week_summary,
    "disposition_summary": disposition_summary,
    "hearings_per_case_distribution": hearings_per_case_distribution,
}


# --- reports over the flat view ---------------------------------------------------------------


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(_n().alias("total_cases"))


def top_values(df: DataFrame, col: str, n: int = 10, name: str = "count") -> DataFrame:
    """The n most frequent values, null included; ties go to the smaller value."""
    return (
        df.groupBy(col)
        .agg(_n().alias(name))
        .orderBy(F.desc(name), F.col(col).asc_nulls_last())
        .limit(n)
    )


def value_share(df: DataFrame, col: str | Column, name: str) -> DataFrame:
    """Count and percentage of all rows per value, null included.

    The total is a scalar subquery over the counts: Spark reuses their shuffle, so the rows
    are read once.
    """
    col = F.col(col) if isinstance(col, str) else col
    counts = df.groupBy(col.alias(name)).agg(_n().alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(name, "count", _share(F.col("count"), total).alias("percentage")).orderBy(
        F.desc("count"), F.col(name).asc_nulls_last()
    )


def role_counts(df: DataFrame, array: str = "participants", role: str = "role") -> DataFrame:
    """Participants per role; rows without participants drop out."""
    return (
        df.select(F.explode(F.col(array)).alias("p"))
        .groupBy(F.col(f"p.{role}").alias("role"))
        .agg(_n().alias("count"))
        .orderBy(F.desc("count"), F.col("role").asc_nulls_last())
    )


def dismissal_rate_by(
    df: DataFrame,
    group: str = "race",
    disposition: str = "disposition_text",
    code: str = "D",
    min_count: int = 100,
    n: int = 10,
) -> DataFrame:
    """Share of dismissed cases for the largest groups with more than ``min_count`` rows."""
    dismissed = F.when(F.col(disposition) == code, 1).otherwise(0)
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(_n().alias("total_cases"), F.round(F.avg(dismissed) * 100, 2).alias("dismissal_rate"))
        .filter(F.col("total_cases") > min_count)
        .orderBy(F.desc("total_cases"), group)
        .limit(n)
    )


def fine_distribution(df: DataFrame, fine: str = "fine_amount") -> DataFrame:
    """Minimum, maximum, mean and exact median of positive fines."""
    counts = counted_values(df.filter(F.col(fine) > 0), fine)
    median = quantiles_of(counts, {"median_fine": 0.5})
    return counts.agg(
        F.min("value").alias("min_fine"),
        F.max("value").alias("max_fine"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("avg_fine"),
    ).withColumn("median_fine", median.scalar())


def busiest_weekdays(df: DataFrame, ts: str = "hearing_timestamp") -> DataFrame:
    """Mean hearings per calendar day, by weekday.

    Days are counted first, so only (day, count) rows reach the second aggregate.
    """
    per_day = df.filter(F.col(ts).isNotNull()).groupBy(F.col(ts).cast("date").alias("day")).agg(_n().alias("n"))
    return (
        per_day.groupBy(day_name(F.col("day")).alias("weekday"), day_index(F.col("day")).alias("dow"))
        .agg(F.round(F.sum("n") / _n(), 0).alias("avg_cases"))
        .orderBy("dow")
    )


def days_to_hearing_by_charge(
    df: DataFrame,
    charge: str = "chargeDesc",
    start: str = "offense_date",
    ts: str = "hearing_timestamp",
    min_count: int = 100,
    n: int = 10,
) -> DataFrame:
    """Mean days from offence to hearing for the most frequent charges."""
    return (
        df.filter(F.col(start).isNotNull())
        .groupBy(charge)
        .agg(
            _n().alias("count"),
            F.round(F.avg(days_between(F.col(start), F.col(ts))), 1).alias("avg_days"),
        )
        .filter(F.col("count") > min_count)
        .orderBy(F.desc("count"), F.col(charge).asc_nulls_last())
        .limit(n)
    )


def representation_share(df: DataFrame, attorney: str = "attorney_type") -> DataFrame:
    """Cases with and without an attorney."""
    label = F.when(F.col(attorney).isNotNull(), "Attorney").otherwise("No Attorney")
    return value_share(df, label, "representation")


def charge_profile(
    df: DataFrame, charge: str = "chargeDesc", disposition: str = "disposition_text", n: int = 5
) -> DataFrame:
    """Disposition counts of the n most frequent charges.

    Both steps work on the (charge, disposition) counts, which are materialised: else the
    optimizer pushes the semi join to the rows and reads them twice. The n charge names are
    the only broadcast data.
    """
    counts = cut_lineage(df.groupBy(charge, disposition).agg(_n().alias("count")))
    top = (
        counts.groupBy(charge)
        .agg(F.sum("count").alias("_total"))
        .orderBy(F.desc("_total"), F.col(charge).asc_nulls_last())
        .limit(n)
        .select(charge)
    )
    return counts.join(F.broadcast(top), charge, "left_semi").orderBy(
        charge, F.desc("count"), F.col(disposition).asc_nulls_last()
    )


def pivot_counts(
    counts: DataFrame, row: str, column: str, values: Sequence[str | None] | None = None, count: str = "count"
) -> DataFrame:
    """Counts as a matrix, missing cells 0. A null category is the column ``null``."""
    wide = counts.groupBy(row).pivot(column, list(values) if values is not None else None).agg(F.sum(count))
    return wide.na.fill(0)


def dismissal_rate(df: DataFrame, disposition: str = "dispositionText", code: str = "D") -> DataFrame:
    """Dashboard numbers: total, dismissed and percentage, 0 on an empty table."""
    total, dismissed = _n(), F.count_if(F.col(disposition) == code)
    return df.agg(total.alias("total_cases"), dismissed.alias("dismissed")).withColumn(
        "dismissal_rate",
        F.when(F.col("total_cases") > 0, F.col("dismissed") * 100.0 / F.col("total_cases").cast("double")).otherwise(
            F.lit(0.0)
        ),
    )
