"""Deduplication and per-entity sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.operators.ranking import numbered

BATCH_SIZE = 300


def latest_per_key(
    df: DataFrame, key: Sequence[str], order: str | Column, tiebreak: Sequence[Column] = ()
) -> DataFrame:
    """The row with the greatest order value per key; null keys compare equal.

    Spark keeps one row per key in every input partition before the shuffle
    (``WindowGroupLimit``), so a key with very many copies moves little data.
    """
    order = F.col(order) if isinstance(order, str) else order
    newest = Window.partitionBy(*key).orderBy(order.desc_nulls_last(), *tiebreak)
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def mean_gap_days(df: DataFrame, key: Sequence[str], date: str, name: str = "mean_gap_days") -> DataFrame:
    """Mean days between consecutive dates per key, null below two dates.

    The gaps add up to last minus first, so no sort is needed.
    """
    day = F.col(date).cast("date")
    span = F.datediff(F.max(day), F.min(day))
    n = F.count(day)
    return df.groupBy(*key).agg(F.when(n >= 2, span / (n - 1)).alias(name))


def latest_record(df: DataFrame, key: Sequence[str], date: str, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Chronologically last record per key."""
    return latest_per_key(df, key, date, tiebreak)


def assign_batches(
    df: DataFrame,
    partition: Sequence[str],
    order: str,
    size: int = BATCH_SIZE,
    tiebreak: Sequence[str] = (),
    name: str = "batch",
) -> DataFrame:
    """Number the chunks of ``size`` rows within each partition, in order, from 0."""
    ranked = numbered(df, partition, order, tiebreak, name="_position_in_day")
    return ranked.withColumn(name, F.floor((F.col("_position_in_day") - 1) / size).cast("bigint")).drop(
        "_position_in_day"
    )


def ordered_children(
    df: DataFrame,
    key: Sequence[str],
    order: str,
    tiebreak: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Child rows with their place in the parent's order, from 1.

    One row per child instead of one array per parent: an entity with very many children
    stays spread over tasks.
    """
    return numbered(df, key, order, tiebreak, name)
