"""Aggregates ready to draw. Only bins, boxes and grid points leave the cluster."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratalake.operators.quantiles import counted_values, exact_quantiles, quantiles_of, value_table
from stratalake.operators.stats import QUARTILES, crosstab

WHISKER = 1.5
GRID = 200


def _extent(df: DataFrame, col: str):
    value = F.col(col).cast("double")
    return df.agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n"), F.stddev_samp(value).alias("sd")
    ).first()


def auto_bins(df: DataFrame, col: str) -> int:
    """Bin count by the 'auto' rule: the narrower of the Freedman-Diaconis and Sturges widths."""
    e = _extent(df, col)
    if not e.n or e.high == e.low:
        return 1
    q = exact_quantiles(df, col, {"q1": 0.25, "q3": 0.75}).first()
    sturges = (e.high - e.low) / (math.log2(e.n) + 1)
    spread = 2 * (q.q3 - q.q1) / e.n ** (1 / 3)
    width = min(spread, sturges) if spread else sturges
    return max(1, math.ceil((e.high - e.low) / width))


def histogram(df: DataFrame, col: str, bins: int | None = None) -> DataFrame:
    """Equal-width bins with counts, empty bins included; the last bin is closed."""
    bins = bins or auto_bins(df, col)
    e = _extent(df, col)
    if not e.n:
        return df.sparkSession.createDataFrame([], "bin bigint, low double, high double, count bigint")
    width = (e.high - e.low) / bins or 1.0
    place = F.least(F.floor((F.col(col).cast("double") - e.low) / width), F.lit(bins - 1)).cast("bigint")
    counts = df.filter(F.col(col).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    axis = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return axis.join(counts, "bin", "left").select(
        "bin",
        (F.lit(e.low) + F.col("bin") * width).alias("low"),
        (F.lit(e.low) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def box_stats_by(df: DataFrame, group: str | None, col: str) -> DataFrame:
    """Quartiles, whiskers within 1.5 IQR, outliers and mean, per group or over all rows."""
    keys = [group] if group else []
    counts = counted_values(df, col, keys)
    boxes = quantiles_of(counts, QUARTILES, keys)
    box = F.struct("q1", "median", "q3").alias("_box")
    if group:
        # struct keys let a null group keep its box
        joined = counts.withColumn("_key", F.struct(group)).join(
            boxes.select(F.struct(group).alias("_key"), box), "_key"
        )
    else:
        joined = counts.withColumn("_box", boxes.select(box).scalar())
    iqr = F.col("_box.q3") - F.col("_box.q1")
    low, high = F.col("_box.q1") - WHISKER * iqr, F.col("_box.q3") + WHISKER * iqr
    value, n = F.col("value"), F.col("n")
    inside = value.between(low, high)
    stats = joined.groupBy(*keys).agg(
        F.first("_box").alias("_box"),
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(n)).cast("bigint").alias("outliers"),
        (F.sum(value * n) / F.sum(n)).alias("mean"),
    )
    return stats.select(
        *keys, F.col("_box.q1"), F.col("_box.median"), F.col("_box.q3"), "whisker_low", "whisker_high", "outliers", "mean"
    )


def box_stats(df: DataFrame, col: str) -> DataFrame:
    return box_stats_by(df, None, col)


def density(df: DataFrame, col: str, grid: int = GRID) -> DataFrame:
    """Gaussian density estimate (Scott's bandwidth) on an even grid over the data's range.

    Each distinct value adds its weight to every grid point; sums are combined before the
    shuffle, which carries at most ``grid`` rows per task.
    """
    e = _extent(df, col)
    if not e.n or e.n < 2 or not e.sd:
        return df.sparkSession.createDataFrame([], "x double, density double")
    width = e.sd * e.n ** (-1 / 5)
    step = (e.high - e.low) / (grid - 1)
    points = F.transform(F.sequence(F.lit(0), F.lit(grid - 1)), lambda i: F.lit(e.low) + i * step)
    z = (F.col("x") - F.col("value")) / width
    scale = 1 / (e.n * width * math.sqrt(2 * math.pi))
    spread = value_table(df, col).select("value", "n", F.posexplode(points).alias("point", "x"))
    return (
        spread.groupBy("point", "x")
        .agg((F.sum(F.col("n") * F.exp(-z * z / 2)) * scale).alias("density"))
        .select("x", "density")
    )


def percent_crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None, sort_by: str | None = None) -> DataFrame:
    """Row percentages for stacked bars."""
    return crosstab(df, a, b, values, normalize=True, sort_by=sort_by)
