"""Row numbers and running totals that no single hot key can push into one task.

A plain ``row_number`` over a partition sends all rows of a key to one task. Here the rows are
first cut into ranges; they are numbered within (key, range) and the sizes
of the earlier ranges are added. The result equals the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stratalake.session import cut_lineage

# a sort of this many rows fits one task easily
RANGE_ROWS = 1_000_000
BUCKET = "_bucket"


def default_ranges(df: DataFrame) -> int:
    """Ranges that follow the row count, and at least one per core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, df.count() // RANGE_ROWS + 1)


def _common_prefix(df: DataFrame, name: str) -> int:
    low, high = df.agg(F.min(name), F.max(name)).first()
    if low is None:
        return 0
    a, b = low.encode(), high.encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def order_position(df: DataFrame, name: str) -> Column:
    """A double that never decreases as the column grows."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.StringType):
        # six bytes after the prefix all values share, read as one number
        raw = F.substring(F.encode(col, "utf-8"), _common_prefix(df, name) + 1, 6)
        return F.conv(F.rpad(F.hex(raw), 12, "0"), 16, 10).cast("double")
    raise TypeError(f"cannot order by {kind.simpleString()}")


def range_bounds(df: DataFrame, position: Column, ranges: int) -> list[float]:
    """Upper bounds of about equally filled ranges: one aggregate, at most ``ranges`` doubles."""
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(position, shares, 10000)).first()[0]
    return sorted(set(found or []))


def with_ranges(df: DataFrame, position: Column, bounds: Sequence[float]) -> DataFrame:
    """Add the number of the range each row falls into; nulls go to a last range."""
    if not bounds:
        return df.withColumn(BUCKET, F.when(position.isNull(), F.lit(1)).otherwise(F.lit(0)).cast("int"))
    inner = [b for b in bounds]
    splits = [float("-inf"), *inner, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_position", outputCol=BUCKET, handleInvalid="keep")
    numbered = cut.transform(df.withColumn("_position", position)).drop("_position")
    return numbered.withColumn(BUCKET, F.coalesce(F.col(BUCKET), F.lit(float(len(splits)))).cast("int"))


def _range_key(group: Sequence[str]) -> Column:
    # a struct compares null parts as equal, so null groups join and shuffle like any other
    return F.struct(*[F.col(c) for c in group], F.col(BUCKET))


def offsets(bucketed: DataFrame, group: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Totals of all earlier ranges of the same group, one row per (group, range).

    The window sees at most one row per range and group, never the data rows.
    """
    sizes = bucketed.groupBy(*group, BUCKET).agg(*[total.alias(name) for name, total in sums.items()])
    earlier = Window.partitionBy(*group).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        _range_key(group).alias("_range"),
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}") for name in sums],
    )


def numbered(
    df: DataFrame,
    partition: Sequence[str],
    order: str,
    tiebreak: Sequence[str] = (),
    name: str = "row_number",
    ranges: int | None = None,
) -> DataFrame:
    """``row_number() OVER (PARTITION BY partition ORDER BY order, tiebreak)``, nulls last.

    Rows are dealt into ranges of (partition, order, tiebreak) and stored with their range, so a
    hot key is split even where all its rows share one order value but not the tie-break.
    """
    sorting = [F.col(c).asc_nulls_last() for c in [*partition, order, *tiebreak]]
    dealt = df.repartitionByRange(ranges or default_ranges(df), *sorting).withColumn(BUCKET, F.spark_partition_id())
    # stored: a range computed anew could be cut elsewhere
    return number_bucketed(cut_lineage(dealt), partition, [order, *tiebreak], name).select(*df.columns, name)


def number_bucketed(
    bucketed: DataFrame, partition: Sequence[str], order: Sequence[str], name: str = "row_number"
) -> DataFrame:
    """Row numbers where all groups are large and the rows already carry a range number."""
    before = offsets(bucketed, partition, {"n": F.count(F.lit(1))})
    within = Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        bucketed.withColumn("_range", _range_key(partition))
        .join(before, "_range")
        .withColumn(name, (F.col("_before_n") + F.row_number().over(within)).cast("bigint"))
        .drop("_range", "_before_n", BUCKET)
    )


def running(
    df: DataFrame, value: str, sums: Sequence[str], group: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Running totals before each row in the order of ``value`` (unique within a group).

    Adds ``before_<column>`` for every column of ``sums``.
    """
    position = order_position(df, value)
    bucketed = with_ranges(df, position, range_bounds(df, position, ranges or default_ranges(df)))
    before = offsets(bucketed, group, {c: F.sum(c) for c in sums})
    within = (
        Window.partitionBy("_range").orderBy(F.col(value).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        bucketed.withColumn("_range", _range_key(group))
        .join(before, "_range")
        .select(
            *df.columns,
            *[
                (F.col(f"_before_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(f"before_{c}")
                for c in sums
            ],
        )
    )
