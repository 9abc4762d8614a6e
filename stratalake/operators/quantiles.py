"""Exact, linearly interpolated quantiles and rank sums over any number of distinct values.

Doubles are ordered by the bits of their representation, read as one number. Counts per value are
rolled up to histograms over the leading bits: 24, then 20 more, then the last 20. The bucket
that holds a rank is found in the coarsest histogram and refined twice, for all groups and
probabilities at once. A bucket has at most 2^20 parts, so no window grows with the data,
and one plan serves tables of every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.session import cut_lineage

# bits that follow a bucket's prefix, at each level of refinement
SHIFTS = (40, 20, 0)
LEVELS = ["_b1", "_b2", "_b3"]


def ordered_bits(value: Column) -> Column:
    """A long that orders doubles as their values do; NaN comes last."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value).cast("long")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit((1 << 63) - 1)))


def with_buckets(counts: DataFrame) -> DataFrame:
    """Add the bucket of ``value`` at every level."""
    rows = counts.withColumn("_bits", ordered_bits(F.col("value")))
    return rows.withColumns({b: F.shiftright("_bits", s) for b, s in zip(LEVELS, SHIFTS)}).drop("_bits")


def value_table(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values with their frequency; counts are combined before the shuffle."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def counted_values(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """The value table with its buckets, materialised so that the rows are read once."""
    return cut_lineage(with_buckets(value_table(df, value, group)))


def _rolled_up(rows: DataFrame, group: list[str], sums: Sequence[str]) -> list[DataFrame]:
    """Histograms from the coarsest to the single values."""
    found = [rows]
    for depth in (2, 1):
        found.insert(0, found[0].groupBy(*group, *LEVELS[:depth]).agg(*[F.sum(c).alias(c) for c in sums]))
    return found


def _before(n: str, group: list[str], depth: int) -> Column:
    """Count of the earlier parts of the bucket a part lies in."""
    order = Window.partitionBy(*(group + LEVELS[: depth - 1] or [F.lit(0)])).orderBy(LEVELS[depth - 1])
    return F.coalesce(F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def quantiles_of(counts: DataFrame, probs: dict[str, float], group: Sequence[str] = (), higher: bool = False) -> DataFrame:
    """Quantiles of a value table with buckets: one row per group, a column per named probability.

    Where a rank falls between two values it is interpolated, or with ``higher`` the upper one is taken.
    """
    # a struct key makes null groups join like any other
    rows = counts.select(F.struct(*group).alias("_g") if group else F.lit(0).alias("_g"), "value", "n", *LEVELS)
    histograms = _rolled_up(rows, ["_g"], ["n"])
    totals = histograms[0].groupBy("_g").agg(F.sum("n").alias("_total"))
    ends = []
    for name, p in probs.items():
        rank = (F.col("_total") - 1) * F.lit(float(p))
        ends += [
            F.struct(F.lit(f"{side}_{name}").alias("_name"), cut(rank).cast("long").alias("_rank"), (rank - F.floor(rank)).alias("_part"))
            for side, cut in (("low", F.floor), ("high", F.ceil))
        ]
    wanted = totals.select("_g", F.inline(F.array(*ends)))
    for depth, table in enumerate(histograms, 1):
        key = ["_g", *LEVELS[: depth - 1]]
        if depth > 1:
            table = table.join(wanted.select(*key).distinct(), key)
        parts = table.withColumn("_before", _before("n", ["_g"], depth))
        value = ["value"] if depth == len(LEVELS) else []
        inside = (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("n"))
        wanted = wanted.join(parts, key).filter(inside)
        wanted = wanted.select("_g", *LEVELS[:depth], "_name", (F.col("_rank") - F.col("_before")).alias("_rank"), "_part", *value)

    def found(name: str, column: str) -> Column:
        return F.max(F.when(F.col("_name") == name, F.col(column)))

    picks = []
    for name in probs:
        low, high, part = found(f"low_{name}", "value"), found(f"high_{name}", "value"), found(f"low_{name}", "_part")
        picks.append((high if higher else low + (high - low) * part).alias(name))
    return wanted.groupBy("_g").agg(*picks).select(*[F.col(f"_g.`{c}`").alias(c) for c in group], *probs)


def mid_rank_sum(counts: DataFrame, n: str, total: str) -> DataFrame:
    """One row ``rank_sum``: the mid-ranks of all values, weighted by ``n``; ``total`` counts all rows of a value.

    The count below a value is that of the earlier parts at every level, so each level adds its
    own share of the sum.
    """
    shares = None
    for depth, table in enumerate(_rolled_up(counts.select(n, total, *LEVELS), [], [n, total]), 1):
        below = F.col("_before").cast("double")
        if depth == len(LEVELS):
            below = below + (F.col(total) + 1) / 2
        share = table.withColumn("_before", _before(total, [], depth)).agg(F.sum(F.col(n) * below).alias("_share"))
        shares = share if shares is None else shares.unionByName(share)
    return shares.agg(F.sum("_share").alias("rank_sum"))


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], group: Sequence[str] = ()) -> DataFrame:
    """One row per group with a column per named probability."""
    return quantiles_of(counted_values(df, value, group), probs, group)
