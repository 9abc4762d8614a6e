"""Mixing sources to target weights (operator 7), in DataFrame functions only.

Sources in code-point order (null last) get the weights 1, 2, 3 in turn and share all words;
no source's target exceeds three times its size, the excess goes to the others by weight. Each
source is put in the order of hash-random keys: keys fall into equally wide ranges, words are
summed per range, the sums are added up within the source, and running sums inside each range
complete the distributed prefix sum. A source is taken in whole epochs while its target allows,
then up to the exact word at which the budget is used up.

A range holds about ``RANGE_ROWS`` rows of a source, so a source with a third of all rows is cut
into many ranges. Only keys and sizes are shuffled for it: what the rows need is the place of the order at
which their source's last epoch ends, one row per source. Null texts have size 0 and are taken 0 times. Keys decide the order: the md5 of
the doc_id, then size; rows equal in both are alike in the result. Without any word all targets
are 0. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm.common import word_count
from stratalake.session import keep

CYCLE = 3  # weights 1, 2, 3, 1, 2, 3, ...
MOST = 3  # times its size
RANGE_ROWS = 50_000
PREFIX = 8  # hexadecimal digits of the key that choose its range


def targets(sizes: DataFrame) -> DataFrame:
    """``_source``, ``source_size``, ``target`` from ``_source`` and ``source_size`` (one row each).

    With caps c and weights w, the shares are min(c, w * level). In order of c / w the sources
    before some place are at their cap; the level of the others follows from what these leave.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    rows = sizes.withColumn("_weight", ((F.row_number().over(by_name) - 1) % CYCLE + 1).cast("double"))
    rows = rows.withColumn("_cap", F.lit(float(MOST)) * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    here = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    capped = F.coalesce(F.sum("_cap").over(here), F.lit(0.0))
    level = (F.sum("source_size").over(every) - capped) / F.sum("_weight").over(rest)
    rows = rows.withColumn("_level", level)
    # levels rise while the place's own source would be over its cap and fall afterwards: the
    # highest is that of the first source under its cap
    target = F.least(F.col("_cap"), F.col("_weight") * F.max("_level").over(every))
    return rows.select("_source", "source_size", target.alias("target"))


def random_key(key: Column) -> Column:
    return F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``key``, ``source``, ``size``, ``source_size``, ``target``, ``taken`` (and ``carry``) of each row.

    ``taken`` counts repeats: whole epochs times size, plus the words used of the last epoch.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(source).alias("_source"), word_count(F.col(text)).alias("size"), *[F.col(c).alias(f"_carry_{c}") for c in carry or []])
    rows = keep(rows.withColumn("_random", random_key(F.col("_key"))), "sizes")
    sizes = rows.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    goal = targets(sizes.select("_source", "source_size")).withColumnRenamed("_source", "_name")
    plan = goal.join(sizes.select(F.col("_source").alias("_s"), "_rows"), F.col("_name").eqNullSafe(F.col("_s"))).drop("_s")
    plan = plan.withColumn("_budget", F.round("target").cast("long")).withColumn("_ranges", F.ceil(F.col("_rows") / RANGE_ROWS))
    plan = keep(plan.drop("_rows"), "plan")
    fraction = F.conv(F.substring("_random", 1, PREFIX), 16, 10).cast("double") / 16.0**PREFIX
    placed = rows.select("_source", "_random", "size").join(plan, F.col("_source").eqNullSafe(F.col("_name")))
    placed = placed.withColumn("_range", F.floor(fraction * F.col("_ranges")))
    # rows equal in key and size are one place of the order
    places = keep(placed.groupBy("_name", "_range", "_random", "size").agg((F.count(F.lit(1)) * F.col("size")).alias("_words")), "places")
    # sums of the ranges before each range of a source
    sums = places.groupBy("_name", "_range").agg(F.sum("_words").alias("_sum"))
    earlier = Window.partitionBy("_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_name").alias("_n"), F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_name", "_range").orderBy("_random", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = places.withColumn("_upto", F.sum("_words").over(inside))
    places = places.join(sums, F.col("_name").eqNullSafe(F.col("_n")) & (F.col("_range") == F.col("_r")))
    places = places.select(F.col("_name").alias("_s"), F.struct("_random", "size").alias("_place"), (F.col("_offset") + F.col("_upto")).alias("_end"), "_words")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("_budget") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumns({"_epochs": epochs, "_left": F.col("_budget") - epochs * F.col("source_size")}).drop("_ranges")
    # one row per source: the first place that its last epoch does not take whole
    ends = places.join(plan.select("_name", "_left"), F.col("_s").eqNullSafe(F.col("_name"))).where("_end > _left")
    ends = ends.groupBy("_s").agg(F.min("_place").alias("_place"), F.min_by(F.col("_end") - F.col("_words"), "_place").alias("_start"))
    plan = keep(plan.join(ends, F.col("_name").eqNullSafe(F.col("_s")), "left").drop("_s"), "ends")
    placed = rows.join(plan, F.col("_source").eqNullSafe(F.col("_name")))
    here = F.struct("_random", "size")
    at_end = F.coalesce(here == F.col("_place"), F.lit(False))
    whole = placed.where(~at_end).withColumn("_last", F.when(here > F.col("_place"), F.lit(0)).otherwise(F.col("size")))
    # only rows of that place share what is left
    nth = F.row_number().over(Window.partitionBy("_name").orderBy(F.xxhash64(*[c for c in rows.columns if c.startswith("_carry_")], "_key")))
    shared = placed.where(at_end).withColumn("_before", F.col("_start") + (nth - 1) * F.col("size"))
    shared = shared.withColumn("_last", F.least(F.greatest(F.col("_left") - F.col("_before"), F.lit(0)), F.col("size"))).drop("_before")
    placed = whole.unionByName(shared)
    return placed.select(
        F.col("_key").alias(key),
        F.col("_source").alias(source),
        "size",
        "source_size",
        "target",
        (F.col("_epochs") * F.col("size") + F.col("_last")).cast("long").alias("taken"),
        *[F.col(f"_carry_{c}").alias(c) for c in carry or []],
    )
