"""Connected components of a link table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.session import keep


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root``: every linked node with the smallest node it reaches.

    Large-star and small-star steps by turns: each node's neighbours are tied to the smallest of
    them until every tie leads to a root. The number of rounds grows with the logarithm of the
    longest chain; a node with very many neighbours costs one combined minimum. Null ends and
    ties of a node to itself are left out; no links give no rows.
    """
    ends = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    ties = keep(ends.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b"))).distinct(), "ties")
    state = None
    while True:
        both = ties.unionByName(ties.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
        first = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(first, "a").select(F.when(F.col("b") == F.col("_m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("_m").alias("b"))
        ties = keep(small.where("a != b").distinct(), "ties")
        now = ties.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return ties.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                ties.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now
