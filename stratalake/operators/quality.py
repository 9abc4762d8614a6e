"""Row, key and reference audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def assert_rows(df: DataFrame, rules: dict[str, Column], key: Sequence[str]) -> DataFrame:
    """One row per broken rule and record. A predicate that is unknown is not broken."""
    broken = F.array_compact(F.array(*[F.when(~ok, F.lit(rule)) for rule, ok in rules.items()]))
    return df.select(F.explode(broken).alias("rule"), *key)


def count_by_rule(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a null part is never a duplicate, as in
    a unique constraint."""
    complete = df.dropna(subset=list(key))
    return complete.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def fk_violations(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign keys without a parent and null foreign keys, with the rows they hold.

    Keys are counted first, so a frequent key is one row in the join.
    """
    keys = child.groupBy(F.col(fk).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    orphans = keys.filter(F.col("key").isNotNull()).join(
        parent.select(F.col(pk).alias("key")), "key", "left_anti"
    )
    nulls = keys.filter(F.col("key").isNull())
    return orphans.select("key", "rows", F.lit("missing parent").alias("reason")).unionByName(
        nulls.select("key", "rows", F.lit("null key").alias("reason"))
    )


def column_violations(df: DataFrame, not_null: Sequence[str] = (), max_len: dict[str, int] | None = None) -> DataFrame:
    """Violation count per column rule, from a single pass."""
    checks = [(c, "not null", F.count_if(F.col(c).isNull())) for c in not_null]
    checks += [(c, f"max length {n}", F.count_if(F.length(c) > n)) for c, n in (max_len or {}).items()]
    counted = df.agg(*[expr.alias(f"_{i}") for i, (_, _, expr) in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations"))
            for i, (c, rule, _) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


def propagate_delete(
    deleted: DataFrame,
    key: str,
    cascade: dict[str, tuple[DataFrame, str]],
    restrict: dict[str, tuple[DataFrame, str]] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Children that remain once ``deleted`` parents are gone, and the deletes to refuse.

    ``cascade`` and ``restrict`` map a child name to (frame, foreign key). The second result
    lists the deleted keys still used by a restricting child.
    """
    keys = deleted.select(F.col(key)).distinct()
    kept = {
        name: child.join(keys.withColumnRenamed(key, fk), fk, "left_anti").select(*child.columns)
        for name, (child, fk) in cascade.items()
    }
    blocked = None
    for name, (child, fk) in (restrict or {}).items():
        used = keys.join(child.select(F.col(fk).alias(key)), key, "left_semi").withColumn("used_by", F.lit(name))
        blocked = used if blocked is None else blocked.unionByName(used)
    return kept, blocked


def failure_summary(df: DataFrame, keys: Sequence[str], failed_col: str) -> DataFrame:
    """Rows written and failed per key."""
    failed = F.count_if(F.col(failed_col))
    return df.groupBy(*keys).agg((F.count(F.lit(1)) - failed).alias("written"), failed.alias("failed"))
