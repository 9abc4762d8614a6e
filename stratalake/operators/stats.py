"""Descriptive statistics and hypothesis tests, built from aggregated counts."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from stratalake.operators.aggregates import top_values
from stratalake.operators.quantiles import LEVELS, counted_values, exact_quantiles, mid_rank_sum, quantiles_of, with_buckets
from stratalake.session import cut_lineage

ALPHA = 0.05
MIN_GROUP = 5
# scipy's rule: exact distribution when a group is this small and nothing is tied
EXACT_GROUP = 8
PERIOD = 840  # least common multiple of 1 to 8
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def sample_skewness(n: Column, m2: Column, m3: Column) -> Column:
    """Bias-corrected skewness from the sums of squared and cubed deviations.

    Null below three values and for constant data.
    """
    population = F.sqrt(n) * m3 / F.pow(m2, 1.5)
    return F.when((n >= 3) & (m2 > 0), population * F.sqrt(n * (n - 1)) / (n - 2))


def describe_measures(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, quartiles, IQR and skewness per measure over its known values.

    All measures are handled in the same jobs: the rows are read once, into counts per
    (measure, value). A measure without values gives no row.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in cols])
    counts = counted_values(df.select(F.inline(pairs)), "value", ["measure"])
    n, value = F.col("n"), F.col("value")
    means = counts.groupBy("measure").agg((F.sum(n * value) / F.sum(n)).alias("mean")).collect()
    mean = F.lit(None).cast("double")
    for row in means:  # one row per measure
        mean = F.when(F.col("measure") == row.measure, F.lit(row.mean)).otherwise(mean)
    gap = value - mean
    moments = counts.groupBy("measure").agg(
        F.sum(n).alias("n"),
        F.max(mean).alias("mean"),
        F.sum(n * gap * gap).alias("_m2"),
        F.sum(n * gap * gap * gap).alias("_m3"),
    )
    quartiles = quantiles_of(counts, QUARTILES, ["measure"])
    return moments.join(quartiles, "measure").select(
        "measure",
        "n",
        "mean",
        "median",
        "q1",
        "q3",
        (F.col("q3") - F.col("q1")).alias("iqr"),
        sample_skewness(F.col("n"), F.col("_m2"), F.col("_m3")).alias("skew"),
    )


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Counts per known value, largest first; ``n`` asks for the top-n report."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    ordered = counts.orderBy(F.desc("count"), col)
    return ordered.limit(n) if n else ordered


def crosstab(
    df: DataFrame,
    a: str,
    b: str,
    values: Sequence | None = None,
    normalize: bool = False,
    sort_by: str | None = None,
) -> DataFrame:
    """Counts of a × b as a matrix, or row percentages; null categories drop out."""
    counts = df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    wide = counts.groupBy(a).pivot(b, list(values) if values is not None else None).agg(F.sum("n")).na.fill(0)
    cells = [c for c in wide.columns if c != a]
    if normalize:
        row_total = sum((F.col(f"`{c}`") for c in cells), F.lit(0))
        wide = wide.select(a, *[(F.col(f"`{c}`") * 100 / row_total).alias(c) for c in cells])
    return wide.orderBy(F.col(f"`{sort_by}`"), a) if sort_by else wide


def group_median(df: DataFrame, group: str, measure: str, name: str = "median") -> DataFrame:
    """Exact median per group."""
    return exact_quantiles(df, measure, {name: 0.5}, [group])


# --- tail probabilities ---------------------------------------------------------------------------


def _chi_square_tail(x: float, dof: int) -> float:
    """P(X > x) for an integer number of degrees of freedom, by the finite series."""
    half = x / 2
    if dof < 1 or half <= 0:
        return 1.0
    # terms half^(j + s) / gamma(j + s + 1), in logarithms: none under- or overflows
    shift, start = (0.0, 0.0) if dof % 2 == 0 else (0.5, math.erfc(math.sqrt(half)))
    logs = [(j + shift) * math.log(half) - half - math.lgamma(j + shift + 1) for j in range(dof // 2)]
    return min(1.0, start + math.fsum(math.exp(v) for v in logs))


def _exact_rank_tail(u: float, n1: int, n2: int) -> float:
    """P(U >= u) without ties, the smaller group having at most eight values.

    Counts with U up to a bound are a coefficient of prod(1 - q^(m+i)) / ((1 - q) prod(1 - q^i)).
    Every factor below divides 1 - q^840, so few whole numbers suffice at any group size.
    """
    few, many = sorted((n1, n2))
    series = [1]
    for step in (1, *range(1, few + 1)):  # times (1 - q^840) / (1 - q^step)
        series = [*series, *[0] * PERIOD]
        for i in range(len(series) - 1, PERIOD - 1, -1):
            series[i] -= series[i - PERIOD]
        for i in range(step, len(series)):
            series[i] += series[i - step]
    shifts = {0: 1}
    for i in range(1, few + 1):
        moved = {shift + many + i: -sign for shift, sign in shifts.items()}
        shifts = {s: shifts.get(s, 0) + moved.get(s, 0) for s in shifts.keys() | moved.keys()}
    top = n1 * n2 - math.ceil(u)  # P(U >= u) = P(U <= n1·n2 - u)
    ways = 0
    for shift, sign in shifts.items():
        at = top - shift
        for r in range(at % PERIOD, min(at + 1, len(series)), PERIOD):
            ways += sign * series[r] * math.comb((at - r) // PERIOD + few, few)
    return ways / math.comb(n1 + n2, few)


def _rank_sum_p(row: Row) -> float | None:
    if row.u1 is None:
        return None
    exact = min(row.n1, row.n2) <= EXACT_GROUP
    if exact and row.tie_term == 0:
        return min(1.0, 2 * _exact_rank_tail(max(row.u1, row.u2), row.n1, row.n2))
    return min(1.0, math.erfc(row.z / math.sqrt(2)))


def _with_result(one: DataFrame, name: str, tail: Callable[[Row], float | None]) -> DataFrame:
    """Add a tail probability to a one-row result; only that row visits the driver."""
    row = one.first()
    schema = T.StructType([*one.schema.fields, T.StructField(name, T.DoubleType())])
    return one.sparkSession.createDataFrame([(*row, tail(row))], schema)


# --- tests ----------------------------------------------------------------------------------------


def chi_square(
    df: DataFrame, a: str, b: str, correction: bool = True, top: int | None = None
) -> DataFrame:
    """Independence test on the a × b counts: one row with statistic, dof and p.

    ``top`` compares only the most frequent groups of ``a``.

    Works from the cells that occur: with r and c the margins and N the total,
    Σ (o-e)²/e = N (Σ o²/(r c) - 1), so empty cells need no rows. Yates' correction applies
    when there is one degree of freedom.
    """
    # one scan of the rows; margins and cells then come from the small table of counts
    counts = cut_lineage(
        df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("_o"))
    )
    rows = counts.groupBy(a).agg(F.sum("_o").alias("_row"))
    if top:
        rows = rows.orderBy(F.desc("_row"), a).limit(top)
        counts = counts.join(F.broadcast(rows.select(a)), a, "left_semi")
    cols = counts.groupBy(b).agg(F.sum("_o").alias("_col"))
    row_facts = rows.agg(
        F.struct(F.sum("_row").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(1 / F.col("_row")).alias("inv"))
    )
    col_facts = cols.agg(F.struct(F.count(F.lit(1)).alias("k"), F.sum(1 / F.col("_col")).alias("inv")))
    expected = counts.join(rows, a).join(cols, b)
    n, k_r, inv_r = (F.col(f"_r.{f}") for f in ("n", "k", "inv"))
    k_c, inv_c = (F.col(f"_c.{f}") for f in ("k", "inv"))
    o_rc = F.col("_o") * F.col("_o") / (F.col("_row") * F.col("_col"))
    one = (
        expected.agg(F.sum(o_rc).alias("_s"), F.max(F.struct("_o", "_row", "_col")).alias("_cell"))
        .withColumn("_r", row_facts.scalar())
        .withColumn("_c", col_facts.scalar())
    )
    # in a 2 × 2 table |o - e| is the same in every cell
    gap = F.abs(F.col("_cell._o") - F.col("_cell._row") * F.col("_cell._col") / n)
    corrected = F.pow(F.greatest(gap - 0.5, F.lit(0.0)), 2) * n * inv_r * inv_c
    plain = n * (F.col("_s") - 1)
    dof = ((k_r - 1) * (k_c - 1)).cast("bigint")
    statistic = F.when((dof == 1) & F.lit(correction), corrected).when(dof >= 1, F.greatest(plain, F.lit(0.0))).when(dof == 0, F.lit(0.0))
    facts = one.select(statistic.alias("statistic"), dof.alias("dof"), n.cast("bigint").alias("n"))

    def tail(row: Row) -> float | None:
        return None if row.statistic is None else _chi_square_tail(row.statistic, row.dof)

    return _with_result(facts, "p_value", tail).withColumn("significant", F.col("p_value") < ALPHA)


def expected_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Expected count of every occurring cell under independence."""
    counts = df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).alias("observed"))
    rows = counts.groupBy(a).agg(F.sum("observed").alias("_r"))
    cols = counts.groupBy(b).agg(F.sum("observed").alias("_c"))
    total = counts.agg(F.sum("observed")).scalar()
    return counts.join(rows, a).join(cols, b).select(
        a, b, "observed", (F.col("_r") * F.col("_c") / total).alias("expected")
    )


def major_groups(df: DataFrame, col: str, n: int = 3) -> DataFrame:
    """Rows of the n most frequent known groups; only n values are broadcast."""
    top = top_values(df.filter(F.col(col).isNotNull()), col, n).select(col)
    return df.join(F.broadcast(top), col, "left_semi")


def mann_whitney(df: DataFrame, group: str, measure: str, first: str) -> DataFrame:
    """Two-sided rank test of the group ``first`` against all other known groups.

    Rows collapse to distinct values with both groups' counts; mid-ranks come from histograms
    over those values. One row: sizes, U, tie term, z, p and medians, or a verdict
    ``insufficient`` when a group has five values or fewer.
    """
    known = df.filter(F.col(group).isNotNull() & F.col(measure).isNotNull()).select(
        F.col(measure).cast("double").alias("value"), (F.col(group) == first).alias("is_first")
    )
    counts = known.groupBy("value").agg(
        F.count_if("is_first").alias("n1"), F.count_if(~F.col("is_first")).alias("n2")
    ).withColumn("t", F.col("n1") + F.col("n2"))
    counts = cut_lineage(with_buckets(counts))  # read by the rank sum and both medians
    t = F.col("t").cast("double")
    sums = counts.agg(
        F.coalesce(F.sum("n1"), F.lit(0)).alias("n1"),
        F.coalesce(F.sum("n2"), F.lit(0)).alias("n2"),
        F.sum(t * t * t - t).alias("tie_term"),
    ).withColumn("_r1", mid_rank_sum(counts, "n1", "t").scalar())

    sides = F.array(*[F.struct(F.lit(n).alias("side"), F.col(n).alias("n")) for n in ("n1", "n2")])
    sided = counts.select("value", *LEVELS, F.inline(sides)).filter("n > 0")
    medians = quantiles_of(sided, {"m": 0.5}, ["side"]).agg(
        *[F.max(F.when(F.col("side") == n, F.col("m"))).alias(name) for n, name in (("n1", "median_first"), ("n2", "median_other"))]
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u1 = F.col("_r1") - n1 * (n1 + 1) / 2
    enough = (F.col("n1") > MIN_GROUP) & (F.col("n2") > MIN_GROUP)
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("tie_term") / (n * (n - 1))))
    staged = sums.select(
        "n1",
        "n2",
        F.when(enough, u1).alias("u1"),
        F.when(enough, n1 * n2 - u1).alias("u2"),
        F.when(enough, F.col("tie_term")).alias("tie_term"),
        F.when(enough, sigma).alias("sigma"),
    )
    top = F.greatest("u1", "u2")
    # without any spread (all values tied) the test has nothing to say: z is 0
    z = F.when(F.col("sigma") > 0, (top - F.col("n1") * F.col("n2") / 2 - 0.5) / F.col("sigma")).when(
        F.col("sigma") == 0, F.lit(0.0)
    )
    facts = staged.withColumn("z", z).crossJoin(medians)  # one row each
    return _with_result(facts, "p_value", _rank_sum_p).withColumn(
        "verdict",
        F.when(F.col("u1").isNull(), "insufficient")
        .when(F.col("p_value") < ALPHA, "significant")
        .otherwise("not significant"),
    )
