"""Odds-ratio model over categorical features.

All features are categories, so the training rows collapse to distinct feature combinations
with a weight. The fit iterates over those few rows however large the table is, and equals
the fit on single rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.operators.aggregates import top_values
from stratalake.operators.ranking import BUCKET, default_ranges, number_bucketed, running
from stratalake.session import cut_lineage

# Fixed values of the source model.
OTHER = "Other"
TOP_CATEGORIES = 5
MIN_ROWS = 50
TRAIN_SHARE = 0.8
SEED = 42
MAX_ITER = 1000
# a bound for data brought to the driver; above it the fit is refused, not cut short
MAX_LEVELS = 1000


def top_n_or_other(df: DataFrame, col: str, n: int = TOP_CATEGORIES, other: str = OTHER) -> DataFrame:
    """Keep the n most frequent values of a column and merge all others into one.

    The broadcast side has at most n rows. Column order is kept.
    """
    top = top_values(df.filter(F.col(col).isNotNull()), col, n).select(F.col(col).alias("_hit"))
    return df.join(F.broadcast(top), F.col(col) == F.col("_hit"), "left").select(
        *[F.coalesce("_hit", F.lit(other)).alias(c) if c == col else F.col(f"`{c}`") for c in df.columns]
    )


def _cut(share: float, rows: Column) -> Column:
    return F.round(rows * F.lit(share)).cast("bigint")


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], frac: float = TRAIN_SHARE, seed: int = SEED
) -> DataFrame:
    """Add ``is_train``: in every class the share ``frac`` of the rows, exactly.

    ``key`` names columns that tell the rows apart. Rows are ordered by a seeded hash of it
    and numbered range by range, so a class holding most rows is never sorted in one task.
    """
    ranges = default_ranges(df)
    digest = F.xxhash64(F.lit(seed), *[F.col(c) for c in key])
    hashed = df.withColumn("_digest", digest).withColumn(
        BUCKET, F.floor((F.col("_digest") / 2.0**63 + 1) * (ranges / 2)).cast("int")
    )
    numbered = number_bucketed(hashed, [label], ["_digest", *key], "_place")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    cut = numbered.withColumn("_class", F.struct(label)).join(
        sizes.select(F.struct(label).alias("_class"), "_size"), "_class"
    )
    return cut.select(*df.columns, (F.col("_place") <= _cut(frac, F.col("_size"))).alias("is_train"))


def split_combinations(
    df: DataFrame, label: str, frac: float = TRAIN_SHARE, seed: int = SEED
) -> DataFrame:
    """Stratified split of rows that are only categories, as weighted combinations.

    Equal rows cannot be told apart, so each distinct combination gets ``n_train`` and
    ``n_test`` rows: the shares of a running count in hash order, which is exact per class and
    within one row of proportional per combination. The small result is materialised, since
    fitting and scoring read it many times.
    """
    counts = cut_lineage(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")))
    counts = counts.withColumn("_digest", F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns]))
    ranked = running(counts, "_digest", ["n"], [label])
    below, after = F.col("before_n"), F.col("before_n") + F.col("n")
    split = ranked.withColumn("n_train", _cut(frac, after) - _cut(frac, below)).select(
        *df.columns, "n_train", (F.col("n") - F.col("n_train")).alias("n_test")
    )
    return cut_lineage(split)


def categories(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Sorted categories per column; a column that is not categorical is refused."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("level")) for c in cols])
    found: dict[str, list] = {c: [] for c in cols}
    for row in df.select(F.inline(pairs)).distinct().limit(len(cols) * MAX_LEVELS + 1).collect():
        found[row.col].append(row.level)
    wide = [c for c, values in found.items() if len(values) > MAX_LEVELS]
    if wide:
        raise ValueError(f"more than {MAX_LEVELS} categories, merge rare ones first: {wide}")
    return {c: sorted(values) for c, values in found.items()}


def indicator_names(levels: dict[str, list]) -> list[str]:
    return [f"{col}_{level}" for col, values in levels.items() for level in values[1:]]


def one_hot_drop_first(df: DataFrame, levels: dict[str, list]) -> DataFrame:
    """0/1 columns per category but the first; an unknown category gets all zeros."""
    flags = [
        F.coalesce((F.col(f"`{col}`") == F.lit(level)).cast("double"), F.lit(0.0)).alias(f"{col}_{level}")
        for col, values in levels.items()
        for level in values[1:]
    ]
    return df.select("*", *flags)


@dataclass
class OddsModel:
    model: LogisticRegressionModel
    levels: dict[str, list]
    names: list[str]
    majority: float

    def encode(self, df: DataFrame) -> DataFrame:
        # numbered columns: category text may hold characters an assembler misreads
        flags = [
            F.coalesce((F.col(f"`{col}`") == F.lit(level)).cast("double"), F.lit(0.0))
            for col, values in self.levels.items()
            for level in values[1:]
        ]
        return _assemble(df, flags)

    def predict(self, df: DataFrame) -> DataFrame:
        """Rows with ``prediction`` and the probability of the positive class."""
        scored = self.model.transform(self.encode(df))
        return scored.withColumn("probability_true", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability"
        )


def _assemble(df: DataFrame, flags: Sequence[Column]) -> DataFrame:
    names = [f"_x{i}" for i in range(len(flags))]
    with_flags = df.select("*", *[f.alias(n) for f, n in zip(flags, names)])
    return VectorAssembler(inputCols=names, outputCol="features").transform(with_flags).drop(*names)


def prepare(df: DataFrame, features: Sequence[str], label: str, reduce: Sequence[str] = ()) -> DataFrame:
    """Complete rows of the model columns with rare categories merged."""
    rows = df.select(*features, label).dropna()
    for col in reduce:
        rows = top_n_or_other(rows, col)
    return rows


def fit_logistic(
    train: DataFrame, features: Sequence[str], label: str, weight: str | None = None
) -> OddsModel | None:
    """Logistic regression with an L2 penalty of strength 1 on the summed loss.

    ``weight`` names a column with the number of rows a row stands for. None when there is
    nothing to tell apart: no rows, or a single class.
    """
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    combos = train.groupBy(*features, label).agg(rows.cast("double").alias("_weight")).filter("_weight > 0")
    combos = combos.withColumn("_label", F.col(label).cast("double"))
    facts = combos.agg(
        F.coalesce(F.sum("_weight"), F.lit(0.0)).alias("n"),
        F.coalesce(F.sum(F.col("_weight") * F.col("_label")), F.lit(0.0)).alias("positive"),
    ).first()
    if facts.positive in (0.0, facts.n):
        return None
    levels = categories(combos, features)
    blank = OddsModel(None, levels, indicator_names(levels), float(facts.positive * 2 > facts.n))
    if not blank.names:
        return None
    fitted = LogisticRegression(
        featuresCol="features",
        labelCol="_label",
        weightCol="_weight",
        regParam=1.0 / facts.n,  # the loss here is a mean, so the penalty is divided by n
        elasticNetParam=0.0,
        standardization=False,
        maxIter=MAX_ITER,
    ).fit(blank.encode(combos))
    return OddsModel(fitted, levels, blank.names, blank.majority)


def accuracy_vs_majority(
    scored: DataFrame, label: str, majority: float, prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Accuracy of the model and of the majority class, and the relative improvement."""
    truth = F.col(label).cast("double")
    rows = F.col(weight) if weight else F.lit(1)

    def accuracy(guess: Column) -> Column:
        return F.sum(F.when(truth == guess, rows).otherwise(0)) / F.sum(rows)

    return scored.agg(
        accuracy(F.col(prediction)).alias("model_accuracy"), accuracy(F.lit(majority)).alias("baseline_accuracy")
    ).withColumn(
        "improvement_pct",
        (F.col("model_accuracy") - F.col("baseline_accuracy")) / (F.col("baseline_accuracy") + 1e-9) * 100,
    )


def odds_ratios(model: OddsModel, like: DataFrame) -> DataFrame:
    """One row per indicator with exp(coefficient), largest first."""
    rows = [(name, float(c)) for name, c in zip(model.names, model.model.coefficients)]
    frame = like.sparkSession.createDataFrame(rows, "feature string, coefficient double")
    return frame.select("feature", F.exp("coefficient").alias("odds_ratio")).orderBy(F.desc("odds_ratio"), "feature")


def odds_with_direction(odds: DataFrame) -> DataFrame:
    """Mark each odds ratio as raising or lowering the odds."""
    return odds.withColumn("direction", F.when(F.col("odds_ratio") > 1, "higher").otherwise("lower"))
