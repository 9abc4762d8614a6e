"""Quality rules with risk-controlled thresholds (operator 8).

Base rules reject documents with fewer than ten words or more than a fifth of their words in
repeated five-word windows. The other statistics get cutoffs per stratum (language). Labelled
good documents are split in two by a hash. One half names, for each level of strictness, the
cutoff of every statistic (its quantile among good documents). On the other half the levels are
tested in the fixed order from mild to strict: a level passes while the exact binomial tail says
that the rate of good documents it rejects is below ``RISK``, at confidence ``DOUBT`` divided by
the number of strata (Bonferroni); the first failure ends the sequence. So with probability
1 - ``DOUBT`` no stratum loses more than ``RISK`` of its good documents. A stratum with too few
labels gets no cutoff and keeps everything that the base rules keep.

All labelled rows take part: quantiles are exact order statistics, found over distributed counts, and
the losses at all levels are counted by one aggregate. The driver sees one row per stratum. Null and
empty texts have no words and fail the base rules. Repeated rows get equal results; other columns
are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.llm.common import map_arrow, texts
from stratalake.operators.quantiles import quantiles_of, value_table, with_buckets
from stratalake.session import discard, keep

RISK = 0.01
DOUBT = 0.05
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 20  # percent of words
LEVELS = [1.0, 0.9995, 0.999, 0.998, 0.997, 0.996, 0.995, 0.99]
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# statistics that a cutoff bounds from above
MEASURES = {
    "symbol_rate": lambda c: c["n_symbols"] / F.greatest(c["word_chars"], F.lit(1)),
    "dup_line_rate": lambda c: c["n_dup_lines"] / F.greatest(c["_lines"], F.lit(1)),
    "repeat_rate": lambda c: c["n_repeat_words"] / F.greatest(c["n_words"], F.lit(1)),
    "word_length": lambda c: c["word_chars"] / F.greatest(c["n_words"], F.lit(1)),
    "word_shortness": lambda c: c["n_words"] / F.greatest(c["word_chars"], F.lit(1)),
    "upper_rate": lambda c: c["_upper"] / F.greatest(c["word_chars"], F.lit(1)),
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows whose exact content occurs at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    row = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    key, span = row[:n].copy(), len(ids)
    for k in range(1, window):
        if span * len(ids) >= 1 << 62:
            distinct, key = np.unique(key, return_inverse=True)
            span = len(distinct)
        key = key * len(ids) + row[k : k + n]
        span *= len(ids)
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[place] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts(text: str) -> tuple[int, ...]:
    """The base counts of one whole text, then its lines with a word and its capitals."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    lines = again = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            again += line in seen
            seen.add(line)
    blanks = sum(raw.count(bytes([b])) for b in (32, 9, 10, 11, 12, 13))
    symbols = sum(map(raw.count, SYMBOLS.encode()))
    upper = int(np.bincount(np.frombuffer(raw, np.uint8), minlength=256)[65:91].sum())
    return len(words), len(text) - blanks, symbols, again, repeated_words(words), lines, upper


def measured(df: DataFrame, columns: list[str | Column], text: str = "text") -> DataFrame:
    """``columns``, the base counts, ``base_failed`` and the rates that cutoffs bound."""
    names = [*COUNTS, "_lines", "_upper"]

    def start():
        return lambda batch: dict(zip(names, map(list, zip(*(counts(t) for t in texts(batch, "_text"))))))

    added = T.StructType([T.StructField(n, T.LongType()) for n in names])
    rows = map_arrow(df, [*columns, F.col(text).cast("string").alias("_text")], added, start).drop("_text")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.withColumns({"base_failed": failed} | {m: f({c: F.col(c) for c in names}).cast("double") for m, f in MEASURES.items()})


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed in logarithms."""
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(terms)
    return min(1.0, math.exp(top) * sum(math.exp(t - top) for t in terms))


def strictest(lost: Iterable[int], n: int, strata: int) -> int | None:
    """Last level that passes before the first failure; ``lost`` has the rejected ones of ``n`` by level."""
    passed = None
    for level, k in enumerate(lost):
        # above the mean the tail is at least a half
        if k > RISK * n or binomial_tail(k, n, RISK) > DOUBT / strata:
            break
        passed = level
    return passed


def cutoffs(good: dict[str, tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
    """Certified cutoffs per stratum from (naming half, testing half) of its good documents, as arrays."""
    found = {}
    for stratum, (naming, testing) in good.items():
        if not len(naming) or not len(testing):
            continue
        bounds = [np.quantile(naming, level, axis=0, method="higher") for level in LEVELS]
        passed = strictest((int((testing > b).any(axis=1).sum()) for b in bounds), len(testing), len(good))
        if passed is not None:
            found[stratum] = bounds[passed]
    return found


def fit(rows: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "_stratum", label: str = "quality") -> dict[str, np.ndarray]:
    """The cutoffs that ``cutoffs`` gives, learned from all measured rows and labels (1: good)."""
    good = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("_good")).where("_good = 1").select(key)
    chosen = rows.where("not base_failed").join(good, key, "left_semi")
    half = F.pmod(F.xxhash64(key), F.lit(2))
    chosen = keep(chosen.select(F.col(stratum).alias("_s"), half.alias("_half"), *MEASURES), "good")
    each = F.inline(F.array(*[F.struct(F.lit(m).alias("_measure"), F.col(m).alias("_value")) for m in MEASURES]))
    group = ["_s", "_measure"]
    values = keep(with_buckets(value_table(chosen.where("_half = 0").select("_s", each), "_value", group)), "values")
    levels = {f"_q{i}": level for i, level in enumerate(LEVELS)}
    named = quantiles_of(values, levels, group, higher=True)
    bounds = named.groupBy("_s").agg(*[F.max(F.when(F.col("_measure") == m, F.col(q))).alias(m + q) for q in levels for m in MEASURES])
    over = [reduce(or_, [F.col(m) > F.col(m + q) for m in MEASURES]) for q in levels]
    # one row per stratum: sent to the rows, which a few strata would else gather in as many tasks
    lost = chosen.where("_half = 1").join(F.broadcast(bounds), "_s").groupBy("_s").agg(
        F.count(F.lit(1)).alias("_n"),
        F.array(*[F.count_if(o) for o in over]).alias("_lost"),
        F.array(*[F.array(*[F.max(m + q) for m in MEASURES]) for q in levels]).alias("_bounds"),
    )
    strata = chosen.select("_s").distinct().count()
    found = {}
    for r in lost.collect():
        passed = strictest(r["_lost"], r["_n"], strata)
        if passed is not None:
            found[r["_s"]] = np.array(r["_bounds"][passed])
    discard(chosen, values)
    return found


def apply(rows: DataFrame, found: dict[str, np.ndarray], stratum: str = "_stratum") -> DataFrame:
    """Adds ``kept``: the base rules pass and no measure lies over its stratum's cutoff."""
    over = F.lit(False)
    for name, bounds in sorted(found.items()):
        beyond = F.lit(False)
        for measure, bound in zip(MEASURES, bounds):
            beyond = beyond | (F.col(measure) > float(bound))
        over = over | ((F.col(stratum) == name) & beyond)
    return rows.withColumn("kept", ~F.col("base_failed") & ~over)


def quality_rules(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", strata: str = "lang") -> DataFrame:
    """Counts, rates, ``base_failed`` and ``kept`` of every document."""
    rows = measured(df, [F.col(key), F.coalesce(F.col(strata).cast("string"), F.lit("")).alias("_stratum")], text)
    rows = keep(rows, "measured")
    return apply(rows, fit(rows, labels, key), "_stratum").drop("_lines", "_upper", "_stratum")
