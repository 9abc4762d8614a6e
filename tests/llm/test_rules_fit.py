"""Cutoffs of the quality rules come from all labelled rows."""

import numpy as np
from pyspark.sql import functions as F

from stratalake.llm import rules

ROWS = 260_000


def test_cutoffs_use_every_labelled_row(spark):
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    measures = [(F.pmod(place * (i + 3), F.lit(1.0)) ** 2).alias(m) for i, m in enumerate(rules.MEASURES)]
    stratum = F.when(F.col("doc_id") < 200, "few").when(F.col("doc_id") % 4 == 0, "b").otherwise("a").alias("_stratum")
    rows = spark.range(ROWS).withColumnRenamed("id", "doc_id").select("doc_id", stratum, F.lit(False).alias("base_failed"), *measures)
    labels = rows.select("doc_id", F.lit(1).alias("quality"))
    data = {}
    for r in rows.select("_stratum", F.pmod(F.xxhash64("doc_id"), F.lit(2)), *rules.MEASURES).collect():
        data.setdefault(r[0], ([], []))[r[1]].append(tuple(r)[2:])
    expected = rules.cutoffs({s: (np.array(a), np.array(b)) for s, (a, b) in data.items()})
    found = rules.fit(rows, labels)
    assert set(found) == set(expected) == {"a", "b"}
    assert all((found[s] == expected[s]).all() for s in expected)
