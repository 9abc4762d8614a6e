"""Rows that no key can meet are told apart before a join, so that line dedup and near-dedup leave them where they are."""

from pyspark.sql import functions as F

from stratalake.llm import linedup, neardup
from stratalake.llm.common import may_be_in


def test_no_row_of_the_keys_is_missed(spark):
    rows = spark.range(20000).select((F.col("id") - 10000).alias("a"), F.concat(F.lit("t"), "id").alias("b"))
    keys = rows.where("a % 40 = 0").unionByName(rows.where("a = 40"))
    marked = may_be_in(rows, keys, ["a", "b"])
    assert marked.columns == ["a", "b", "_may"] and marked.count() == 20000
    assert marked.where("a % 40 = 0 and not _may").count() == 0
    assert marked.where("_may").count() < 500 + 19500 / 4  # 8 bits or more a key
    assert may_be_in(rows, keys.limit(0), ["a", "b"]).where("_may").count() == 0


def test_unlike_texts_are_not_shuffled(spark, monkeypatch):
    own = [" ".join(f"v{i}_{j}" for j in range(30)) for i in range(300)]
    rows = [(i, own[i]) for i in range(300)] + [(300, own[5]), (301, own[9] + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen, plain = {}, linedup.may_be_in

    def recorded(frame, keys, on):
        out = plain(frame, keys, on)
        seen.setdefault(on[0], []).append(out.where("_may").count())
        return out

    monkeypatch.setattr(linedup, "may_be_in", recorded)
    monkeypatch.setattr(neardup, "may_be_in", recorded)
    try:
        left = {r.doc_id: r.text for r in linedup.line_dedup(df).collect()}
        groups = {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert left == {i: "" if i > 299 else t for i, t in rows}
    assert groups == {i: {300: 5, 301: 9}.get(i, i) for i, _ in rows}
    assert seen["_doc"] and max(seen["_doc"]) < 30  # of 302 lines and texts, in each join
