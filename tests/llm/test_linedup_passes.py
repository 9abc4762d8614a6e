"""Line dedup takes copies out where the lines are, and lower-cases and splits as the plain expressions do."""

import re

from pyspark.sql import functions as F

from stratalake.llm import linedup


def test_copies_leave_without_a_shuffle_of_lines(spark, monkeypatch):
    lines = [f"line {i} of its own with words {i * 7} and {i * 11}" for i in range(200)]
    rows = [(i, f"{lines[i]}\nthe copy of them all\n{lines[i // 2]}") for i in range(200)]
    plans, plain = [], linedup.hashed

    def recorded(frame):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return plain(frame)

    monkeypatch.setattr(linedup, "hashed", recorded)
    left = {r.doc_id: r.text for r in linedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left[0] == f"{lines[0]}\nthe copy of them all" and all(left[i] == lines[i] for i in range(1, 200))
    assert plans and not any("LeftAnti" in p for p in plans)


def test_lowered_changes_only_a_to_z(spark):
    odd = ["Plain ASCII", "ÀÉ Über STRASSE ẞ", "İ I ı", "ΣΑΣ ABCΣ", "ǅ Ǆ X", "Ⓐ Ⅰ Q", "Ɤ A", "\U00010400 Z", "né Ô", "only é LOW"]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    got = {r.t: r.low for r in df.select("t", linedup.lowered(F.col("t")).alias("low")).collect()}
    assert got == {t: re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in odd}


def test_blanks_of_all_kinds_part_words(spark):
    rows = [(1, "a\tb\x0bc\x0cd\re f"), (2, "\t a b  c d e\x0b\x0cf \r"), (3, "\t\x0b \x0c\r\nA B\tC D E F"), (4, "a b c d e f")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in linedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (rows[0][1], 1, 0), 2: ("", 1, 1), 3: ("\t\x0b \x0c\r", 1, 1), 4: (rows[3][1], 1, 0)}
