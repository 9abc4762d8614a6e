"""Line dedup and pipeline on repeated ids, clashing names and emptied documents."""

import collections
import re

import pytest

from stratalake.llm import linedup
from tests.conftest import SF_DIR


def brute_lines(rows, order):
    """Texts left of rows (id, text), lines compared in the given order of rows."""
    seen, left = [], {}
    for place in order:
        out = []
        for line in rows[place][1].split("\n"):
            words = re.findall(r"[^\x20\x09-\x0D]+", line.lower())
            tokens = {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
            again = any(100 * len(tokens & s) >= 75 * len(tokens | s) for s in seen if tokens)
            if tokens:
                seen.append(tokens)
            if not again:
                out.append(line)
        left[place] = "\n".join(out)
    return left


def test_rows_that_share_an_id_keep_their_own_lines(spark):
    rows = [(1, "a b c d e f g h\nother line here"), (1, "zz yy xx\na b c d e f g h\nother line here"), (5, "t1 t2 t3\nu"), (7, "t1 t2 t3\nu"), (7, "mine alone\nand this too")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = collections.Counter((r.doc_id, r.text) for r in linedup.line_dedup(df).collect())
    # the order of the two rows of document 1 is that of a hash
    ways = [collections.Counter((rows[p][0], t) for p, t in brute_lines(rows, order).items()) for order in ([0, 1, 2, 3, 4], [1, 0, 2, 3, 4])]
    assert left in ways
    assert left[(7, "mine alone\nand this too")] == 1


def test_line_many_documents_share_and_a_chain(spark):
    words = [f"c{i}" for i in range(40)]
    rows = []
    for i in range(12):
        words[3 * i] = f"n{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, f"the line that all of them share\nown words of number {i} {i * 7} {i * 11}") for i in range(2000)]
    found = {r.doc_id: r.text for r in linedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    chain = brute_lines(rows[:12], range(12))
    assert [found[i] for i in range(12)] == [chain[i] for i in range(12)]
    assert found[100].startswith("the line")
    assert all(found[100 + i] == rows[12 + i][1].split("\n")[1] for i in range(1, 2000))


def test_names_of_other_columns(spark):
    df = spark.createDataFrame([(1, "a b c\nd", "k", 2, 3, 4)], "doc_id long, text string, _gone string, _doc int, n_lines int, _copy int")
    assert linedup.line_dedup(df).collect()[0].asDict() == {"doc_id": 1, "text": "a b c\nd", "_gone": "k", "_doc": 2, "_copy": 4, "n_lines": 2, "n_removed": 0}


@pytest.mark.parametrize("place", range(5))
def test_stages_take_empty_tables(spark, place):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    assert p.STAGES[place][1](spark, docs, SF_DIR).count() == 0


def test_line_stage_drops_emptied_documents(spark):
    import corpus_pipeline as p

    rows = [(1, "one two three", None, None, 13), (2, "one two three", None, None, 13), (3, "", None, None, 0), (None, "one two three", None, None, 13)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r.doc_id or 0, r.text) for r in p.line_stage(spark, df, SF_DIR).collect()) == [(0, "one two three"), (1, "one two three"), (3, "")]
