"""The ten operators against brute force, public libraries, exact round trips and held-out labels."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stratalake.llm import ann, bpe, chat, langid, licences, linedup, mixing, neardup, quality, rules
from stratalake.llm.queries import vocabulary
from tests.conftest import SF_DIR

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _text string, score string"
ODD = ["", None, " \n\t ", "a", "x" * 3000, "same words again and again here today", "same words again and again here today"]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, long and repeated texts, a null id, and clashing extra columns."""
    rows = [(i, t, None, None, None, "extra", "extra") for i, t in enumerate(ODD)] + [(None, "no id", "en", "s", 1, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- 2: BPE ---------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    words = vocabulary("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_str(words)
    texts = [r[0] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    texts += ["", "İstanbul ΣΑΣ Σ", "<|endoftext|>a<|startoftext|> b<|endoftext", "I'LL don't", "ab" * 400, "é ½ ٣ \x1c\x1da\x85b", "日本😀"]
    coder = bpe.WordBpe(words)
    assert [coder.encode(t) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for row in bpe.decode(bpe.encode(df, words), words).collect():
        assert row.decoded == library.decode(row.ids, skip_special_tokens=False)


def test_long_words_merge_as_short_ones():
    coder = bpe.WordBpe(vocabulary("word_bpe_49k.json"))
    word = "thetioning" * 30
    parts = [coder.letters[b] for b in word.encode()]
    near = [coder.ranks.get(a << bpe.SHIFT | b, bpe.NO_RANK) for a, b in zip(parts, parts[1:])]
    slow = list(parts)
    while True:
        found = [(coder.ranks.get(a << bpe.SHIFT | b, bpe.NO_RANK), i) for i, (a, b) in enumerate(zip(slow, slow[1:]))]
        rank, i = min(found)
        if rank == bpe.NO_RANK:
            break
        slow[i : i + 2] = [coder.joined[rank]]
    assert coder._merged_long(list(parts), list(near)) == slow


# --- 3: near duplicates ---------------------------------------------------------------------------


def brute_components(rows, percent=75):
    shingles = neardup.shingler(5)
    sets = {i: set(shingles(t).tolist()) for i, t in rows}
    root = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def test_near_duplicates_equal_brute_force(spark):
    random = np.random.default_rng(4)
    base = [f"w{i}" for i in random.integers(0, 500, 120)]
    texts = []
    for i in range(120):  # chains and a star of edited copies around one origin, and others
        words = list(base)
        for j in random.integers(0, 120, int(random.integers(0, 6))):
            words[j] = f"z{i}"
        texts.append(" ".join(words))
    texts += [" ".join(f"q{i}" for i in random.integers(0, 200, 30)) for _ in range(30)] + ["A b C", "a B c", "a b", "", None]
    rows = list(enumerate(texts))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert len({r.component_id for r in found}) < len(rows)


def test_chance_agreement_is_corrected():
    assert neardup.least_equal(0.75) == 73 or neardup.least_equal(0.75) == 74


# --- 4: line dedup --------------------------------------------------------------------------------


def test_line_dedup_equals_sql(spark):
    from tests.oracle import compare, connect

    assert compare(entry.queries()["op4_linedup"](spark, SF_DIR), connect(SF_DIR), entry.oracle_sql()["op4_linedup"]) is None


def test_line_dedup_removes_later_matches_only(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    df = spark.createDataFrame(
        [(1, f"{long}\nkeep me"), (2, f"first\n{long.upper()} more\n\nkeep  me"), (3, f"{long} more and more"), (4, None), (None, long)],
        "doc_id long, text string",
    )
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in linedup.line_dedup(df).collect()}
    assert got[1] == (f"{long}\nkeep me", 2, 0)
    assert got[2] == ("first\n", 3, 2)
    assert got[3][2] == 1 and got[4] == (None, 0, 0) and got[None] == (long, 1, 0)


# --- 1, 6, 8: classifiers and rules ---------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = entry.queries()["op1_quality"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    hits = [r.predicted == labels[r.doc_id] for r in found if labels.get(r.doc_id) is not None]
    assert len(hits) > 30 and np.mean(hits) >= 0.9


def test_isotonic_levels_never_fall():
    random = np.random.default_rng(0)
    knots, levels = quality.isotonic(random.normal(size=300), random.integers(0, 2, 300).astype(float))
    assert (np.diff(levels) >= 0).all() and (np.diff(knots) > 0).all()


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.predict(docs, langid.fit(docs), ["doc_id", "lang"]).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98


def test_counts_do_not_depend_on_blocks(monkeypatch):
    texts = ["  12 ab  --  cd ef   ", "a  b", "    a", "x\n\n\n\n\ny", "Ab. ΑΣ ΟΔΟΣ", "a     ", "abcdefgh"]
    whole = [langid.Grams().counts(t) for t in texts]
    for size in (1, 2, 3, 5):
        monkeypatch.setattr(langid, "BLOCK", size)
        assert all((langid.Grams().counts(t) == w).all() for t, w in zip(texts, whole))
    assert langid.Grams().counts("\U00030000") is not None and langid.Grams().counts(" 1 ") is None


@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_words_equal_brute_force(words):
    raw = [w.encode() for w in words]
    grams = [tuple(raw[i : i + 5]) for i in range(len(raw) - 4)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    assert rules.repeated_words(raw) == len(hit)


def test_base_counts():
    text = "ab #c\nx y\n\n x y\nx y\n"
    n_words, chars, symbols, dup, *_ = rules.counts(text)
    assert (n_words, chars, symbols, dup) == (8, 10, 1, 1)


def test_cutoffs_lose_no_more_than_the_risk():
    random = np.random.default_rng(2)
    good = {"a": (random.random((4000, 6)), random.random((4000, 6))), "few": (random.random((20, 6)), random.random((20, 6)))}
    found = rules.cutoffs(good)
    assert set(found) == {"a"}
    assert (random.random((50_000, 6)) > found["a"]).any(axis=1).mean() <= rules.RISK
    assert rules.binomial_tail(1, 3, 0.5) == pytest.approx(0.5)


# --- 5: licences ----------------------------------------------------------------------------------


def test_licence_lines_are_found_and_named(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = licences.scan(docs, licences.fit(docs), ["doc_id", "text"]).collect()
    lines = {"MIT": "Released under the MIT License.", "CC-BY-NC": "Licensed under CC BY-NC 4.0.", "Apache-2.0": "Licensed under the Apache License, Version 2.0."}
    for r in found:
        for family, line in lines.items():
            assert (line in r.text) == (family in {f.family for f in r.licences})


def test_wrapped_and_dual_notices_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:"
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that"
    cases = [
        (bsd, {(0, "BSD")}),
        (f"a header\n\nsome words before\n{isc}\n\n{bsd}", {(3, "ISC"), (6, "BSD")}),
        ("Licensed under the Apache License, Version 2.0 or the MIT License.", {(0, "Apache-2.0"), (0, "MIT")}),
        ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", {(0, "LGPL")}),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {(0, "CC-BY-SA")}),
        ("Released under the MIT License.\nReleased under the MIT License.", {(0, "MIT"), (1, "MIT")}),
        ("Redistribution and use in source and binary forms, with or without\n\nwords", set()),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    found = {r.doc_id: {(f.paragraph, f.family) for f in r.licences} for r in licences.scan(df, licences.fit(docs)).collect()}
    assert found == {i: want for i, (_, want) in enumerate(cases)}


# --- 7: mixing ------------------------------------------------------------------------------------


def test_mixing_equals_sql(spark):
    from tests.oracle import compare, connect

    assert compare(entry.queries()["op7_mixing"](spark, SF_DIR), connect(SF_DIR), entry.oracle_sql()["op7_mixing"]) is None


def test_targets_reshare_the_excess(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, None: 300}
    got = {r._source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "_source string, source_size long")).collect()}
    total, weight, cap = sum(sizes.values()), dict(zip(["a", "b", "c", None], [1, 2, 3, 1])), {k: 3 * v for k, v in sizes.items()}
    want = {k: 0.0 for k in sizes}
    open_, left = set(sizes), float(total)
    while left > 1e-9:
        share = left / sum(weight[k] for k in open_)
        left = 0.0
        for k in sorted(open_, key=str):
            want[k] += share * weight[k]
        for k in list(open_):
            if want[k] > cap[k]:
                left += want[k] - cap[k]
                want[k] = cap[k]
                open_.discard(k)
    assert got == pytest.approx(want)


# --- 9: chat --------------------------------------------------------------------------------------


@given(st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[END]", "\\", "<", "[", "/", "s>", "x"]), max_size=12))
def test_escape_is_reversible_and_complete(parts):
    text = "".join(parts)
    written = chat.escape(text)
    assert chat.unescape(written) == text
    assert not any(c in written for c in chat.CONTROL)


def test_chat_reads_back(spark):
    found = {r.conv_id: r for r in entry.queries()["op9_chat"](spark, SF_DIR).collect()}
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet").orderBy("conv_id", "turn").collect()
    by: dict = {}
    for r in turns:
        by.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    said = "</s>[INST] ok [/INST]"
    by[-7] = [("user", said), ("assistant", said)]
    assert set(found) == set(by)
    for key, rows in by.items():
        loss = "".join(t for role, t in rows if role == "assistant")
        digest = hashlib.sha256("".join(f"{role}\n{t}\n" for role, t in rows).encode()).hexdigest()
        assert (found[key].n_turns, found[key].turns_sha256, found[key].loss_chars) == (len(rows), digest, len(loss))
        assert found[key].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_odd_turns_and_offsets(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "x"), (1, 2, "tool [END]", "y"), (None, 0, "user", "z"), (1, 3, "assistant", "answer")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    vocab = vocabulary("byte_bpe_50k.json")
    formatted = chat.format_turns(turns, vocab)
    read = chat.read_back(formatted, vocab, ["conv_id", "turn"]).collect()
    assert {(r.conv_id, r.turn, r.read_role, r.read_text) for r in read} == {(c, t, r or "", x or "") for c, t, r, x in rows}
    ordered = chat.conversations(formatted).where("conv_id = 1").orderBy("position").collect()
    whole = [i for r in ordered for i in r.ids]
    last = ordered[-1]
    assert whole[last.loss_start : last.loss_end] == last.ids[1:-1]
    assert [r.loss_start is None for r in ordered] == [True, True, True, False]


# --- 10: nearest neighbours -----------------------------------------------------------------------


def test_nearest_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    found: dict = {}
    for r in entry.queries()["op10_ann"](spark, "/root/testdata/sf0.01").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = []
    for q in (i for i in rows if i % 20 == 0):
        best = sorted((-float(rows[q] @ v), i) for i, v in rows.items() if i != q)[:20]
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 21))
        assert all(abs(s - float(rows[q] @ rows[i])) < 1e-12 for _, i, s in got)
        hits.append(len({i for _, i in best} & {g[1] for g in got}) / 20)
    assert np.mean(hits) >= 0.9


def test_nearest_with_equal_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0], "c") for i in range(60)] + [(100, [0.0, 0.0], "c"), (120, None, "c"), (140, [None, 1.0], "c"), (160, [float("nan"), 1.0], "c"), (None, [1.0, 1.0], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in got} == {0, 20, 40}
    assert [r.vec_id for r in got if r.query_id == 0] == list(range(1, 21))
    assert ann.nearest(df.where("vec_id > 90"), F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_with_repeated_rows_and_ids(spark):
    random = np.random.default_rng(9)
    plain = [(i, random.normal(size=4).astype(np.float32).tolist()) for i in range(1, 50)]
    twice, often, two = ((100, [1.0, 0.5, 0.0, 0.0]), (120, [0.0, 1.0, 0.5, 0.0]), (140, [9.0, 0.0, 0.0, 0.0]))
    many = [(7, [5.0 + i, 5.0, 5.0, 5.0]) for i in range(30)]  # fills every cut
    shared = [(140, [0.0, 9.0, 0.0, 0.0]), (141, [9.0, 0.0, 0.0, 0.0]), (142, [0.0, 9.0, 0.0, 0.0])]
    data = plain + [twice] * 2 + [often] * 21 + [two] + many + shared
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    found: dict = {}
    for r in ann.nearest(df, F.col("vec_id").isin(7, 100, 120, 140)).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    rows = {(i, tuple(v)) for i, v in data}
    for q in (7, 100, 120, 140):
        asked = [np.array(v) for i, v in rows if i == q]
        best = sorted((-max(float(a @ np.array(v)) for a in asked), i) for i, v in rows if i != q)[:20]
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 21))
        assert [g[1] for g in got] == [i for _, i in best]
        assert [g[2] for g in got] == pytest.approx([-s for s, _ in best])


# --- special rows ---------------------------------------------------------------------------------


def test_special_rows_get_defined_results(spark, odd, empty):
    words = vocabulary("word_bpe_49k.json")
    labels = spark.createDataFrame([(1, None), (5, 1), (5, 0), (None, 1)], "doc_id long, quality int")
    runs = {
        "bpe": lambda d: bpe.decode(bpe.encode(d, words), words),
        "near": neardup.near_duplicates,
        "lines": linedup.line_dedup,
        "mix": mixing.mix,
        "rules": lambda d: rules.quality_rules(d, labels),
        "lang": lambda d: langid.predict(d, langid.fit(d)),
        "quality": lambda d: quality.score(d, quality.fit(d, labels)),
        "licences": lambda d: licences.scan(d, licences.fit(d)),
    }
    for name, run in runs.items():
        assert run(odd).count() == len(ODD) + 1, name
        assert run(empty).count() == 0, name
    assert {r.lang_pred for r in runs["lang"](odd).where("doc_id < 3").collect()} == {"und"}
    near = {r.doc_id: r.component_id for r in neardup.near_duplicates(odd).collect()}
    assert near[6] == 5 and near[0] == 0


# --- pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bad = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 0").collect()}
    kept = p.quality_stage(spark, docs, SF_DIR)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert len(ids & bad) < len(bad) / 3 and len(ids) > 150
    lined = p.line_stage(spark, kept, SF_DIR)
    # documents that line dedup empties go
    worded = linedup.line_dedup(kept.select(docs.columns)).where("n_removed = 0 or n_removed < n_lines")
    assert lined.columns == docs.columns and {r.doc_id for r in lined.collect()} == {r.doc_id for r in worded.collect()}
    near = p.near_stage(spark, docs, SF_DIR)
    roots = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id for r in near.collect()} == {i for i, r in roots.items() if i == r}
    mixed = p.mix_stage(spark, docs, SF_DIR).groupBy("doc_id").count()
    taken = {r.doc_id: -(-r.taken // r.size) if r.size else 1 for r in mixing.mix(docs).collect()}
    assert {r.doc_id: r["count"] for r in mixed.collect()} == {i: n for i, n in taken.items() if n}
    assert p.bpe_stage(spark, docs, SF_DIR).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_near_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as p

    texts = ["one two three four five six seven", "another text of just a few words here", "no group but words of its own"]
    rows = [(None, texts[0])] * 3 + [(5, texts[1]), (5, texts[1]), (9, texts[1]), (None, texts[1]), (7, texts[2])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in p.near_stage(spark, docs, SF_DIR).collect()]
    assert sorted(kept, key=str) == sorted([(None, texts[0]), (5, texts[1]), (7, texts[2])], key=str)
