"""Operators 11 to 13 against brute force, with hot groups, odd rows and forced splits."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import negatives, ngramjoin, phrases

DOCS = "doc_id long, text string, lang string, source string, _text string, _c long, f long"


def docs_of(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, None, None, 1, 1) for i, t in enumerate(texts)], DOCS)


# --- 11: phrases ----------------------------------------------------------------------------------


def brute_phrases(rows, least=30, scale=2_000_000, percent=80, most=2000):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longer = {}
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                key = lang, words[i : i + k]
                longer[key] = max(longer.get(key, 0), a)
    out = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * longer.get((lang, words), 0) >= percent * a:
            continue
        cuts = [(scale * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(found)[:most], 1)
    )


def some_texts(seed, n=300):
    pick = random.Random(seed)
    words = ["a", "b", "c", "the", "of", "É", "日本", "x1", "Zz", "q"]
    passage = " ".join(f"w{i}" for i in range(90))
    texts = []
    for i in range(n):
        body = "".join(pick.choice(words) + pick.choice([" ", "  ", "\t", ", ", "\n", "\x0c", ". "]) for _ in range(pick.randint(0, 60)))
        texts.append(body + (passage if i % 5 == 0 else "") + ("; hot pair " + pick.choice(words) if i % 3 else ""))
    return texts


@pytest.mark.parametrize("flush", [50, 4_000_000])
def test_phrases_equal_brute_force(spark, monkeypatch, flush):
    monkeypatch.setattr(phrases, "FLUSH_WORDS", flush)
    texts = some_texts(1) + [None, "", " \n\t .,;", "u v w x u v w x " * 40, "loop " * 200, "hot pair " * 50]
    rows = [(t, [None, "en", "de"][i % 3]) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, l, None, None, 1, 1) for i, (t, l) in enumerate(rows)], DOCS)
    assert sorted(map(tuple, phrases.collocations(df).collect())) == brute_phrases(rows)


def test_spread_pairs_change_no_count(spark, monkeypatch):
    texts = some_texts(2)
    df = docs_of(spark, texts)
    monkeypatch.setattr(phrases, "hot_pairs", lambda *_: {"en": ["hot pair", "w1 w2", "not there"]})
    assert sorted(map(tuple, phrases.collocations(df).collect())) == brute_phrases([(t, "en") for t in texts])


def test_hot_pairs_are_found(spark):
    assert phrases.hot_pairs(docs_of(spark, some_texts(3)), "text", "lang")["en"]
    assert phrases.hot_pairs(docs_of(spark, []), "text", "lang") == {}


def test_phrases_limit_ties_and_wide_numbers(spark):
    texts = [f"k{i} m{i}. " * 30 for i in range(9)]
    found = phrases.collocations(docs_of(spark, texts), most=4, scale=10**9).collect()
    assert [r.phrase for r in sorted(found, key=lambda r: r.rank)] == ["k0 m0", "k1 m1", "k2 m2", "k3 m3"]
    assert {r.score for r in found} == {10**9 // 2}


def test_phrases_of_nothing(spark):
    assert phrases.collocations(docs_of(spark, [])).count() == 0
    assert phrases.collocations(docs_of(spark, [None, "", " . "])).count() == 0


def test_paths_are_joined(spark):
    passage = " ".join(f"p{i}" for i in range(200))
    counts = phrases.counted(docs_of(spark, [passage] * 40), "text", "lang", 30)
    chains = phrases.paths(counts).collect()
    assert sum(len(c.words) - 3 for c in chains) == 197
    assert len(chains) == -(-197 // phrases.STRETCH)
    ring = docs_of(spark, ["g h i j g h i j g h i j " * 20] * 3)
    assert all(len(c.words) >= 4 for c in phrases.paths(phrases.counted(ring, "text", "lang", 30)).collect())


# --- 12: n-gram Jaccard join ----------------------------------------------------------------------


def brute_join(texts, size=4, percent=85):
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(words)} if 0 < len(words) < size else {tuple(words[i : i + size]) for i in range(len(words) - size + 1)})
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both) and both:
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return [(i, len(s), top(i)) for i, s in enumerate(sets)]


def edited(pick, words, share):
    return " ".join(pick.choice("αβγδ") + str(pick.randint(0, 99)) if pick.random() < share else w for w in words)


def near_texts(seed):
    """Chains of edits, a group around one origin, a passage all share, and odd texts."""
    pick = random.Random(seed)
    origin = [f"o{i}" for i in range(120)]
    texts = [edited(pick, origin, s) for s in (0, 0.005, 0.01, 0.02, 0.03, 0.05) for _ in range(12)]
    chain = [f"c{i}" for i in range(100)]
    for i in range(15):
        chain[i * 6] = f"new{i}"
        texts.append(" ".join(chain))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"u{i}_{j}" for j in range(pick.randint(5, 60))) for i in range(40)]
    texts += [None, "", " \n", "one", "One", "two words", "a b c", "a b c d", "A B c d", "x " * 5000, "y" * 9000]
    pick.shuffle(texts)
    return texts


@pytest.mark.parametrize("limit", [8, 40, 1000])
def test_join_equals_brute_force(spark, monkeypatch, limit):
    texts = near_texts(limit)
    monkeypatch.setattr(ngramjoin, "LEAF_ROWS", 6)
    found = ngramjoin.jaccard_join(docs_of(spark, texts), limit=limit)
    assert sorted(map(tuple, found.collect())) == brute_join(texts)


def test_cells_join_exactly(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(ngramjoin, "LEAF_ROWS", 4)
    pick = np.random.default_rng(4)
    base = [pick.choice(2000, 60, replace=False) for _ in range(6)]
    sets = [np.unique(np.concatenate([b[pick.permutation(60)[: 60 - e]], pick.integers(5000, 9000, e)])) for b in base for e in (0, 1, 2, 3, 4, 5, 6, 8, 10)]
    rows = pd.DataFrame({"_c": range(len(sets)), "_comp": range(len(sets)), "_set": sets})
    links = ngramjoin._joined(rows, 85)
    groups = {i: {i} for i in range(len(sets))}

    def unite(a, b):
        both = groups[a] | groups[b]
        groups.update({x: both for x in both})

    for a, b in links.itertuples(index=False):
        unite(a, b)
    got = {frozenset(g) for g in groups.values()}
    groups = {i: {i} for i in range(len(sets))}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                unite(i, j)
    assert got == {frozenset(g) for g in groups.values()}


def test_join_of_odd_rows(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(5, text), (5, "other words stand here now"), (3, text), (None, text), (None, "lone text without id"), (5, text), (9, None)]
    df = spark.createDataFrame([(i, t, None, None, None, 1, 1) for i, t in rows], DOCS)
    found = collections.Counter(map(tuple, ngramjoin.jaccard_join(df).collect()))
    assert found == collections.Counter([(5, 27, 3), (5, 2, 5), (3, 27, 3), (None, 27, 3), (None, 1, None), (5, 27, 3), (9, 0, 9)])
    assert ngramjoin.jaccard_join(docs_of(spark, [])).count() == 0


# --- 13: hard negatives ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, _row long, score string"


def brute_negatives(rows, anchor, low=50, high=95):
    usable, out = [], []
    for row in dict.fromkeys((i, None if v is None else tuple(v), l) for i, v, l in rows):
        if row[0] is None or not row[1] or row[2] is None or any(x is None or not np.isfinite(x) for x in row[1]):
            continue
        usable.append((row[0], row[2], np.floor(np.array(row[1], np.float32).astype(float) * 256).astype(np.int64)))
    lengths = collections.Counter(len(u[2]) for u in usable)
    width = min(lengths, key=lambda w: (-lengths[w], w), default=0)
    usable = [u for u in usable if len(u[2]) == width]
    for a in usable:
        if not anchor(a[0]):
            continue
        scored = sorted((-int(a[2] @ b[2]), b[0], b[1]) for b in usable if b is not a)
        for s, i, _ in [x for x in scored if x[2] == a[1]][:5]:
            fits = [x for x in scored if x[2] != a[1] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a[0], i, rank, x[1], -s, -x[0]) for rank, x in enumerate(fits, 1)]
    return sorted(out)


def vectors(seed, n, width=8, spread=0.3):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(6, width))
    rows = []
    for i in range(n):
        label = int(pick.integers(0, 6)) if i % 3 else 2
        rows.append((i, [float(np.float32(x)) for x in centres[label] + spread * pick.normal(size=width)], label))
    return rows


@pytest.mark.parametrize("spread", [0.05, 0.5])
def test_negatives_equal_brute_force(spark, monkeypatch, spread):
    for name, value in {"FIRST_SEGMENT": 60, "GROWTH": 2, "ANCHOR_BLOCK": 7, "ROW_BLOCK": 90, "STEP": 25}.items():
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(5, 700, spread=spread)
    rows += [(i, list(rows[i % 50][1]), rows[i % 50][2]) for i in range(700, 760)]  # ties
    df = spark.createDataFrame([(*r, 0, "") for r in rows], VECTORS)
    found = negatives.hard_negatives(df, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda i: i % 20 == 0)


def test_negatives_of_odd_rows(spark):
    rows = vectors(6, 80) + [(80, None, 1), (81, [None] * 8, 1), (82, [float("nan")] + [1.0] * 7, 1), (83, [float("inf")] * 8, 1), (84, [1.0] * 3, 1)]
    rows += [(85, [0.0] * 8, 2), (100, [0.0] * 8, 2), (None, [1.0] * 8, 1), (86, [1.0] * 8, None), (87, [], 1), *vectors(6, 3), (20, [3.0e4] * 8, 1)]
    df = spark.createDataFrame([(*r, 0, "") for r in rows], VECTORS)
    found = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    single = [r for r in rows if r[0] != 20]
    assert sorted(map(tuple, negatives.hard_negatives(df.where("vec_id is null or vec_id <> 20"), F.col("vec_id") % 10 == 0).collect())) == brute_negatives(single, lambda i: i % 10 == 0)
    assert found.count() == len(brute_negatives(rows, lambda i: i % 10 == 0))
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(df, F.lit(False)).count() == 0


def test_walk_ends_early_where_bounds_allow():
    import pandas as pd

    pick = np.random.default_rng(7)
    y = (pick.normal(size=(5000, 4)) * 100).astype(np.int64)
    rows = pd.DataFrame({"_row": range(5000), "_id": range(5000), "_label": 1, "_v": list(y), "_bound": np.linalg.norm(y, axis=1)})
    x = np.array([[100, 0, 0, 0]])
    slots = [[{"_slot": 0, "_low": negatives.LOWEST + 1, "_high": negatives.HIGHEST, "_need": negatives.LOWEST + 1}]]
    anchors = pd.DataFrame({"_row": [-1], "_label": [1], "_v": list(x), "_norm": [100.0], "_slots": slots})
    best = negatives._walk_block(anchors, rows, 5, True)
    order = np.lexsort((np.arange(5000), -(y @ x[0])))[:5]
    assert best["_id"].tolist() == order.tolist()
