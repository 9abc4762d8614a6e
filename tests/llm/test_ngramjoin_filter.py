"""The n-gram join drops sets that only share a passage before it builds full sets."""

import random

from stratalake.llm import ngramjoin


def test_sets_that_share_a_passage_leave_before_full_sets(spark, monkeypatch):
    # so few hash places say nothing about rarity, as 2^24 do on a large table
    monkeypatch.setattr(ngramjoin, "PLACES", 16)
    monkeypatch.setattr(ngramjoin, "SLICE", 16)
    draw, stored = random.Random(3), {}
    plain = ngramjoin.keep
    monkeypatch.setattr(ngramjoin, "keep", lambda df, label: stored.setdefault(label, plain(df, label)) if label == "full" else plain(df, label))
    monkeypatch.setattr(ngramjoin, "discard", lambda *tables: None)
    passages = [" ".join(f"p{i}_{j}" for j in range(24)) for i in range(4)]
    rows = []
    for i in range(120):
        own = [f"w{draw.randrange(10**9)}" for _ in range(200)]
        rows.append((i, " ".join(own[:100]) + f" {passages[i % 4]} " + " ".join(own[100:])))
    words = rows[7][1].split()
    rows.append((500, " ".join(words[:4] + ["changed"] + words[5:])))  # a near copy, linked
    rows.append((501, " ".join(words[:110])))  # half of it, not linked
    found = {r.doc_id: r.component_id for r in ngramjoin.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: 7 if i == 500 else i for i, _ in rows}
    assert stored["full"].count() <= 4  # one shared shingle of the prefix is too little


def test_lengthened_prefixes_hold_what_linked_sets_share():
    for n in range(1, 2000):
        least = (85 * n + 99) // 100
        length = ngramjoin.prefix_length(n, 85) + ngramjoin.overlap(n) - 1
        assert ngramjoin.overlap(n) <= least and length <= n  # the first common ones are there to be shared
        assert ngramjoin.overlap(least) == max(1, least // 10) <= ngramjoin.overlap(n)


def test_bitmap_of_many_keys(spark):
    keys = spark.range(5000).selectExpr("id as k").unionByName(spark.sql("select cast(null as long) as k"))
    bits = ngramjoin.bitmap(keys, "k")
    places = [r[0] - 1 for r in keys.select(ngramjoin.bit(keys["k"])).collect()]
    assert {int(p) for p in (b for b in range(ngramjoin.BITS) if bits[b >> 3] >> (b & 7) & 1)} == set(places)
