"""Licence scan (operator 5): a trained paragraph classifier, confirmed by template comparison.

Each line is read by itself, long ones in overlapping windows. So that a notice wrapped over lines
is whole, windows also run over the words of neighbouring lines up to a line without words. Their hashed word n-grams (one to three words) go through a sparse logistic regression over
licence families and ``none``. It is trained on the public notices below, put into context and
damaged at random, against paragraphs of the corpus that resemble no notice (at most
``FIT_ROWS``, chosen by hash). Held-back rows fit a temperature and the confidence under which a
window is unknown. Each family is scored against ``none`` alone, so that families named together
do not share one probability. A family counts only if enough word triples of one of its notices
are in the window; one that is not the likeliest also needs a triple there that no other family
has, and the likeliest needs it where a fuller notice of another family explains most of its triples.

``n_paragraphs`` counts lines with words. A finding names the line where its notice begins; a
notice that lines already show by themselves is not listed again for the windows over them.

Null, empty and blank texts have no paragraphs and no finding. Repeated rows get equal results;
other columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.llm.common import map_arrow, texts
from stratalake.llm.langid import softmax, train_shard

PLACES = 1 << 14
FIT_ROWS = 4000
VARIANTS = 40  # damaged copies of each notice
WINDOW, STEP = 64, 32
CONFIRM = 0.6  # share of a notice's word triples
FALSE_RATE = 0.001  # of paragraphs without a licence, at the unknown bound
NONE = "none"

# fixed values: public licence notices
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("BSD", "Licensed under the BSD License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def triples(row: list[str]) -> set[tuple[str, ...]]:
    return set(zip(row, row[1:], row[2:]))


TEMPLATES = [(family, triples(words(notice))) for family, notice in NOTICES]


def own_triples(place: int) -> set[tuple[str, ...]]:
    """Triples of a notice that no other family's notice has."""
    family, mine = TEMPLATES[place]
    return mine.difference(*(t for f, t in TEMPLATES if f != family))


OWN = [own_triples(i) for i in range(len(TEMPLATES))]


def resemblance(row: list[str], family: str | None = None) -> float:
    """Largest share of a notice's triples (of one family, or any) that a paragraph has."""
    mine = triples(row)
    return max((len(mine & t) / len(t) for f, t in TEMPLATES if family in (None, f)), default=0.0)


def confirmed(row: list[str], families: list[str], likeliest: str) -> dict[str, list[int]]:
    """Notices of each family that a window holds enough of."""
    mine = triples(row)
    enough = [i for i, (f, t) in enumerate(TEMPLATES) if f in families and len(mine & t) >= CONFIRM * len(t)]
    sure = [i for i in enough if mine & OWN[i]]

    def explained(i: int) -> bool:
        """Whether a fuller notice of another family has most of this one's triples in the window."""
        here = mine & TEMPLATES[i][1]
        share = len(here) / len(TEMPLATES[i][1])
        others = (TEMPLATES[j][1] for j in sure if TEMPLATES[j][0] != TEMPLATES[i][0])
        return any(len(mine & t) / len(t) > share and 2 * len(here & t) >= len(here) for t in others)

    out: dict[str, list[int]] = {}
    for i in enough:
        family = TEMPLATES[i][0]
        if i in sure or family == likeliest and not explained(i):
            out.setdefault(family, []).append(i)
    return out


def places_of(row: list[str], notice: int) -> list[tuple[int, int, float]]:
    """First and last word of each copy of a notice in a window, and its share of the triples."""
    template, copies, seen = TEMPLATES[notice][1], [], set()
    for at, triple in enumerate(zip(row, row[1:], row[2:])):
        if triple in template:
            if not copies or triple in seen:  # a triple once more: the next copy
                copies.append([at, at, 0.0])
                seen = set()
            seen.add(triple)
            copies[-1][1:] = at + 2, len(seen) / len(template)
    whole = [c for c in copies if c[2] >= CONFIRM]
    return [tuple(c) for c in whole or [max(copies, key=lambda c: c[2])]]


class Grams:
    """Hashed places of a paragraph's word n-grams."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def hashes(self, row: list[str]) -> np.ndarray:
        if len(self.known) > 500_000:
            self.known.clear()
        h = []
        for w in row:
            v = self.known.get(w)
            if v is None:
                v = self.known[w] = xxhash.xxh3_64_intdigest(w)
            h.append(v)
        return np.array(h, np.uint64)

    def places(self, row: list[str]) -> list[np.ndarray]:
        """Places of the one-, two- and three-word runs that begin at each word."""
        one = self.hashes(row)
        two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
        three = two[:-1] * np.uint64(0xBF58476D1CE4E5B9) + one[2:]
        mixed = (one, two ^ np.uint64(0x5555), three)
        return [(x * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(50)).astype(np.int64) for x in mixed]

    def vector(self, row: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found, count = np.unique(np.concatenate(self.places(row)), return_counts=True)
        return np.append(found, PLACES), np.append(count / np.sqrt(max(count.sum(), 1)), 0.3)

    def logits(self, row: list[str], parts: list[tuple[int, int]], weights: np.ndarray) -> np.ndarray:
        """Logits of several word ranges of one text at once, by running sums."""
        begin, end = np.array(parts).T
        total, runs = np.zeros((len(parts), weights.shape[1])), np.zeros(len(parts))
        for order, places in enumerate(self.places(row)):
            sums = np.zeros((len(places) + 1, weights.shape[1]))
            np.cumsum(weights[places], axis=0, out=sums[1:])
            last = np.maximum(end - order, begin)
            runs += last - begin
            begin_, last = np.minimum(begin, len(places)), np.minimum(last, len(places))
            total += sums[last] - sums[begin_]
        return total / np.sqrt(np.maximum(runs, 1))[:, None] + 0.3 * weights[PLACES]


@dataclass
class Model:
    families: list[str]
    weights: np.ndarray
    temperature: float = 1.0
    bound: float = 0.5


def windows(n: int, start: int = 0) -> list[tuple[int, int]]:
    """Word ranges of a paragraph of n words."""
    if n <= WINDOW:
        return [(start, start + n)] if n else []
    return [(start + i, start + min(i + WINDOW, n)) for i in range(0, n - STEP, STEP)]


def against_none(p: np.ndarray) -> np.ndarray:
    """Probability of each family if only it and ``none`` were possible."""
    return p[:, 1:] / np.maximum(p[:, 1:] + p[:, :1], 1e-300)


def fit(df: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Train on damaged notices and on a bounded sample of paragraphs of the corpus."""
    lines = df.select(F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("_no", "_line"), F.col(key).alias("_key"))
    lines = lines.where(F.length(F.trim("_line")) > 0).select("_line", F.pmod(F.xxhash64("_key", "_no"), F.lit(1 << 30)).alias("_h"))
    total = lines.count()
    bound = int((1 << 30) * min(1.0, FIT_ROWS / max(total, 1)))
    plain = sorted(r[0] for r in lines.where(F.col("_h") < bound).select("_line").collect())  # about FIT_ROWS
    rows = [words(line) for line in plain]
    none = [part for row in rows for i, j in windows(len(row)) if resemblance(part := row[i:j]) < 0.3]
    random = np.random.default_rng(8)
    families = [NONE, *sorted({f for f, _ in NOTICES})]
    rows = [(w, 0) for w in none]
    for family, notice in NOTICES:
        base = words(notice)
        for turn in range(VARIANTS):
            row = [w for w in base if turn == 0 or random.random() > 0.08]
            if none and turn % 2:
                context = none[random.integers(len(none))]
                cut = int(random.integers(0, min(len(context), 20) + 1))
                row = context[:cut] + row + context[cut : cut + int(random.integers(0, 10))]
            rows.append((row, families.index(family)))
    grams = Grams()
    data = [(*grams.vector(row), goal) for row, goal in rows]
    order = random.permutation(len(data))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]
    model = Model(families, train_shard(PLACES + 1, len(families), [data[i] for i in used]))
    x = np.array([data[i][1] @ model.weights[data[i][0]] for i in held])
    y = np.array([data[i][2] for i in held])
    losses = {t: -np.log(softmax(x / t)[np.arange(len(y)), y] + 1e-300).mean() for t in np.geomspace(0.02, 20, 100)}
    model.temperature = float(min(losses, key=losses.get))
    clean = against_none(softmax(x[y == 0] / model.temperature)).max(axis=1) if (y == 0).any() else np.zeros(1)
    model.bound = float(np.clip(np.quantile(clean, 1 - FALSE_RATE), 0.2, 0.9))
    return model


def scan(df: DataFrame, model: Model, columns: list[str | Column] | None = None, text: str = "text") -> DataFrame:
    """``columns``, ``n_paragraphs`` and ``licences``: family, paragraph number, confidence of each finding."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        known, grams = shared.value, Grams()

        def findings(value: str):
            row, parts, owner, block, wide, starts, n_lines = [], [], [], [], [], [], 0

            def close():
                if len(block) > 1:
                    wide.extend(windows(len(row) - block[0], block[0]))
                block.clear()

            for number, line in enumerate(value.split("\n")):
                mine = words(line)
                if not mine:
                    close()
                    continue
                n_lines += 1
                block.append(len(row))
                starts.append((len(row), number))
                cut = windows(len(mine), len(row))
                row += mine
                parts += cut
                owner += [number] * len(cut)
            close()
            if not parts:
                return 0, []
            single = len(parts)
            parts += wide
            p = softmax(grams.logits(row, parts, known.weights) / known.temperature)
            scores, tops = against_none(p), p[:, 1:].argmax(axis=1)
            best: dict[tuple[int, str], float] = {}
            over = []
            above = scores > known.bound
            for i in np.flatnonzero(above.any(axis=1)):
                window, hits = row[slice(*parts[i])], {known.families[f + 1]: float(scores[i, f]) for f in np.flatnonzero(above[i])}
                for family, notices in confirmed(window, list(hits), known.families[tops[i] + 1]).items():
                    c = hits[family]
                    if i >= single:
                        over += [(-share, parts[i][0] + a, parts[i][0] + b, family, c) for n in notices for a, b, share in places_of(window, n)]
                    elif c > best.get((owner[i], family), 0):
                        best[owner[i], family] = c
            if over:
                firsts, numbers = np.array(starts).T
                taken = {}  # lines of each family's findings
                for number, family in best:
                    taken.setdefault(family, set()).add(number)
                for _, a, b, family, c in sorted(over):  # the most whole first
                    first, last = np.searchsorted(firsts, [a, b], side="right") - 1
                    lines = set(numbers[first : last + 1].tolist())
                    if not lines & taken.setdefault(family, set()):
                        taken[family] |= lines
                        best[int(numbers[first]), family] = c
            return n_lines, [{"family": f, "paragraph": n, "confidence": c} for (n, f), c in sorted(best.items())]

        def step(batch: pa.RecordBatch):
            both = [findings(t) for t in texts(batch, "_text")]
            return {"n_paragraphs": [b[0] for b in both], "licences": [b[1] for b in both]}

        return step

    finding = T.StructType([T.StructField("family", T.StringType()), T.StructField("paragraph", T.IntegerType()), T.StructField("confidence", T.DoubleType())])
    added = T.StructType([T.StructField("n_paragraphs", T.LongType()), T.StructField("licences", T.ArrayType(finding))])
    return map_arrow(df, [*(columns or ["doc_id"]), F.col(text).cast("string").alias("_text")], added, start).drop("_text")
