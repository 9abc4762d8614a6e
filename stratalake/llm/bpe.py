"""BPE encoding and decoding with a public vocabulary file (operator 2).

A word is cut into parts by two arrays: the parts' boundaries, and the merge rank of each part
with its right neighbour. The smallest rank is searched again and again, its boundary deleted
and the two neighbouring ranks renewed. Words that are too long for repeated scans keep their
ranks in a heap instead; the merges are the same.

Null and empty texts encode to no ids and decode to the empty text. Texts of any length are
encoded whole. Equal texts get equal ids. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from stratalake.llm.common import map_arrow, texts

NO_RANK = 1 << 60
SHIFT = 20  # ids are smaller than 2 ** 20
SCAN_PARTS = 64  # longer words use the heap
CACHED_WORDS = 800_000  # per Python worker; the cache starts anew beyond it
END = ""  # stands for the end-of-word mark inside a word, as one character


def byte_letters() -> list[str]:
    """The printable character that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for byte in range(256):
        if byte not in letters:
            letters[byte] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class WordBpe:
    """Encoder of a vocabulary file with word ends, lower case and dropped white space."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]

        def inner(token: str) -> str:
            return token.removesuffix(suffix) + END if token.endswith(suffix) else token

        self.ids = {inner(t): i for t, i in model["vocab"].items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks: dict[int, int] = {}  # by the pair's two ids in one number
        self.joined: list[int] = []  # by rank: id of the part that the merge makes
        for rank, (a, b) in enumerate(pairs):
            a, b = inner(a), inner(b)
            self.ranks[self.ids[a] << SHIFT | self.ids[b]] = rank
            self.joined.append(self.ids[a + b])
        self.letters = [self.ids[c] for c in byte_letters()]
        self.last_letters = [self.ids[c + END] for c in byte_letters()]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        marks = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # the file's white space is the Unicode property; in ASCII, \\s would take 0x1C to 0x1F too
        pattern = split["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}"))
        ascii_pattern = pattern.replace(r"[^\s", r"[^\t-\r ").replace(r"[\p{L}]", "[a-z]").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
        self.ascii_words = re.compile(ascii_pattern, re.ASCII)  # of lower-case text; several times faster
        self.cache: dict[str, tuple[int, ...]] = {}

    def merged(self, parts: list[int]) -> list[int]:
        """Ids of a word's parts after all merges, from the ids of its letters."""
        ranks, joined = self.ranks, self.joined
        near = [ranks.get(a << SHIFT | b, NO_RANK) for a, b in zip(parts, parts[1:])]
        if len(near) > SCAN_PARTS:
            return self._merged_long(parts, near)
        # parts[i] lies between boundary i and i + 1: deleting a boundary joins two entries
        while near and (least := min(near)) != NO_RANK:
            i = near.index(least)
            part = parts[i] = joined[least]
            del parts[i + 1], near[i]
            if i < len(near):
                near[i] = ranks.get(part << SHIFT | parts[i + 1], NO_RANK)
            if i:
                near[i - 1] = ranks.get(parts[i - 1] << SHIFT | part, NO_RANK)
        return parts

    def _merged_long(self, parts: list[int], near: list[int]) -> list[int]:
        n, ranks = len(parts), self.ranks
        left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap = [(r, i) for i, r in enumerate(near) if r != NO_RANK]
        heapq.heapify(heap)

        def renew(i: int) -> None:
            near[i] = ranks.get(parts[i] << SHIFT | parts[right[i]], NO_RANK) if right[i] < n else NO_RANK
            if near[i] != NO_RANK:
                heapq.heappush(heap, (near[i], i))

        near.append(NO_RANK)
        while heap:
            rank, i = heapq.heappop(heap)
            if not alive[i] or near[i] != rank:
                continue
            j = right[i]
            parts[i], alive[j], right[i] = self.joined[rank], False, right[j]
            if right[j] < n:
                left[right[j]] = i
            renew(i)
            if left[i] >= 0:
                renew(left[i])
        return [p for p, live in zip(parts, alive) if live]

    def word(self, word: str) -> tuple[int, ...]:
        found = self.cache.get(word)
        if found is None:
            first, last = self.letters, self.last_letters
            data = word.encode()
            parts = [first[b] for b in data]
            parts[-1] = last[data[-1]]
            found = tuple(self.merged(parts))
            if len(word) <= SCAN_PARTS:
                if len(self.cache) >= CACHED_WORDS:
                    self.cache.clear()
                self.cache[word] = found
        return found

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, word = self.cache, self.word
        for piece in self.special_pattern.split(text) if "<|" in text else (text,):
            if piece in self.special:
                out.append(self.special[piece])
                continue
            find = self.ascii_words.findall
            if not piece.isascii():
                # capital sigma has one lower-case form here, wherever it stands
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
                find = self.words.findall
            for w in find(piece.lower()):
                out += known.get(w) or word(w)
        return out


@lru_cache(maxsize=1)
def word_bpe(definition: str) -> WordBpe:
    """The encoder of a vocabulary file: a Python worker keeps it, with its words, from task to task."""
    return WordBpe(definition)


@lru_cache(maxsize=1)
def token_names(definition: str) -> pa.Array:
    """The tokens of a vocabulary file by id; ids without one are null."""
    spec = json.loads(definition)
    names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return pa.array([names.get(i) for i in range(max(names) + 1)], pa.string())


def joined_tokens(ids: pa.ListArray, tokens: pa.Array) -> pa.Array:
    """The text of each row of ids: tokens with a blank between; unknown and null ids are left out, null rows stay null."""
    values = ids.flatten()  # without the null rows
    named = pc.and_(pc.greater_equal(values, 0), pc.less(values, len(tokens)))
    found = tokens.take(pc.if_else(named, values, None))
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    known = np.concatenate([[0], np.cumsum(found.is_valid().to_numpy(zero_copy_only=False))])
    offsets = known[np.concatenate([[0], np.cumsum(lengths)])]
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found.drop_null()), " ")
    return pc.if_else(ids.is_valid(), text, None)


def encode(df: DataFrame, definition: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``ids``, the token ids of each whole text.

    ``definition`` is the content of the vocabulary file, which then travels with the job.
    """
    keep = keep or ["doc_id"]
    shared = df.sparkSession.sparkContext.broadcast(definition)

    def start():
        coder = word_bpe(shared.value)

        def step(batch: pa.RecordBatch):
            offsets, chunks = [0], []
            for value in texts(batch, "_text"):
                ids = np.array(coder.encode(value), dtype=np.int32)
                chunks.append(ids)
                offsets.append(offsets[-1] + len(ids))
            values = np.concatenate(chunks) if chunks else np.zeros(0, np.int32)
            return {"ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))}

        return step

    added = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
    columns = [F.col(k) for k in keep] + [F.col(text).cast("string").alias("_text")]
    return map_arrow(df, columns, added, start).drop("_text")


def decode(df: DataFrame, definition: str, ids: str = "ids") -> DataFrame:
    """All columns and ``decoded``: the file names no decoder, so tokens are joined by one space.

    Null ids give a null text, no ids the empty one, unknown ids are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(definition)

    def start():
        tokens = token_names(shared.value)

        def step(batch: pa.RecordBatch):
            return {"decoded": joined_tokens(batch.column(batch.schema.get_field_index(ids)), tokens)}

        return step

    return map_arrow(df, ["*"], T.StructType([T.StructField("decoded", T.StringType())]), start)
