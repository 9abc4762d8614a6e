"""Chat formatting at token level (operator 9).

Every turn is encoded by itself: a reserved id opens it, the ids of its escaped text follow, a
reserved id closes it. Reserved ids lie above the vocabulary, so no text can produce them; the
control strings they stand for are escaped inside texts with a backslash, reversibly, so that the
written form is unambiguous too. The loss mask covers exactly the ids of assistant texts: +1 where
such a span begins, -1 where it ends, and prefix sums in between. Offsets of turns in their
conversation are prefix sums over turns.

Roles other than system, user and assistant are written between role marks. Null texts and roles
count as empty; a null conv_id is a conversation of its own. Turns are ordered by turn, then role
and text (nulls first), so repeated turns have a fixed order. Other columns are not looked at.
A conversation is read as a stream in turn order; no task holds more than one batch of it.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from stratalake.llm.common import map_arrow

# fixed values: the control strings of the template; their ids follow the vocabulary in this order
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]"]
FRAME = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
_PLAIN = re.compile(r"([<\[])(\\*)(/?s>|<?/?SYS>>|/?INST\]|/?ROLE\]|END\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|<?/?SYS>>|/?INST\]|/?ROLE\]|END\])")


def escape(text: str) -> str:
    """Put a backslash behind the bracket of every control string; one more where some stand."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


class Coder:
    """Ordinary ids of texts and the reserved ids of control strings."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_str(definition)
        self.plain.encode_special_tokens = True  # their strings in a text are ordinary text
        spec = json.loads(definition)
        first = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))])
        self.ids = {c: first + i for i, c in enumerate(CONTROL)}
        self.first = first

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: np.ndarray) -> str:
        return self.plain.decode(ids.tolist(), skip_special_tokens=False) if len(ids) else ""

    def turn(self, role: str, role_ids: list[int], text_ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one turn."""
        if role in FRAME:
            opening, closing = FRAME[role]
            head, tail = [self.ids[opening]], [self.ids[closing]]
        else:
            head, tail = [self.ids["[ROLE]"], *role_ids, self.ids["[/ROLE]"]], [self.ids["[END]"]]
        ids = np.array(head + text_ids + tail, np.int32)
        steps = np.zeros(len(ids) + 1, np.int8)
        if role == "assistant":
            steps[len(head)] += 1
            steps[len(head) + len(text_ids)] -= 1
        return ids, np.cumsum(steps[:-1], dtype=np.int8)

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str | None, int]:
        """Role, text, text under the mask (None without any) and written length of one turn."""
        control = {i: c for c, i in self.ids.items()}
        opening, body = control[int(ids[0])], ids[1:-1]
        role = next((r for r, f in FRAME.items() if f[0] == opening), None)
        written = len(opening) + len(control[int(ids[-1])])
        if role is None:
            cut = int(np.flatnonzero(body == self.ids["[/ROLE]"])[0])
            name = self.decode(body[:cut])
            role, body = unescape(name), body[cut + 1 :]
            written += len(name) + len("[/ROLE]")
        text = self.decode(body)
        under = ids[mask == 1]
        return role, unescape(text), unescape(self.decode(under)) if len(under) else None, written + len(text)


def format_turns(turns: DataFrame, definition: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``ids`` and ``mask`` (1 where the loss applies) of every turn."""
    shared = turns.sparkSession.sparkContext.broadcast(definition)

    def start():
        coder = Coder(shared.value)

        def step(batch: pa.RecordBatch):
            roles = [r or "" for r in batch.column(2).to_pylist()]
            bodies = coder.encode([escape(t or "") for t in batch.column(3).to_pylist()])
            heads = coder.encode([escape(r) for r in roles])
            pairs = [coder.turn(*x) for x in zip(roles, heads, bodies)]
            return {"ids": [p[0] for p in pairs], "mask": [p[1] for p in pairs]}

        return step

    columns = [F.col(conv), F.col(turn), F.col(role).cast("string").alias("_role"), F.col(text).cast("string").alias("_text")]
    added = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("mask", T.ArrayType(T.ByteType()))])
    return map_arrow(turns, columns, added, start)


def conversations(formatted: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turns with ``position`` and ``token_start`` in their conversation, loss span included.

    ``loss_start`` and ``loss_end`` count ids from the conversation's first; null without loss.
    """
    order = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), F.col("_role").asc_nulls_first(), F.col("_text").asc_nulls_first())
    before = F.sum(F.size("ids").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.size("ids")
    first = F.array_position("mask", F.lit(1).cast("byte"))
    n = F.aggregate("mask", F.lit(0).cast("long"), lambda s, m: s + m)
    rows = formatted.withColumns({"position": F.row_number().over(order), "token_start": before})
    start = F.when(first > 0, F.col("token_start") + first - 1)
    return rows.select(conv, turn, "position", "token_start", "ids", "mask", start.alias("loss_start"), (start + n).alias("loss_end"))


def read_back(formatted: DataFrame, definition: str, columns: list[str]) -> DataFrame:
    """``columns`` and what ids and mask of each turn say: role, text, loss text, written length."""
    shared = formatted.sparkSession.sparkContext.broadcast(definition)

    def start():
        coder = Coder(shared.value)

        def step(batch: pa.RecordBatch):
            ids, mask = (batch.column(batch.schema.get_field_index(n)) for n in ("ids", "mask"))
            found = [coder.read(i.values.to_numpy(), m.values.to_numpy()) for i, m in zip(ids, mask)]
            return dict(zip(["read_role", "read_text", "loss_text", "written"], map(list, zip(*found))))

        return step

    added = T.StructType([T.StructField(n, T.StringType()) for n in ("read_role", "read_text", "loss_text")]).add("written", T.LongType())
    return map_arrow(formatted, [*columns, "ids", "mask"], added, start).drop("ids", "mask")


def digests(read: DataFrame, conv: str, order: list[str]) -> DataFrame:
    """One row per conversation from its turns in order, hashed as a stream."""

    def run(batches):
        def row():
            return [current, n, turns.hexdigest(), chars, loss.hexdigest(), written]

        def emit(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        current, open_, rows = None, False, []
        for batch in batches:
            for key, role, text, under, size in zip(*(c.to_pylist() for c in batch.columns)):
                if not open_ or key != current:
                    if open_:
                        rows.append(row())
                    current, open_, n, chars, written = key, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                n, written = n + 1, written + size
                for piece in (role, "\n", text, "\n"):
                    turns.update(piece.encode())
                if under is not None:
                    chars += len(under)
                    loss.update(under.encode())
            if rows:
                yield emit(rows)
                rows = []
        if open_:
            yield emit([row()])

    sorted_rows = read.repartition(F.col(conv)).sortWithinPartitions(conv, *order).select(conv, "read_role", "read_text", "loss_text", "written")
    schema = "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return sorted_rows.mapInArrow(run, schema).withColumnRenamed("conv", conv)
