"""Chat formatting in windows of a token budget.

A turn is written ``### role: text</turn>`` and a line break. Inside texts and roles a
backslash is put before each character that starts ``###`` or ``</turn>``, before backslashes,
and in roles before colons; so the turns can be read back exactly. Prefix sums of turn
tokens choose the turns of a window: the leading system turn, the last turns of the window
before as far as the history budget goes, then new turns up to the budget. The loss mask
covers the text of new assistant turns only, so each target counts once.

Turns are counted and escaped where they are read. Then each conversation streams through
one task in order, which holds one window at a time, however long the conversation.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_lens.llm.piece_bpe import load

BUDGET = 1024
HISTORY = 256
TARGET = "assistant"
SYSTEM = "system"

_END = "</turn>"
_TEXT = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_ROLE = re.compile(r"\\|:|#(?=##)|<(?=/turn>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_HEAD = re.compile(r"### ((?:\\.|[^\\:])*): ", re.DOTALL)


def escape(text: str, chars: re.Pattern = _TEXT) -> str:
    return chars.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def heading(role: str) -> str:
    return f"### {escape(role, _ROLE)}: "


def parse(text: str) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of the turns of a formatted window."""
    at = 0
    while at < len(text):
        head = _HEAD.match(text, at)
        start = end = head.end()
        while True:
            end = text.index(_END, end)
            before = end
            while before > start and text[before - 1] == "\\":
                before -= 1
            if (end - before) % 2 == 0:  # else the mark is a text's own
                break
            end += 1
        yield unescape(head[1]), unescape(text[start:end])
        at = end + len(_END) + 1


class _Windows:
    """Forms the windows of one conversation; holds the turns of the current window alone."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: list[tuple[str, str, int]] = []
        self.kept: list[tuple[str, str, int]] = []  # repeated turns, then new ones
        self.repeated = self.number = 0
        self.leading = True

    def _size(self, turns: list[tuple[str, str, int]]) -> int:
        return sum(t[2] for t in turns)

    def add(self, turn: tuple[str, str, int]) -> dict | None:
        """Take a turn; returns the window that it closes."""
        done = None
        used = self._size(self.system) + self._size(self.kept)
        if len(self.kept) > self.repeated and used + turn[2] > self.budget:
            done = self.close()
            sums = [0, *accumulate(t[2] for t in self.kept)]
            room = min(self.history, self.budget - self._size(self.system) - turn[2])
            first = bisect_left(sums, sums[-1] - max(0, room))  # the longest end of the turns that has room
            self.kept = self.kept[first:]
            self.repeated = len(self.kept)
        if self.leading and turn[0] == SYSTEM and not self.system:
            self.system = [turn]  # retained: every window starts with it
        else:
            self.kept.append(turn)
        self.leading = False
        return done

    def close(self) -> dict | None:
        """The current window, if it has a new turn."""
        again = self.number > 0
        if len(self.kept) == self.repeated and (again or not self.system):
            return None
        parts, spans, at = [], [], 0
        turns = self.system + self.kept
        old = (len(self.system) if again else 0) + self.repeated
        for k, (role, text, _) in enumerate(turns):
            parts += [head := heading(role), text, _END, "\n"]
            if role == TARGET and k >= old and text:
                spans.append({"start": at + len(head), "end": at + len(head) + len(text)})
            at += len(head) + len(text) + len(_END) + 1
        tokens = self._size(turns)
        out = {"number": self.number, "text": "".join(parts), "loss": spans, "repeated": old}
        out |= {"turns": len(turns), "tokens": tokens, "over_budget": tokens > self.budget}
        self.number += 1
        return out


_KIND = (
    "conv_id long, window int, text string, loss array<struct<start: long, end: long>>, n_turns int, n_repeated int, "
    "n_tokens long, over_budget boolean"
)
_NAMES = ["conv_id", "window", "text", "loss", "n_turns", "n_repeated", "n_tokens", "over_budget"]
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _batch(rows: list[tuple[int | None, dict]]) -> pa.RecordBatch:
    pick = lambda name, kind: pa.array([w[name] for _, w in rows], kind)
    columns = [pa.array([c for c, _ in rows], pa.int64()), pick("number", pa.int32()), pick("text", pa.string())]
    columns += [pick("loss", _SPANS), pick("turns", pa.int32()), pick("repeated", pa.int32())]
    columns += [pick("tokens", pa.int64()), pick("over_budget", pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, _NAMES)


def windows(turns: DataFrame, model: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """The formatted windows of all conversations of ``turns`` (``conv_id, turn, role, text``).

    ``conv_id, window, text, loss, n_turns, n_repeated, n_tokens, over_budget``; ``loss`` holds code point
    offsets into ``text``, the first ``n_repeated`` turns have been in an earlier window. Windows come out
    in order, a conversation within one partition. ``model`` is the vocabulary that counts
    tokens. A turn longer than the budget is a window of its own with the system turn; no turn is cut.

    Null texts and roles are empty. Equal turn numbers (and nulls, which come first) are
    ordered by role and text; repeated rows are turns each. Rows without a conv_id
    form one conversation. Other columns are ignored; an empty table has no windows.
    """

    @F.arrow_udf("struct<text string, tokens long>")
    def prepared(roles: pa.Array, texts: pa.Array) -> pa.Array:
        vocabulary = load(model)
        out = []
        for role, text in zip(roles.to_pylist(), texts.to_pylist(), strict=True):
            shown = escape(text)
            whole = f"{heading(role)}{shown}{_END}\n"
            out.append({"text": shown, "tokens": sum(vocabulary.remembered(w)[1] for w in vocabulary.cut(whole))})
        return pa.array(out, pa.struct([("text", pa.string()), ("tokens", pa.int64())]))

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, rows, held = object(), None, [], 0
        for batch in batches:
            for conv, role, text, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                done = []
                if conv != current:
                    done.append((current, state.close() if state else None))
                    current, state = conv, _Windows(budget, history)
                done.append((conv, state.add((role, text, tokens))))
                for owner, window in done:
                    if window:
                        rows.append((owner, window))
                        held += len(window["text"])
                if held > 1 << 22:
                    yield _batch(rows)
                    rows, held = [], 0
        if state and (last := state.close()):
            rows.append((current, last))
        if rows:
            yield _batch(rows)

    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("plain"))
    rows = rows.withColumn("p", prepared("role", "plain"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "plain")
    return rows.select("conv_id", "role", "p.text", "p.tokens").mapInArrow(form, _KIND)


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows say, read back: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, rows = object(), None, []
        for batch in batches:
            for conv, text, loss, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != current:
                    if state:
                        rows.append((current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for k, (role, said) in enumerate(parse(text)):
                    if k >= repeated:
                        state[0] += 1
                        state[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    target = unescape(text[span["start"] : span["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode())
                state[4] += len(text)
            if len(rows) > 10_000:
                yield _digest_rows(rows)
                rows = []
        if state:
            rows.append((current, state))
        if rows:
            yield _digest_rows(rows)

    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "text", "loss", "n_repeated").mapInArrow(back, kind)


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([c for c, _ in rows], pa.int64())]
    for k in range(5):
        values = [s[k].hexdigest() if k in (1, 3) else s[k] for _, s in rows]
        columns.append(pa.array(values, pa.string() if k in (1, 3) else pa.int64()))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays(columns, names)
