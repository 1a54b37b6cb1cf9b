"""Exact SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

A sequence of tokens is what the merges give if and only if each two neighbours are
compatible: merging the characters of both again leaves the same two tokens. So a text is
encoded left to right. An Aho-Corasick pass finds the longest token at each position; a
token is taken if it is compatible with the one before it and its end isn't known to fail,
else the next shorter one is tried; when none is left, the position is marked in a bitfield
of failed positions and the token before it is taken back. Nothing is tried twice, so the
time is linear in the text.

Models must have an identity normalizer (no charsmap, white space kept), as
``piece_bpe_32k.model`` has; others are refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Words and pairs that a Python worker remembers. A word that is asked for again outlives the next
#: generation; so frequent words stay when the memory is full.
REMEMBER = 150_000
LONGEST_REMEMBERED = 64
_MARK = "!"


class PieceBpe:
    """The vocabulary of a model. ``sentencepiece`` only reads the file; it encodes nothing here."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if model.normalize(probe := " ﬁ  ２ ") != SPACE + probe.replace(" ", SPACE):
            raise ValueError(f"{path} doesn't keep texts as they are")
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in ids]
        self.pieces = [model.id_to_piece(i) for i in ids]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        #: The best score merges first; equal scores merge from the left.
        self.cost = {p: -model.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.shown = ["" if model.is_control(i) else p.replace(SPACE, " ") for i, p in enumerate(self.pieces)]
        self.shown[self.unknown] = " ⁇ "
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.found = ahocorasick.Automaton()
        for p in self.ids:
            self.found.add_word(p, (len(p) - 1, p))
        self.found.make_automaton()
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), None) for p in self.ids}
        # Only runs of spaces may hold a space after the first character: else words can't be cut apart there.
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        if inner:
            raise ValueError(f"{path} has pieces across spaces")
        breaks = "".join(re.escape(c) for c in "\n\t" if not any(c in p for p in self.ids))
        #: Where no piece reaches across: before a run of spaces, and around characters that no piece has.
        self.words = re.compile(f"{SPACE}+[^{SPACE}{breaks}]*|[^{SPACE}{breaks}]+" + (f"|[{breaks}]" if breaks else ""))
        self.compatible: dict[tuple[str, str], bool] = {}
        #: Words and their ids in decimals; marked where the ids decode to another text than the word's.
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def merged(self, text: str) -> list[str]:
        """The merges themselves, best pair first: only for two tokens at a time."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                cost = self.cost.get(parts[k] + parts[k + 1])
                if cost is not None and (best is None or cost < best):
                    best, at = cost, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        pair = (left, right)
        if (known := self.compatible.get(pair)) is None:
            if len(self.compatible) >= REMEMBER:
                self.compatible.clear()
            known = self.compatible[pair] = self.merged(left + right) == [left, right]
        return known

    def split(self, text: str) -> list[str]:
        """Pieces of a text; a character that no piece has stands for itself."""
        longest: list[str | None] = [None] * len(text)
        for end, (back, piece) in self.found.iter(text):
            longest[end - back] = piece  # later matches of a start are longer
        out: list[str] = []
        failed = bytearray(len(text) // 8 + 1)
        at, piece = 0, longest[0] if text else None
        low = 0  # tokens before this one are final: an unknown character follows them
        while at < len(text):
            if piece is None and longest[at] is None:
                out.append(text[at])
                at += 1
                low = len(out)
                piece = longest[at] if at < len(text) else None
                continue
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (len(out) == low or self.fits(out[-1], piece)):
                    break
                piece = self.shorter[piece]
            if piece is not None:
                out.append(piece)
                at = end
                piece = longest[at] if at < len(text) else None
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
        return out

    def encode_word(self, word: str) -> list[int]:
        ids: list[int] = []
        for piece in self.split(word):
            if (i := self.ids.get(piece)) is not None:
                ids.append(i)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in piece.encode())
            else:
                ids.append(self.unknown)
        return ids

    def cut(self, text: str) -> list[str]:
        """Words that can be encoded one by one. A text starts with a space of its own, if it isn't empty."""
        return self.words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str | None) -> list[int]:
        return [i for word in self.cut(text or "") for i in self.encode_word(word)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes that are no UTF-8 become U+FFFD; the first space of a text is dropped."""
        text = self.shown_text(ids)
        starts_with_space = bool(ids) and self.pieces[ids[0]].startswith(SPACE)
        return text[1:] if starts_with_space else text

    def shown_text(self, ids: list[int]) -> str:
        """The text of ids with its first space."""
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                pending.append(b)
                continue
            if pending:
                out.append(_utf8(pending))
                pending.clear()
            out.append(self.shown[i])
        if pending:
            out.append(_utf8(pending))
        return "".join(out)

    def _listed(self, word: str) -> str:
        """A word's ids in decimals, joined by commas, with a mark ahead if they decode to another text than the word's."""
        listed = self.known.get(word) or self.older.get(word)
        if listed is None:
            ids = self.encode_word(word)
            listed = ",".join(map(str, ids))
            if self.shown_text(ids) != word.replace(SPACE, " "):
                listed = _MARK + listed
            if len(word) > LONGEST_REMEMBERED:
                return listed
        if len(self.known) >= REMEMBER:
            self.known, self.older = {}, self.known
        self.known[word] = listed
        return listed

    def recalled(self, words: list[str]) -> tuple[str, int, str]:
        """The ids of words that follow each other, how many they are, and the text they decode to.

        No piece or byte sequence reaches from a word into the next, so the texts of a text's words, one after the
        other, are its decoded text but for its first space.
        """
        get = self.known.get
        found = [get(w) or self._listed(w) for w in words]
        listed = ",".join(found)
        shown = "".join(words).replace(SPACE, " ")
        if _MARK in listed:
            found = [x.removeprefix(_MARK) for x in found]
            listed = ",".join(found)
            shown = "".join(self.shown_text(list(map(int, x.split(",")))) for x in found)
        return listed, listed.count(",") + 1, shown

    def remembered(self, word: str) -> tuple[str, int, str]:
        """``recalled`` of one word."""
        return self.recalled([word])


def _utf8(data: bytes) -> str:
    """Each byte that starts no valid sequence becomes one replacement character."""
    out = []
    while data:
        try:
            out.append(bytes(data).decode())
            break
        except UnicodeDecodeError as e:
            out.append(bytes(data[: e.start]).decode() + "�")
            data = data[e.start + 1 :]
    return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> PieceBpe:
    return PieceBpe(path)


def encoded(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) for every row; a null or empty text has no ids."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        model = load(path)
        return pa.array([model.encode(t.as_py()) for t in texts], pa.list_(pa.int32()))

    return docs.select(F.col(id).alias("doc_id"), encode(F.col(text)).alias("ids"))


def decoded(ids: DataFrame, path: str, id: str = "doc_id", column: str = "ids") -> DataFrame:
    """``doc_id, text`` for every row of ids; null ids give a null text."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        model = load(path)
        return pa.array([None if (r := row.as_py()) is None else model.decode(r) for row in rows], pa.string())

    return ids.select(F.col(id).alias("doc_id"), decode(F.col(column)).alias("text"))


def round_trip(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``, in one pass.

    Each text is encoded whole, and its ids are decoded again. A null text counts as empty:
    no ids, and the digests of the empty string. Rows that repeat each give a row; other
    columns are ignored; an empty table gives an empty result.
    """

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            sizes, ids, texts = [], [], []
            for value in batch.column(1):
                n, digest, back = 0, hashlib.sha256(), hashlib.sha256()
                words = model.cut(value.as_py() or "")
                for start in range(0, len(words), 1 << 14):  # bounds the memory of a long text
                    listed, some, shown = model.recalled(words[start : start + (1 << 14)])
                    n += some
                    digest.update((f",{listed}" if start else listed).encode())
                    back.update((shown if start else shown[1:]).encode())  # every text starts with a space of its own
                sizes.append(n)
                ids.append(digest.hexdigest())
                texts.append(back.hexdigest())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    pairs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return pairs.mapInArrow(one, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
