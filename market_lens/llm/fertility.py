"""Quality rules with tokeniser fertility.

A public vocabulary measures every text: code points for each token, the share of tokens that
spell a single byte because no piece covers the character, and the entropy of the tokens
against the most that so many tokens could have. What is usual depends on the language and on
the length, so a text is held against the texts of its language (of its script, where none is
given) of about its size (half to twice the size class): a band reaches some quartile distances
beyond the quartiles, which come from exact counts of all texts that pass the base rules, by small
steps of a measure. Groups too small for quartiles take the band of their script, then that of all texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from market_lens.llm.common import pieces
from market_lens.sources.scratch import materialize

MEASURES = ["chars_per_token", "byte_share", "token_entropy"]
#: Steps of a measure in which quartiles are counted, and its largest step.
STEPS = {"chars_per_token": 100, "byte_share": 1000, "token_entropy": 500}
TOP_STEP = 3000
#: The least width of a quartile distance.
NARROWEST = {"chars_per_token": 0.03, "byte_share": 0.004, "token_entropy": 0.01}
REACH = 4.0
LEAST_TEXTS = 50
LEAST_TOKENS = 30
SEGMENT = 1 << 18
WINDOW = 5

_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
#: First and last code points.
_SCRIPTS = {
    "latin": [("A", "Z"), ("a", "z"), ("À", "ɏ"), ("Ḁ", "ỿ")],
    "greek": [("Ͱ", "Ͽ")],
    "cyrillic": [("Ѐ", "ԯ")],
    "hebrew": [("\u0590", "\u05ff")],
    "arabic": [("\u0600", "\u06ff")],
    "devanagari": [("\u0900", "\u097f")],
    "thai": [("\u0e00", "\u0e7f")],
    "hangul": [("가", "힣")],
    "kana": [("\u3040", "\u30ff")],
    "han": [("\u3400", "\u4dbf"), ("\u4e00", "\u9fff")],
}
_SPANS = sorted((ord(a), ord(b), k) for k, spans in enumerate(_SCRIPTS.values()) for a, b in spans)
_STARTS, _ENDS, _NUMBERS = (np.array(c) for c in zip(*_SPANS))
_LETTER = re.compile("[A-Za-z]")


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five words that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    names = ids[:n]
    for k in range(1, WINDOW):  # numbers of distinct windows of k + 1 words: exact
        _, names = np.unique(names * len(numbers) + ids[k : k + n], return_inverse=True)
    often = np.flatnonzero(np.bincount(names)[names] > 1)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, often, 1)
    np.add.at(marks, often + WINDOW, -1)
    return int((np.cumsum(marks) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines and repeated words."""
    data = text.encode("utf-8", "replace")
    words = data.split()  # bytes: at ASCII white space only
    chars = len(text) - sum(text.count(c) for c in _SPACES)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    """The library's processor, and which ids spell a byte that is no white space."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spaces = {f"<0x{ord(c):02X}>" for c in _SPACES}
    spelled = [model.is_byte(i) and model.id_to_piece(i) not in spaces for i in range(model.get_piece_size())]
    return model, np.array(spelled)


def _segments(text: str) -> Iterator[str]:
    """A long text in parts that are encoded alike on their own: each is cut before a run of spaces, and
    the space that the vocabulary puts before a text stands for the run's first one."""
    start = 0
    while len(text) - start > SEGMENT:
        end = text.find(" ", start + SEGMENT)
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


def measures(path: str, text: str) -> tuple[int, int, float]:
    """Tokens, byte tokens, and the tokens' entropy as a share of the most that so many tokens can have."""
    model, spelled = _vocabulary(path)
    counts = np.zeros(len(spelled), np.int64)
    for part in _segments(text):
        ids = np.array(model.encode(part, num_threads=1), np.int64)
        counts += np.bincount(ids, minlength=len(spelled)) if len(ids) > 4096 else 0
        if len(ids) <= 4096:
            np.add.at(counts, ids, 1)
    n = int(counts.sum())
    if n < 2:
        return n, int(counts[spelled].sum()), 1.0
    used = counts[counts > 0]
    entropy = math.log2(n) - float((used * np.log2(used)).sum()) / n
    return n, int(counts[spelled].sum()), entropy / math.log2(min(n, len(counts)))


def script(text: str) -> str:
    """The script of most letters; ties to the first in the list."""
    if text.isascii():
        return "latin" if _LETTER.search(text) else "none"
    sums = np.zeros(len(_SCRIPTS), np.int64)
    for start in range(0, len(text), SEGMENT):
        points = np.frombuffer(text[start : start + SEGMENT].encode("utf-32-le", "replace"), np.uint32)
        place = np.searchsorted(_STARTS, points, side="right") - 1
        inside = (place >= 0) & (points <= _ENDS[place])
        sums += np.bincount(_NUMBERS[place[inside]], minlength=len(sums))
    return list(_SCRIPTS)[int(sums.argmax())] if sums.any() else "none"


_KIND = (
    "doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_tokens long, n_bytes long, chars_per_token double, byte_share double, token_entropy double"
)


def measured(docs: DataFrame, path: str) -> DataFrame:
    """Base counts and measures of every text of ``doc_id, text, lang``, without the texts."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _KIND.split(", ")][2:]
        kinds = [pa.string()] + [pa.int64()] * 7 + [pa.float64()] * 3
        for batch in batches:
            at = 0
            for part in pieces(batch.column(2)):
                rows = []
                for value in part:
                    text = value.as_py() or ""
                    n, spelled, entropy = measures(path, text)
                    each = len(text) / n if n else 0.0
                    rows.append((script(text), *base_counts(text), n, spelled, each, spelled / n if n else 0.0, entropy))
                columns = [batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part))]
                columns += [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", *names])
                at += len(part)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    return rows.mapInArrow(measure, _KIND)


def _groups() -> list[Column]:
    """From the narrowest to the widest."""
    return [F.coalesce(F.concat(F.lit("lang "), "lang"), F.concat(F.lit("script "), "script")), F.concat(F.lit("script "), "script"), F.lit("all")]


def bands(texts: DataFrame, reach: float = REACH) -> DataFrame:
    """``group, size, n_texts`` and a struct ``low, high`` for each measure, from all ``texts`` (measured, with ``size``)."""
    steps = [
        F.struct(F.lit(m).alias("measure"), F.least(F.floor(F.col(m) * STEPS[m]), F.lit(TOP_STEP)).cast("int").alias("step")) for m in MEASURES
    ]
    groups = F.explode(F.array_distinct(F.array(*_groups()))).alias("group")
    near = F.explode(F.array(*[F.col("size") + k for k in (-1, 0, 1)])).alias("size")
    cells = texts.select("size", groups, *MEASURES).select("group", near, *MEASURES).select("group", "size", F.inline(F.array(*steps)))
    counts = cells.groupBy("group", "size", "measure", "step").agg(F.count("*").alias("n"))
    by = Window.partitionBy("group", "size", "measure")  # a row for each step
    upto = by.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("group", "size", "measure", "step", F.sum("n").over(upto).alias("upto"), F.sum("n").over(by).alias("n"))
    picked = ranked.groupBy("group", "size", "measure").agg(
        F.first("n").alias("n_texts"),
        F.min(F.when(F.col("upto") * 4 >= F.col("n"), F.col("step"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("n") * 3, F.col("step"))).alias("q3"),
    )
    unit = F.element_at(F.create_map(*[F.lit(v) for m in MEASURES for v in (m, float(STEPS[m]))]), F.col("measure"))
    least = F.element_at(F.create_map(*[F.lit(v) for m in MEASURES for v in (m, NARROWEST[m])]), F.col("measure"))
    wide = F.greatest((F.col("q3") - F.col("q1")) / unit, least) * reach
    band = F.struct((F.col("q1") / unit - wide).alias("low"), ((F.col("q3") + 1) / unit + wide).alias("high"))
    rows = picked.select("group", "size", "n_texts", "measure", band.alias("band"))
    chosen = [F.max(F.when(F.col("measure") == m, F.col("band"))).alias(m) for m in MEASURES]
    return rows.groupBy("group", "size").agg(F.first("n_texts").alias("n_texts"), *chosen)


def verdicts(docs: DataFrame, path: str, least_words: int = 10, most_repeated: int = 20, reach: float = REACH, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """``doc_id``, base counts, ``base_failed``, ``kept``, the measures and ``rejected_by`` (names of measures out of band) for every row.

    ``path`` is the vocabulary. A text fails the base rules with fewer than ``least_words`` words or with more than
    ``most_repeated`` percent of its words in five-word windows that it has twice. Others are kept if characters a token and
    entropy are within the band and the share of byte tokens isn't above it. Texts of fewer than 30 tokens, and of
    groups with fewer than ``least_texts`` texts up to the whole table, are judged by the base rules alone.

    Null texts are empty: no words, base_failed. Repeated rows are rows each, other columns are ignored, an empty table
    gives an empty result. Long texts are encoded in parts that give the same tokens.
    """
    texts = materialize(measured(docs, path), "fertility")
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeated)
    size = F.when(F.col("n_tokens") >= LEAST_TOKENS, F.floor(F.log2(F.greatest("word_chars", F.lit(1)))).cast("int"))
    texts = texts.withColumns({"base_failed": failed, "size": size})
    limits = materialize(bands(texts.where("not base_failed and size is not null"), reach).where(F.col("n_texts") >= least_texts), "fertility_bands")
    for k, group in enumerate(_groups()):
        level = limits.select(F.col("group").alias(f"g{k}"), F.col("size").alias(f"s{k}"), F.struct(*MEASURES).alias(f"b{k}"))
        texts = texts.join(level, (group == F.col(f"g{k}")) & (F.col("size") == F.col(f"s{k}")), "left")
    band = F.coalesce("b0", "b1", "b2")
    low = [(F.col(m) < band[m]["low"]) if m != "byte_share" else F.lit(False) for m in MEASURES]
    out = [F.when(under | (F.col(m) > band[m]["high"]), F.lit(m)) for m, under in zip(MEASURES, low)]
    by = F.array_compact(F.array(*out))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kept = ~F.col("base_failed") & (F.size(by) == 0)
    return texts.select("doc_id", *counts, "base_failed", kept.alias("kept"), "n_tokens", *MEASURES, by.alias("rejected_by"))
