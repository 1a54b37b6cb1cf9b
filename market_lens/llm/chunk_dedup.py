"""Substring deduplication by content-defined chunking with a gear rolling hash.

The gear hash of a position depends on the 32 bytes before it alone. A text is cut at the
word starts whose hash is the highest within ``reach`` bytes on either side, so chunks
depend on what stands near them and an insertion shifts nothing but the chunks it touches.
In a run of more than ``LONG_RUN`` bytes without white space (Chinese, Japanese, Thai) every
character start counts as a word start, and ``WORD_BYTES`` bytes as a word.
The digest of ``WINDOW`` chunks in a row is a duplicate if it occurs more than once; runs of
duplicate windows of at least ``min_words`` words are repeated passages. The occurrence in the
smallest document (and there the first) stays, the chunks of all others are cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from market_lens.llm.common import free_name, pieces
from market_lens.sources.scratch import materialize

#: Bytes to either side over which a cut is the highest: chunks are longer than this, about 2 * REACH on average.
REACH = 16
#: Chunks of a window: about 100 bytes.
WINDOW = 3
#: A passage is found if this many words of it lie in duplicate windows. Its ends may lie in chunks of other texts.
MIN_WORDS = 20
#: Runs without white space of more bytes than this are cut inside; so many bytes of them are a word.
LONG_RUN, WORD_BYTES = 32, 6
#: Where no place is the highest (one character again and again) a text is cut after so many bytes.
MOST_BYTES = 4096

_GEAR = np.random.default_rng(20240229).integers(1, 1 << 32, 256, np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash h = 2 * h + G[byte] (mod 2**32) after each byte, by doubling the summed width."""
    h = _GEAR[data]
    width = 1
    while width < 32:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def _highest(values: np.ndarray, reach: int) -> np.ndarray:
    """The maximum over the ``reach`` places after each."""
    padded = np.concatenate([values[1:], np.zeros(reach, values.dtype)])
    width, best = 1, padded.copy()
    while width * 2 <= reach:
        best[:-width] = np.maximum(best[:-width], best[width:])
        width *= 2
    rest = reach - width
    if rest:
        best[:-rest] = np.maximum(best[:-rest], best[rest:])
    return best[: len(values)]


def cut(data: bytes, reach: int = REACH) -> np.ndarray:
    """Where chunks start and end: 0, the cuts, and the length. Cuts are word starts or characters of long runs, never
    inside a character."""
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    turns = np.flatnonzero(np.diff(space, prepend=True, append=True))
    long = np.flatnonzero(turns[1::2] - turns[::2] > LONG_RUN)
    if len(long):
        inside = np.concatenate([np.arange(turns[2 * k] + 1, turns[2 * k + 1]) for k in long.tolist()])
        starts = np.sort(np.concatenate([starts, inside[raw[inside] & 0xC0 != 0x80]]))
    score = np.zeros(n, np.uint32)
    score[starts] = gear(raw)[starts - 1] | np.uint32(1)
    # of equal hashes the first is the cut
    best = (score > 0) & (score >= _highest(score, reach)) & (score > _highest(score[::-1], reach)[::-1])
    edges = np.concatenate([[0], np.flatnonzero(best), [n]])
    edges = edges[np.concatenate([[True], np.diff(edges) > 0])]
    if np.diff(edges).max() > MOST_BYTES:
        edges = _forced(raw, edges)
    return edges


def _forced(raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = [edges[:1]]
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        more = np.arange(start + MOST_BYTES, end, MOST_BYTES)
        for k, at in enumerate(more.tolist()):
            while at < end and raw[at] & 0xC0 == 0x80:  # inside a character
                at += 1
            more[k] = at
        out += [np.unique(more[more < end]), [end]]
    return np.concatenate(out)


def _digests(data: bytes, edges: np.ndarray) -> np.ndarray:
    """A digest for every window of chunks; a text of fewer chunks is one window. Outer white space doesn't count."""
    n = len(edges) - 1
    if n < 1:
        return np.zeros(0, np.uint64)
    view = memoryview(data)
    at = edges.tolist()
    size = min(WINDOW, n)
    text = [xxh3_64_intdigest(bytes(view[at[k] : at[k + size]]).strip()) for k in range(n - size + 1)]
    return np.array(text, np.uint64)


def _thin(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("doc_id"), _digest(text).alias("digest"), F.col(text).cast("binary").alias("text"))


def _digest(text: str) -> Column:
    """Tells texts of one id, or without one, apart: 64 bits, since millions may have no id."""
    return F.xxhash64(text)


def windows(docs: DataFrame, id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """``doc_id, digest, place, window``: the digest of each window of chunks; ``digest`` is that of the text."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, found, held = [], [], 0
            for row, value in enumerate(batch.column(2)):
                data = value.as_py() or b""
                found.append(_digests(data, cut(data, reach)))
                owners.append(row)
                held += len(found[-1])
                if held > 50_000:
                    yield _rows(batch, owners, found)
                    owners, found, held = [], [], 0
            if held:
                yield _rows(batch, owners, found)

    return _thin(docs, id, text).mapInArrow(one, "doc_id long, digest long, place int, window long")


def _rows(batch: pa.RecordBatch, owners: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
    sizes = [len(f) for f in found]
    rows = pa.array(np.repeat(owners, sizes))
    places = np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])
    columns = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(places)]
    columns.append(pa.array(np.concatenate(found).view(np.int64)))
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "place", "window"])


def repeated(docs: DataFrame, id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """``doc_id, digest, places``: for each document with a duplicate window, ``[(place, extra, first_id)]`` in order.

    ``extra`` is false where this document holds the occurrence that stays, ``first_id`` is
    the document that holds it.
    """
    found = materialize(windows(docs, id, text, reach), "chunk_windows")
    # Most windows occur once: they are counted thin, and only the others look for their first occurrence.
    twice = found.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
    found = materialize(found.join(twice.select("window"), "window"), "repeated_windows")
    owner = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "place")
    marked = found.join(found.groupBy("window").agg(F.min(owner).alias("first")), "window")
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))
    extra = ~(own & (F.col("place") == F.col("first.place")))
    place = F.struct("place", extra.alias("extra"), F.col("first.doc_id").alias("first_id"))
    # a document's own windows; repeated rows fall together
    return marked.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set(place)).alias("places"))


def _passages(data: bytes, places: list, min_words: int, reach: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], set]:
    """Repeated passages of a text, those to be cut out, as byte spans, and the documents that hold the others."""
    edges = cut(data, reach)
    n = len(edges) - 1
    size = min(WINDOW, n)
    seen, extra = np.zeros(n + 1, np.int8), np.zeros(n + 1, np.int8)
    for p in places:
        seen[p["place"] : p["place"] + size] = 1
        if p["extra"]:
            extra[p["place"] : p["place"] + size] = 1
    spans = []
    for start, end in _stretches(seen):
        if _n_words(data, int(edges[start]), int(edges[end])) >= min_words:
            spans.append((start, end))
    gone, sources = [], set()
    for start, end in spans:
        part = np.zeros(n + 1, np.int8)
        part[start:end] = extra[start:end]
        gone += [(int(edges[a]), int(edges[b])) for a, b in _stretches(part)]
        sources |= {p["first_id"] for p in places if start <= p["place"] < end and p["extra"]}
    return [(int(edges[a]), int(edges[b])) for a, b in spans], gone, sources - {None}


def _n_words(data: bytes, start: int, end: int) -> int:
    """Words of a span. A part of a long run, also one whose rest lies outside the span, counts by its bytes."""
    words = data[start:end].split()
    sizes = [len(w) for w in words]
    wide = [n > LONG_RUN for n in sizes]
    for k, at, step in ((0, start, -1), (-1, end - 1, 1)):
        if words and not _SPACE[data[at]]:
            rest, place = 0, at + step
            while 0 <= place < len(data) and not _SPACE[data[place]] and rest <= LONG_RUN:
                rest, place = rest + 1, place + step
            wide[k] = wide[k] or sizes[k] + rest > LONG_RUN
    return sum(max(1, n // WORD_BYTES) if w else 1 for n, w in zip(sizes, wide, strict=True))


def _stretches(marks: np.ndarray) -> list[tuple[int, int]]:
    turns = np.flatnonzero(np.diff(marks, prepend=np.int8(0), append=np.int8(0)))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


def _cleaned(texts: pa.Array, listed: pa.Array, min_words: int, reach: int) -> pa.Array:
    """The four result columns of texts (bytes) with their places."""
    shown, n_passages, n_cut, kept_in = [], [], [], []
    for t, p in zip(texts, listed, strict=True):
        data, p = t.as_py(), p.as_py()
        spans, gone, sources = _passages(data, p, min_words, reach) if p else ([], [], set())
        if gone:
            edges = [0, *(x for span in gone for x in span), len(data)]
            data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        shown.append(data)
        n_passages.append(len(spans))
        n_cut.append(len(gone))
        kept_in.append(sorted(sources))
    columns = [pa.array(shown, pa.binary()).cast(pa.string()), pa.array(n_passages, pa.int32()), pa.array(n_cut, pa.int32())]
    return pa.StructArray.from_arrays([*columns, pa.array(kept_in, pa.list_(pa.int64()))], ["clean_text", "n_passages", "n_cut", "kept_in"])


def _in_pieces(texts: pa.Array, listed: pa.Array, min_words: int, reach: int) -> pa.Array:
    """``_cleaned``, a few megabytes of texts at a time: a batch holds thousands of texts."""
    done, at = [_cleaned(texts.slice(0, 0), listed.slice(0, 0), min_words, reach)], 0
    for part in pieces(texts):
        done.append(_cleaned(part, listed.slice(at, len(part)), min_words, reach))
        at += len(part)
    return pa.concat_arrays(done)


def cleaned(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, reach: int = REACH
) -> DataFrame:
    """The rows of ``docs`` with four columns more, whose names get underscores where ``docs`` has them.

    ``clean_text``: the text without the passages that are kept elsewhere. ``n_passages``:
    repeated passages in the text, kept ones too. ``n_cut``: spans that were cut out.
    ``kept_in``: sorted ids of the documents that keep what was cut out. A null text has a
    null ``clean_text`` and no passages; the empty text stays empty. Rows that repeat (same
    id and text) are one document and get the same result. Among documents without an id
    the one with the smallest digest keeps a passage; all others come before them.
    """
    own, same, places = (free_name(docs, n) for n in ("own_id", "own_digest", "places"))
    found = repeated(docs, id, text, reach).toDF(own, same, places)
    key = free_name(docs, "text_digest")
    marked = docs.withColumn(key, _digest(text))
    joined = marked.join(found, F.col(id).eqNullSafe(F.col(own)) & (F.col(key) == F.col(same)), "left")

    @F.arrow_udf("struct<clean_text string, n_passages int, n_cut int, kept_in array<long>>")
    def clean(texts: pa.Array, listed: pa.Array) -> pa.Array:
        return _in_pieces(texts, listed, min_words, reach)

    result = free_name(joined, "result")
    touched = joined.withColumn(result, clean(F.col(text).cast("binary"), F.col(places)))
    names = ["clean_text", "n_passages", "n_cut", "kept_in"]
    return touched.select(*docs.columns, *[F.col(result)[n].alias(free_name(docs, n)) for n in names])


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the cleaned text in place of the text; a document of which nothing is left is dropped."""
    done = cleaned(docs, id, text, min_words)
    new = done.columns[len(docs.columns) :]
    kept = done.where((F.col(new[2]) == 0) | (F.trim(new[0]) != ""))
    return kept.select(*[F.col(new[0]).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
