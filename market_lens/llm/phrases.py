"""Collocations of two to four words by prefix-free parsing.

Texts are cut into pieces at punctuation, and pieces into chunks: a chunk ends where the hash
of its last three words is divisible by ``MODULUS``, and the next one starts with these three
words. So equal passages give equal chunks wherever they stand, and every phrase of at most
four words lies within a chunk. The distinct chunks with their frequencies are the dictionary,
and all counting is done on it: a phrase counts with its chunk's frequency, and only in the
chunk in which it starts ``starts`` words from the beginning, so overlaps count once.

Phrases grow by a word at a time: a phrase that occurs often enough has parts that do, so a
phrase is only spelled out if both of its parts, one word shorter, may. That test is a bitmap
of fixed size over hashes: a false hit costs a row and no phrase is lost.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from market_lens.llm.common import pieces
from market_lens.sources.scratch import materialize

LONGEST = 4
OVERLAP = LONGEST - 1
#: One in so many three-word windows ends a chunk.
MODULUS = 16
#: Bytes of text that are parsed at a time; a longer piece is cut there, with the overlap.
SEGMENT = 1 << 20
#: Bits of the map of possible phrases (8 MB).
BITS = 26

_FACTOR = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
#: Lower case, tabs as spaces, marks and line ends as piece ends.
_PLAIN = bytes.maketrans(
    string.ascii_uppercase.encode() + b"\t.,;:!?\x0b\x0c\r", string.ascii_lowercase.encode() + b" " + b"\n" * 9
)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2**64."""

    def table(factor: int) -> np.ndarray:
        steps = np.full(2 * SEGMENT, factor, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return table(_FACTOR), table(pow(_FACTOR, -1, 1 << 64))


class Hasher:
    """Hashes of any spans of a buffer of at most ``2 * SEGMENT`` bytes, from prefix sums.

    Longer buffers are summed in blocks, whose sums are carried over.
    """

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers()
        self.size = len(powers)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        carry = np.uint64(0)
        for start in range(0, len(data), self.size):
            block = data[start : start + self.size].astype(np.uint64) + np.uint64(1)
            block *= powers[: len(block)]
            block *= np.uint64(pow(_FACTOR, start, 1 << 64))
            np.cumsum(block, out=block)
            block += carry
            carry = block[-1]
            self.sums[start + 1 : start + 1 + len(block)] = block

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = self.sums[ends] - self.sums[starts]
        h *= self.inverse[starts % self.size]
        if len(self.sums) > self.size:
            step = pow(pow(_FACTOR, -1, 1 << 64), self.size, 1 << 64)
            blocks = [pow(step, k, 1 << 64) for k in range((len(self.sums) - 1) // self.size + 1)]
            h *= np.array(blocks, np.uint64)[starts // self.size]
        h += (ends - starts).astype(np.uint64)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h


def normalized(text: bytes) -> bytes:
    """Pieces of a text, each on a line, words one space apart."""
    return b"\n".join(b" ".join(piece.split()) for piece in text.translate(_PLAIN).split(b"\n"))


def _segments(text: bytes) -> Iterator[tuple[int, int, bool]]:
    """Spans of about ``SEGMENT`` bytes that end with a piece, or else with a word; whether the piece ends there."""
    start = 0
    while start < len(text):
        if len(text) - start <= SEGMENT:
            yield start, len(text), True
            return
        end = text.rfind(b"\n", start, start + SEGMENT)
        if end > start:
            yield start, end, True
            start = end + 1
            continue
        end = text.find(b" ", start + SEGMENT)
        line = text.find(b"\n", start + SEGMENT)
        if line >= 0 and (end < 0 or line < end) or end < 0:
            end = line if line >= 0 else len(text)
            yield start, end, True
            start = end + 1
            continue
        yield start, end, False
        back = end
        for _ in range(OVERLAP):  # the next segment starts with the last words of this one
            back = max(start, text.rfind(b" ", start, back))
        start = back + 1


def chunks(data: bytes, open_end: bool = False, modulus: int = MODULUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of normalized pieces, and how many words count in each.

    With ``open_end`` the last piece goes on elsewhere, from its last three words.
    """
    raw = np.frombuffer(data, np.uint8)
    breaks = np.flatnonzero((raw == 32) | (raw == 10))
    start, end = np.append(0, breaks + 1), np.append(breaks, len(raw))
    line = np.append(0, np.cumsum(raw[breaks] == 10))  # the piece of each word
    filled = end > start
    start, end, line = start[filled], end[filled], line[filled]
    n = len(start)
    if not n:
        return start, end, start
    opens = np.append(True, line[1:] != line[:-1])
    closes = np.append(opens[1:], True)
    place = np.arange(n) - np.flatnonzero(opens)[np.cumsum(opens) - 1]  # of a word in its piece
    fires = np.zeros(n, bool)
    last = np.flatnonzero((place > OVERLAP - 1) & ~closes)  # may end a chunk
    fires[last] = Hasher(raw)(start[last - OVERLAP + 1], end[last]) % np.uint64(modulus) == 0
    first_word = np.sort(np.append(np.flatnonzero(opens), np.flatnonzero(fires) - OVERLAP + 1))
    last_word = np.sort(np.append(np.flatnonzero(closes), np.flatnonzero(fires)))
    words = last_word - first_word + 1
    whole = closes[last_word]
    if open_end:
        whole[-1] = False
    counted = np.where(whole, words, words - OVERLAP)
    kept = counted > 0
    return start[first_word[kept]], end[last_word[kept]], counted[kept]


def dictionary(docs: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """``lang, chunk, starts, freq`` of the distinct chunks of ``lang, text``, written to the shared folder."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, at = batch.column(0), 0
            for part in pieces(batch.column(1), 1 << 19):
                found: list[bytes] = []
                counted, rows = [], []

                def take(data: bytes, open_end: bool, row) -> None:
                    start, end, n = chunks(data, open_end, modulus)
                    found.extend([data[s:e] for s, e in zip(start.tolist(), end.tolist())])
                    counted.append(n)
                    rows.append(row(data, start))

                texts = [normalized(t.as_buffer().to_pybytes()) for t in part]
                if len(texts) > 1:  # short texts, parsed at once; a line break more ends each
                    joined = b"\n".join(texts)
                    edges = np.cumsum([len(t) + 1 for t in texts])
                    take(joined, False, lambda data, start: np.searchsorted(edges, start, side="right"))
                    if found:
                        yield made(langs.slice(at, len(texts)), found, counted, rows)
                else:
                    for s, e, ends in _segments(texts[0]):
                        take(texts[0][s:e], not ends, lambda data, start: np.zeros(len(start), np.int64))
                        if found:
                            yield made(langs.slice(at, 1), found, counted, rows)
                        found, counted, rows = [], [], []
                at += len(texts)

    def made(langs, found, counted, rows) -> pa.RecordBatch:
        columns = [langs.take(pa.array(np.concatenate(rows))), pa.array(found, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(counted), pa.int32())], ["lang", "chunk", "starts"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    parsed = rows.where("octet_length(text) > 0").mapInArrow(parse, "lang string, chunk string, starts int")
    counts = parsed.groupBy("lang", "chunk", "starts").agg(F.count("*").alias("freq"))
    return materialize(counts, "phrase_chunks")


def _spots(langs: pa.Array, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places in the bitmap: hashes of phrases, told apart by language."""
    coded = langs.dictionary_encode()
    seeds = []
    for name in coded.dictionary.to_pylist():
        data = np.frombuffer(name.encode(), np.uint8)
        seeds.append(Hasher(data)(np.zeros(1, np.int64), np.array([len(data)]))[0])
    mixed = hashes ^ np.array(seeds, np.uint64)[coded.indices.to_numpy()][rows]
    mixed *= np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def _words(chunk: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer of all chunks; start, end and row of each word, and its place in its row."""
    binary = chunk.cast(pa.binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int32)[binary.offset : binary.offset + len(binary) + 1].astype(np.int64)
    data = binary.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes()
    offsets = offsets - offsets[0]
    raw = np.frombuffer(data, np.uint8)
    starts = np.zeros(len(raw) + 1, bool)
    starts[1:] = raw == 32
    starts[offsets[:-1]] = True
    start = np.flatnonzero(starts)
    ends = np.zeros(len(raw) + 1, bool)
    ends[:-1] = raw == 32
    ends[offsets[1:]] = True
    end = np.flatnonzero(ends)
    row = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets[:-1])
    return data, start, end, row, np.arange(len(start)) - first[row]


def possible(frequent: DataFrame) -> np.ndarray:
    """The bitmap of the phrases of ``lang, phrase``: at most ``2**BITS`` bits, however many phrases."""

    @F.arrow_udf("long")
    def spot(langs: pa.Array, phrases: pa.Array) -> pa.Array:
        out = []
        at = 0
        for part in pieces(phrases, SEGMENT):
            binary = part.cast(pa.binary())
            offsets = np.frombuffer(binary.buffers()[1], np.int32)[binary.offset : binary.offset + len(binary) + 1].astype(np.int64)
            raw = np.frombuffer(binary.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            hashes = Hasher(raw)(offsets[:-1] - offsets[0], offsets[1:] - offsets[0])
            out.append(_spots(langs.slice(at, len(part)), hashes, np.arange(len(part))))
            at += len(part)
        return pa.array(np.concatenate(out) if out else [], pa.int64())

    spots = frequent.select(spot("lang", "phrase").alias("spot"))
    words = spots.groupBy(F.shiftright("spot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"))
    found = words.toArrow()
    bits = np.zeros(1 << (BITS - 6), np.int64)
    bits[found["at"].to_numpy()] = found["bits"].to_numpy()
    return bits


def longer(spark: SparkSession, chunked: DataFrame, frequent: DataFrame, words: int, least: int) -> DataFrame:
    """``lang, phrase, f`` of the phrases of so many words that occur ``least`` times, from the ``frequent`` ones a word shorter."""
    shared = spark.sparkContext.broadcast(possible(frequent))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = 0
            for part in pieces(batch.column(1), SEGMENT):
                langs, limit, freq = (batch.column(k).slice(at, len(part)) for k in (0, 2, 3))
                at += len(part)
                data, start, end, row, place = _words(part)
                if len(start) < words:
                    continue
                short = len(start) - words + 2  # phrases a word shorter
                spots = _spots(langs, Hasher(np.frombuffer(data, np.uint8))(start[:short], end[words - 2 :]), row[:short])
                may = bits[spots >> 6] >> (spots & 63) & 1 == 1
                n = len(start) - words + 1
                same = (row[:n] == row[words - 1 :]) & (place[:n] < limit.to_numpy()[row[:n]])
                hits = np.flatnonzero(same & may[:n] & may[1:])
                spelled = [data[s:e] for s, e in zip(start[hits].tolist(), end[hits + words - 1].tolist())]
                rows = pa.array(row[hits])
                columns = [langs.take(rows), pa.array(spelled, pa.binary()).cast(pa.string()), freq.take(rows)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "freq"])

    spelled = chunked.select("lang", "chunk", "starts", "freq").mapInArrow(spell, "lang string, phrase string, freq long")
    counts = spelled.groupBy("lang", "phrase").agg(F.sum("freq").alias("f")).where(F.col("f") >= least)
    return materialize(counts.withColumn("words", F.lit(words)), "phrases")


def _big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def _part(first: Column | int, n: Column) -> Column:
    return F.array_join(F.slice("w", first, n), " ")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, longest: int = LONGEST, cover: int = 80, modulus: int = MODULUS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of 2 to ``longest`` (4 at most) words.

    ``a`` is the phrase's count, at least ``least``; ``l`` and ``r`` those of its two parts at the weakest
    cut, ``n`` the language's words, ``score`` two million times a / (l + r), rounded down. A phrase of
    which ``cover`` percent or more lie in a longer one is left out. All counts are exact and over all rows.

    Null texts are empty, a null language is ``und``. Rows that repeat count each, other columns are
    ignored, an empty table gives an empty result. Texts of any length are parsed in bounded segments.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    spark = docs.sparkSession
    chunked = dictionary(docs, modulus)
    totals = materialize(chunked.groupBy("lang").agg(F.sum(F.col("freq") * F.col("starts")).alias("n")), "phrase_totals")
    word = F.explode(F.slice(F.split("chunk", " "), F.lit(1), F.col("starts"))).alias("phrase")
    single = chunked.select("lang", "freq", word).groupBy("lang", "phrase").agg(F.sum("freq").alias("f"))
    levels = [materialize(single.where(F.col("f") >= least).withColumn("words", F.lit(1)), "phrases")]
    for words in range(2, longest + 1):
        levels.append(longer(spark, chunked, levels[-1], words, least))

    known = levels[0]
    for level in levels[1:]:
        known = known.unionByName(level)
    candidates = known.where("words > 1").withColumn("w", F.split("phrase", " "))
    n = F.size("w")
    cut = F.explode(F.sequence(F.lit(1), n - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "w", cut)
    cuts = cuts.select("lang", "phrase", "a", "k", _part(1, F.col("k")).alias("head"), _part(F.col("k") + 1, F.size("w") - F.col("k")).alias("tail"))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    sides = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    # Decimal products are exact beyond 64 bits.
    exact = F.expr("cast(a as decimal(20,0)) * cast(2000000 as decimal(8,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = sides.select("lang", "phrase", "a", exact.cast("long").alias("score"), "k", "l", "r")
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    ranked = scored.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")

    inner = [
        F.struct(_part(F.lit(start), F.lit(size)).alias("phrase"), (F.size("w") >= start + size - 1).alias("fits"), F.lit(size).alias("size"))
        for size in range(2, longest)
        for start in range(1, longest - size + 2)
    ]
    if inner:
        within = candidates.where("words > 2").select("lang", F.col("f").alias("outer"), n.alias("of"), F.inline(F.array(*inner)))
        within = within.where("fits and size < of").groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
        ranked = ranked.join(within, ["lang", "phrase"], "left")
        covered = _big("outer") * F.lit(100).cast("decimal(4,0)") >= _big("a") * F.lit(cover).cast("decimal(4,0)")
        ranked = ranked.where(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
