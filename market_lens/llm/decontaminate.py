"""Benchmark decontamination with DataFrame functions only.

The windows of the benchmark items (``span`` consecutive words; a shorter item is one
window) are a hash set that is broadcast. Each document's words are walked once: the hash
of the window that starts at a word is looked up, and where it is found the words
themselves are compared. Only verified hits and one thin row per document leave the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from market_lens.llm.common import ascii_lower, free_name
from market_lens.sources.scratch import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: In a text with capital letters: what stands before the first word, and a word with what follows it.
HEAD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
PART = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
SPAN = 10
#: Windows of one broadcast, about 100 bytes each. A larger benchmark is taken in several passes.
MOST_WINDOWS = 250_000


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _hash(words: str, start: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(words, start + k) for k in range(length)])


def windows_of(benchmark: DataFrame, id: str = "item_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """``length, words, hash, items``: each different window once, with the items (as text) that hold it."""
    items = benchmark.select(F.col(id).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    items = items.select("item", "words", F.size("words").alias("n")).where("n > 0")
    items = items.withColumn("length", F.least("n", F.lit(span)))
    starts = F.explode(F.sequence(F.lit(0), F.col("n") - F.col("length")))
    found = items.select("item", "length", "words", starts.alias("start"))
    found = found.select("item", "length", F.slice("words", F.col("start") + 1, F.col("length")).alias("words"))
    each = found.groupBy("length", "words").agg(F.collect_set("item").alias("items"))
    by_length = [F.when(F.col("length") == k, _hash("words", F.lit(0), k)) for k in range(1, span + 1)]
    return each.select("length", "words", F.coalesce(*by_length).alias("hash"), "items")


def hits(docs: DataFrame, windows: DataFrame, id: str = "doc_id", text: str = "text", span: int = SPAN) -> DataFrame:
    """One thin row for each document (``start`` -1) and one for each verified hit (``start``, ``length``, ``items``).

    ``doc_id`` and ``digest`` (of the text) name the document; ``n_words`` is its size.
    """
    windows = materialize(windows, "windows")
    sizes = windows.groupBy("length").count().collect()  # no more rows than ``span``
    lengths = sorted(r["length"] for r in sizes) or [span]
    parts = max(1, -(-sum(r["count"] for r in sizes) // MOST_WINDOWS))
    known = windows.select(F.col("words").alias("known"), F.col("hash").alias("known_hash"), "items")

    walked = docs.select(F.col(id).alias("doc_id"), F.xxhash64(text).alias("digest"), words_of(F.col(text)).alias("words"))
    walked = walked.withColumn("n_words", F.size("words"))
    # One walk for all lengths, in one generator: a second one would copy the words for every window.
    # -1 is the document's own row.
    kinds = len(lengths)
    steps = F.explode(F.sequence(F.lit(-1), F.greatest(F.lit(0), F.col("n_words") - lengths[0] + 1) * kinds - 1))
    walked = walked.select("doc_id", "digest", "n_words", "words", steps.alias("step"))
    at = F.floor(F.col("step") / kinds).cast("int")
    walked = walked.select("*", at.alias("start"), F.pmod("step", F.lit(kinds)).alias("kind"))
    at, hashed, length = F.col("start"), F.lit(None).cast("long"), F.lit(lengths[0])
    for k, size in enumerate(lengths):
        fits = (F.col("kind") == k) & (F.col("step") >= 0) & (at + size <= F.col("n_words"))
        hashed = F.when(fits, _hash("words", at, size)).otherwise(hashed)
        length = F.when(F.col("kind") == k, F.lit(size)).otherwise(length)
    walked = walked.select("*", hashed.alias("hash"), length.alias("length"))

    passes = []
    for part in range(parts):
        some = known.where(F.pmod("known_hash", F.lit(parts)) == part) if parts > 1 else known
        # Written with two inequalities: an equality would become a join key, made for every window.
        verified = F.slice("words", at + 1, F.col("length")).between(F.col("known"), F.col("known"))
        same = (F.col("hash") == F.col("known_hash")) & verified
        found = walked.join(F.broadcast(some), same, "left")
        own_row = F.col("start") < 0 if part == 0 else F.lit(False)
        passes.append(found.where(own_row | F.col("known_hash").isNotNull()))
    return reduce(DataFrame.union, passes).select("doc_id", "digest", "n_words", "start", "length", "items")


def _covered(spans: Column) -> Column:
    """How many words lie in any of the sorted spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        new = F.greatest(F.lit(0), end - F.greatest(span["start"], state["end"]))
        return F.struct(F.greatest(end, state["end"]).alias("end"), (state["n"] + new).alias("n"))

    return F.aggregate(spans, zero, add)["n"]


def per_document(found: DataFrame) -> DataFrame:
    """A row for each document out of ``hits``: its sizes, its items and its hit spans."""
    span = F.when(F.col("start") >= 0, F.struct("start", "length"))
    each = found.groupBy("doc_id", "digest").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(F.col("start") < 0, 1)).alias("rows"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return each.select(
        "doc_id",
        "digest",
        "n_words",
        _covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "spans",
        "items",
        "rows",
    ).withColumn("contaminated", F.col("n_hit") > 0)


def report(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    A null or empty text has no words and no hits. Repeated rows each give a row. An item
    without words has no window; an item without an id hits, but is not listed. With an
    empty benchmark nothing is hit. Other columns are ignored.
    """
    each = per_document(hits(docs, windows_of(benchmark, span=span), id, text, span))
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def _marked(docs: DataFrame, benchmark: DataFrame, span: int, id: str, text: str) -> tuple[DataFrame, DataFrame, Column]:
    key = free_name(docs, "digest")
    bad = per_document(hits(docs, windows_of(benchmark, span=span), id, text, span)).where("contaminated")
    own, same, spans = (free_name(docs, n) for n in ("hit_id", "hit_digest", "hit_spans"))
    bad = bad.select(F.col("doc_id").alias(own), F.col("digest").alias(same), F.col("spans").alias(spans))
    marked = docs.withColumn(key, F.xxhash64(text))
    return marked, bad, F.col(id).eqNullSafe(F.col(own)) & (F.col(key) == F.col(same))


def drop_documents(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without a hit, with the columns of ``docs``; null and empty texts stay."""
    marked, bad, same = _marked(docs, benchmark, span, id, text)
    return marked.join(bad, same, "left_anti").select(*docs.columns)


def drop_spans(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs``; hit words, each with what follows it up to the next word, are cut out of ``text``."""
    marked, bad, same = _marked(docs, benchmark, span, id, text)
    joined = marked.join(bad, same, "left")
    spans = F.col(bad.columns[2])
    head = F.regexp_extract(text, HEAD, 0)
    parts = F.regexp_extract_all(F.col(text), F.lit(PART), F.lit(0))
    hit = lambda i: F.exists(spans, lambda s: (i >= s["start"]) & (i < s["start"] + s["length"]))
    cleaned = F.concat(head, F.array_join(F.filter(parts, lambda _, i: ~hit(i)), ""))
    out = [F.when(spans.isNull(), F.col(text)).otherwise(cleaned).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*out)
