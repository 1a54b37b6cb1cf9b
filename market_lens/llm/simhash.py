"""Near-duplicates by SimHash with deletion-variant signatures.

A fingerprint of 64 bits is cut into so few segments that two fingerprints within the
distance differ by one bit at most in one of them (two segments for a distance of 3). The
variants of a segment with one bit wiped are the index: two segments agree on a variant
when they are equal or differ in that bit alone. Variants are made of the *different
segment values*, so a variant has two values at most and no copy, however frequent, makes a
large group. Fingerprints meet by equality joins on the segment values so found and are
verified by their full distance; only a spanning forest of the verified links leaves a
task, and connected components finish the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from market_lens.llm.common import free_name, runs
from market_lens.llm.graph import components
from market_lens.sources.scratch import materialize

BITS = 64
#: Fingerprints of one block; a segment value with more is split into blocks that meet pair by pair.
BLOCK = 2048

_LANES = np.uint64(0x0101010101010101)


def _count_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of ``hashes`` have bit i, for each i."""
    counts = np.zeros(BITS, np.int64)
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    for bit in range(8):
        # eight byte-wide counters in a word hold sums of up to 255 rows
        lanes = ((padded >> np.uint64(bit)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[bit::8] += lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint_of(text: bytes | None, words: int, step: int = 1 << 16) -> int:
    """The unsigned fingerprint of a UTF-8 text; long texts are taken ``step`` shingles at a time."""
    tokens = (text or b"").lower().split()  # bytes: A-Z only, and cut at the six ASCII spaces
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, n, step):
        end = min(n, start + step)
        if n == 1:
            shingles = [b" ".join(tokens)]
        else:
            shingles = map(b" ".join, zip(*[tokens[start + k : end + k] for k in range(words)], strict=True))
        counts += _count_bits(np.array([xxh64_intdigest(s, 42) for s in shingles], np.uint64))
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprint(text: Column, words: int = 3) -> Column:
    """The fingerprint of a text column as a (signed) long; null has no words, like the empty text."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        prints = np.array([fingerprint_of(t.as_py(), words) for t in texts], np.uint64)
        return pa.array(prints.view(np.int64), pa.int64())

    return simhash(text.cast("binary"))


def _forest(prints: np.ndarray, left: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest over all pairs within ``distance``, between the two sides or within the one."""
    n = len(prints)
    root = np.arange(n)
    ours = np.flatnonzero(left)
    theirs = np.flatnonzero(~left)
    across = len(theirs) > 0
    for k, i in enumerate(ours.tolist()):
        others = theirs if across else ours[k + 1 :]
        near = others[np.bitwise_count(prints[others] ^ prints[i]) <= distance]
        for j in near[root[near] != root[i]].tolist():
            if root[j] != root[i]:
                yield int(prints[i]), int(prints[j])
                root[root == root[j]] = root[i]


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """``a, b``: links that connect all fingerprints (column ``fp``, each once) within ``distance``."""
    # The fewest segments of which one has no more than one differing bit. A segment has 32 bits at most.
    parts = max(2, -(-(distance + 1) // 2))
    width = -(-BITS // parts)
    mask = (1 << width) - 1
    segments = [F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit(mask)) for s in range(parts)]
    keyed = prints.select("fp", F.posexplode(F.array(*segments)).alias("s", "v"))

    values = keyed.groupBy("s", "v").agg(F.count("*").alias("n"))
    values = materialize(values.select("s", "v", F.ceil(F.col("n") / BLOCK).alias("blocks"), "n"), "segments")

    # A value and its blocks share a long, so the two values of a variant are a minimum and a maximum.
    packed = F.shiftleft("v", 31).bitwiseOR(F.col("blocks")).alias("packed")
    bits = F.explode(F.sequence(F.lit(0), F.lit(width - 1)))
    spread = values.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s", "v")
    wiped = spread.select("s", "v", packed, bits.alias("bit"))
    rest = F.col("v").bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, bit)"))).alias("rest")
    near = wiped.select("s", "bit", rest, "packed").groupBy("s", "bit", "rest")
    near = near.agg(F.min("packed").alias("x"), F.max("packed").alias("y")).where("x < y")

    def unpacked(name: str) -> Column:
        blocks = F.col(name).bitwiseAND(F.lit((1 << 31) - 1))
        return F.struct(F.shiftrightunsigned(name, 31).alias("v"), blocks.alias("blocks")).alias(name)

    near = near.select("s", unpacked("x"), unpacked("y"))
    same = values.where("n > 1").select("s", F.struct("v", "blocks").alias("x"), F.struct("v", "blocks").alias("y"))

    # One unit of work for each pair of blocks; both sides of a unit are bounded.
    unit = near.union(same).select("s", "x", "y", F.explode(F.sequence(F.lit(0), F.col("x.blocks") - 1)).alias("i"))
    unit = unit.select("*", F.explode(F.sequence(F.lit(0), F.col("y.blocks") - 1)).alias("j"))
    unit = unit.where("x.v <> y.v or i <= j")
    unit = unit.withColumn("unit", F.xxhash64("s", "x.v", "y.v", "i", "j"))
    one_side = F.array(F.struct(F.col("x.v").alias("v"), F.col("i").alias("block"), F.lit(True).alias("left")))
    two_sides = F.concat(
        one_side, F.array(F.struct(F.col("y.v").alias("v"), F.col("j").alias("block"), F.lit(False).alias("left")))
    )
    alone = F.expr("x.v = y.v and i = j")
    sides = unit.select("unit", "s", F.inline(F.when(alone, one_side).otherwise(two_sides)))

    blocked = keyed.join(values.select("s", "v", "blocks"), ["s", "v"])
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64("fp"), "blocks"))
    work = sides.join(blocked.select("s", "v", "block", "fp"), ["s", "v", "block"]).select("unit", "left", "fp")
    work = work.repartition("unit").sortWithinPartitions("unit")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for group in runs(batches, "unit"):
            fp = group.column("fp").to_numpy().view(np.uint64)
            out.extend(_forest(fp, group.column("left").to_numpy(zero_copy_only=False).astype(bool), distance))
            if len(out) > 50_000:
                yield _pairs(out)
                out = []
        if out:
            yield _pairs(out)

    return work.mapInArrow(verify, "a long, b long")


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(out, np.uint64).view(np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def classes(thin: DataFrame, distance: int = 3) -> DataFrame:
    """``fp, root, component_id`` for every fingerprint of ``thin`` (``doc_id, fp``).

    ``root`` is the smallest fingerprint of the component, ``component_id`` its smallest doc_id.
    """
    prints = materialize(thin.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprints")
    linked = components(links(prints.select("fp"), distance))
    rooted = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Links run between fingerprints that differ in ``distance`` bits or fewer; a component
    is named by the smallest id in it. A null text is the empty text; texts without words
    have fingerprint zero and are linked like any other. Fewer words than a shingle are one
    shingle. Repeated rows each return a row. A row without an id takes part and returns a
    null id; a component of such rows alone is null. An empty table gives an empty result.
    """
    thin = materialize(docs.select(F.col(id).alias("doc_id"), fingerprint(F.col(text), words).alias("fp")), "thin")
    joined = thin.join(classes(thin, distance), "fp")
    hexes = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return joined.select("doc_id", hexes.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the one with the smallest id.

    Rows with that id that repeat are kept once; of different rows under one id in one
    component, the one with the smallest fingerprint and text hash stays. Where no row of a
    component has an id, the smallest by these stays.
    """
    mark, key = free_name(docs, "print"), free_name(docs, "digest")
    marked = docs.withColumn(mark, fingerprint(F.col(text), words)).withColumn(key, F.xxhash64(text))
    thin = materialize(marked.select(F.col(id).alias("doc_id"), F.col(mark).alias("fp"), F.col(key).alias("h")), "thin")
    best = thin.join(classes(thin, distance), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = Window.partitionBy("root").orderBy("fp", "h")
    best = best.withColumn("n", F.row_number().over(first)).where("n = 1").select("doc_id", "h")
    best = best.toDF(own := free_name(docs, "kept_id"), same := free_name(docs, "kept_digest"))
    hashed = docs.withColumn(key, F.xxhash64(text))
    kept = hashed.join(best, F.col(id).eqNullSafe(F.col(own)) & (F.col(key) == F.col(same)), "left_semi")
    again = free_name(kept, "again")
    one = Window.partitionBy(id, key).orderBy(key)
    return kept.withColumn(again, F.row_number().over(one)).where(F.col(again) == 1).select(*docs.columns)
