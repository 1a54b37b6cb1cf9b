"""What the operators of this folder share."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def held_out(key: str | Column, folds: int = 5) -> Column:
    """Rows kept from fitting: crc32 of the key as text is divisible by ``folds``; a null key is kept too."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(True))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are.

    ``lower`` is many times faster than ``translate`` and the same for pure ASCII.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def tasks(df: DataFrame) -> int:
    """Tasks for rows that cost more than their bytes: as many as the session's shuffles, or as its cores."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of equal ``key`` out of batches that are sorted by it. Holds one run at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if held and values[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = values[start]
    if held:
        yield pa.Table.from_batches(held)


def pieces(texts: pa.Array, most_bytes: int = 1 << 22) -> Iterator[pa.Array]:
    """Slices of an array of texts of about ``most_bytes`` each (one text at least)."""
    sizes = np.cumsum(np.fromiter((v or 0 for v in pc.binary_length(texts).to_pylist()), np.int64, len(texts)))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most_bytes, side="right")))
        yield texts.slice(start, end - start)
        start = end


def sample_by_hash(rows: DataFrame, by: str, most: int | Column, id: str = "doc_id") -> DataFrame:
    """At most ``most`` rows of each value of ``by``: those whose id has the smallest hash.

    A cut-off by the size of each group leaves about twice as many rows before any group is
    ordered, so a value that most rows have makes no large group. The sizes are broadcast: a
    row for each label of a model, which holds weights for every one of them.
    """
    most = F.lit(most) if isinstance(most, int) else most
    sizes = rows.groupBy(by).agg(F.count("*").alias("n_of_group"))
    hashed = rows.join(F.broadcast(sizes), by).withColumn("hash_of_id", F.pmod(F.xxhash64(id), F.lit(1 << 30)) / (1 << 30))
    near = hashed.where(F.col("hash_of_id") * F.col("n_of_group") <= 2 * most)
    first = Window.partitionBy(by).orderBy("hash_of_id", id)
    return near.withColumn("n_of_group", F.row_number().over(first)).where(F.col("n_of_group") <= most).select(*rows.columns)
