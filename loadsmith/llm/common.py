"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.session import materialize

#: Rows (of a few long columns) up to which a key list may be broadcast; beyond, joins shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> list[Column]:
    """Two independent 64-bit hashes of a text (null and '' differ); columns k1 and k2."""
    col, kind = F.col(text), F.when(F.col(text).isNull(), 0).otherwise(1)
    return [F.xxhash64(kind, col).alias("k1"), F.xxhash64(F.lit(0x5EED), kind, col).alias("k2")]


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows (counted), else unchanged."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def number_rows(df: DataFrame, order: list[str], name: str = "rank") -> tuple[DataFrame, int]:
    """``df`` with a gapless 0-based number in the given order, and the number of rows.

    Range-partitions and sorts, writes that once to the shared folder with each
    row's partition and place, then adds per-partition offsets: no task ever sees
    all rows.  The write pins the sampled range bounds, so a lost executor cannot
    renumber rows.  The offsets are one row per partition.
    """
    spark = df.sparkSession
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    placed = materialize(placed, f"number-{name}")
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "_part int, _start long")
    numbered = placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_start") + F.col("_at"))
    return numbered.drop("_part", "_at", "_start"), total


class Remembered(dict):
    """A function's results by argument, forgotten when ``most`` are kept: bounded memory."""

    def __init__(self, fn: Callable, most: int = 300_000):
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.fn(key)
        return value


def word_hashes(words: list[bytes], known: Remembered) -> np.ndarray:
    """64-bit hash of each word; ``known`` is ``Remembered(xxhash.xxh3_64_intdigest)``."""
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def word_memory() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def in_slices(columns: list[list], rows: int = 50_000):
    """Cut equally long column lists into slices, so that output batches stay small."""
    for at in range(0, len(columns[0]) if columns else 0, rows):
        yield [c[at:at + rows] for c in columns]


def table_rows_in_blocks(df: DataFrame, text: str, rows: int, chars: int):
    """Rows of a stated query set, in lists of at most ``rows`` rows and about ``chars`` characters of ``text``."""
    block, size = [], 0
    for row in df.toLocalIterator():
        block.append(row)
        size += len(row[text] or "")
        if len(block) >= rows or size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def bound_batches(spark: SparkSession) -> None:
    """Settings for rows of long texts, whose number says little about their size.

    Batches that go to Python are bounded by bytes too, batches that scans make hold fewer
    rows, and Parquet writers hold smaller row groups before they write them out.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "1024")
    spark.conf.set("parquet.block.size", str(16 << 20))


def tidy(batches_fn: Callable) -> Callable:
    """A function of a task's batches that gives its memory back when the task ends, as workers live on."""
    @functools.wraps(batches_fn)
    def run(batches):
        yield from batches_fn(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return run
