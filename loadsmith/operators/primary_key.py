"""PRIMARY KEY on load, and uniqueness checks that read only what a batch touched.

A keyed folder holds its rows by part: a hash of the key (``part=<n>``), so equal keys
meet in one part.  Beside them lies a sketch of each part: a bitmap of key hashes, one
row per 64 bits.  A batch is checked against the target in three steps: its keys look
up their bits (a join of a few bytes per key), the parts with a hit are read, and an
exact semi-join on those decides.  The check state has a row per part: rows and keys that occur
more than once; a batch renews the rows of the parts it touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.session import materialize

#: Rows of a part, and bits of a sketch per row.
PART_ROWS, BITS_PER_ROW = 1_000_000, 16
IN_BATCH, IN_TARGET, NO_KEY = "duplicate in batch", "in target", "no key"


def key_part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def part_count(rows: int) -> int:
    """Parts for a table that is expected to hold ``rows`` rows."""
    return max(-(-rows // PART_ROWS), 1)


def sketch_cells(rows: int, parts: int) -> int:
    return max(-(-rows * BITS_PER_ROW // (parts * 64)), 1)


def _cell_and_bit(key: str, cells: int) -> tuple[Column, Column]:
    bit = F.pmod(F.xxhash64(F.lit(0x5EED), key), F.lit(cells * 64))
    return F.floor(bit / 64).cast("int"), F.pmod(bit, F.lit(64)).cast("int")


def _bits(keys: DataFrame, key: str, parts: int, cells: int) -> DataFrame:
    cell, bit = _cell_and_bit(key, cells)
    return (keys.select(key_part(key, parts).alias("part"), cell.alias("cell"), bit.alias("bit"))
            .groupBy("part", "cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))


def append_keyed(rows: DataFrame, path: str, key: str, parts: int, cells: int) -> list[int]:
    """Append rows to a keyed folder, and their bits to its sketch; the parts that were touched.

    Rows of a batch that adds to a part lie in further files of it, so nothing is rewritten.
    """
    staged = materialize(rows.withColumn("part", key_part(key, parts)), "keyed-rows")
    staged.repartition("part", F.pmod(F.xxhash64(*rows.columns), F.lit(8))).write.mode("append").partitionBy("part").parquet(f"{path}/rows")
    _bits(staged, key, parts, cells).write.mode("append").parquet(f"{path}/sketch")
    return sorted(r["part"] for r in staged.select("part").distinct().collect())


def read_keyed(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """The rows of all parts, or of the named ones; other parts' files aren't opened."""
    rows = spark.read.parquet(f"{path}/rows")
    return rows if only is None else rows.filter(F.col("part").isin(only))


def suspect_parts(batch: DataFrame, path: str, key: str, parts: int, cells: int) -> list[int]:
    """Parts whose sketch has the bit of some key of the batch."""
    cell, bit = _cell_and_bit(key, cells)
    asked = (batch.filter(F.col(key).isNotNull())
             .select(key_part(key, parts).alias("part"), cell.alias("cell"), bit.alias("bit")).distinct())
    sketch = batch.sparkSession.read.schema("part int, cell int, bits bigint").parquet(f"{path}/sketch")
    hit = asked.join(sketch, ["part", "cell"]).filter(F.expr("(shiftright(bits, bit) & 1) = 1"))
    return sorted(r["part"] for r in hit.select("part").distinct().collect())


def key_violations(batch: DataFrame, path: str, key: str, parts: int, cells: int) -> tuple[DataFrame, list[int]]:
    """The batch with a column ``reasons`` (empty: the row may load), and the target's parts that were read.

    Every row of a key that occurs again in the batch breaks it, every row of a key that the
    target holds, and every row without a key.  Keys are counted before they are joined
    back, so one key may hold any share of the rows.
    """
    spark = batch.sparkSession
    suspects = suspect_parts(batch, path, key, parts, cells)
    twice = (batch.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_ls_k")).agg(F.count(F.lit(1)).alias("_ls_n"))
             .filter("_ls_n > 1").select("_ls_k", F.lit(IN_BATCH).alias("_ls_r")))
    held = read_keyed(spark, path, suspects).select(F.col(key).alias("_ls_k")).distinct()
    keys = batch.select(F.col(key).alias("_ls_k")).filter("_ls_k is not null").distinct()
    there = held.join(keys, "_ls_k", "left_semi").select("_ls_k", F.lit(IN_TARGET).alias("_ls_r"))
    broken = twice.unionByName(there).groupBy("_ls_k").agg(F.sort_array(F.collect_set("_ls_r")).alias("_ls_rs"))
    judged = batch.join(broken, batch[key] == F.col("_ls_k"), "left")
    none = F.array().cast("array<string>")
    reasons = F.when(F.col(key).isNull(), F.array(F.lit(NO_KEY))).otherwise(F.coalesce("_ls_rs", none))
    return judged.select(*batch.columns, reasons.alias("reasons")), suspects


def check_state(spark: SparkSession, path: str, key: str, only: list[int] | None = None) -> DataFrame:
    """part, n_rows, n_duplicate_keys of all parts, or of the named ones."""
    per_key = read_keyed(spark, path, only).groupBy("part", key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("part").agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_duplicate_keys"))


def renewed_state(state: DataFrame, path: str, key: str, touched: list[int]) -> DataFrame:
    """``check_state`` after a batch: the touched parts are counted anew, the others taken over."""
    return state.filter(~F.col("part").isin(touched)).unionByName(
        check_state(state.sparkSession, path, key, touched))
