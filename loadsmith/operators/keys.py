"""Dense surrogate keys (W1) and the current maximum key (A3).

``row_number() OVER (ORDER BY k)`` without a partition runs in one task.  Here
the rows are written once, so that their number is known, then range-partitioned
on the ordering (ties by a hash of the whole row, so a run of equal keys still
spreads over partitions and a task that is run again places rows alike), numbered
inside each partition with ``monotonically_increasing_id`` and shifted by the row
count of all earlier partitions.  The per-partition counts, one number each, are
brought to the driver and applied as a literal array.  The numbered frame is
written to the shared checkpoint folder and read back, so a re-execution (lost
executor, second action) cannot renumber rows and the counts and the rows always
come from the same copy.  The keys depend on the rows alone, not on the number of
partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadsmith.session import materialize, materialize_counted

_ROW_BITS = 33  # monotonically_increasing_id: partition id << 33 | row in partition
#: Rows of a numbered partition.
PARTITION_ROWS = 1_000_000


def current_max_key(df: DataFrame, key: str) -> int:
    """The largest key; 0 for an empty input (one number to the driver)."""
    return df.agg(F.coalesce(F.max(F.col(key).cast("bigint")), F.lit(0)).alias("top")).collect()[0]["top"]


def range_partitions(df: DataFrame, rows: int) -> int:
    """Partitions for numbering ``rows`` rows, counted: small inputs still use all cores."""
    cores = max(df.sparkSession.sparkContext.defaultParallelism, 1)
    return max(-(-rows // PARTITION_ROWS), min(cores, -(-rows // 10_000)), 1)


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def assign_surrogate_keys(df: DataFrame, key: str, order_by, start_after: int = 0,
                          num_partitions: int | None = None,
                          key_type: str = "bigint") -> DataFrame:
    """Add ``key`` = start_after + 1, 2, ... in ``order_by`` order, in parallel."""
    return keyed_with_max(df, key, order_by, start_after, num_partitions, key_type)[0]


def keyed_with_max(df: DataFrame, key: str, order_by, start_after: int = 0,
                   num_partitions: int | None = None,
                   key_type: str = "bigint") -> tuple[DataFrame, int]:
    """``assign_surrogate_keys`` plus the largest key handed out (no extra scan)."""
    order = _cols(order_by)
    staged, rows = materialize_counted(df.withColumn("_ls_tb", F.xxhash64(*df.columns)), "to-key")
    n = num_partitions or range_partitions(df, rows)
    ordered = (staged.repartitionByRange(n, *order, F.col("_ls_tb"))
               .sortWithinPartitions(*order, F.col("_ls_tb")))
    rid = F.monotonically_increasing_id()
    tagged = materialize(ordered.withColumn("_ls_rid", rid).drop("_ls_tb"), "keys")
    pid = F.shiftright("_ls_rid", _ROW_BITS)
    pos = F.col("_ls_rid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = dict(tagged.groupBy(pid.alias("p")).agg(F.count(F.lit(1))).collect())
    if sum(counts.values()) != rows or max(counts, default=0) >= n:
        raise RuntimeError("the numbered copy doesn't match its input")
    offsets, running = [], start_after
    for p in range(n):
        offsets.append(f"{running}L")
        running += counts.get(p, 0)
    first = F.expr(f"array({', '.join(offsets)})")[pid.cast("int")]
    return tagged.withColumn(key, (first + pos + 1).cast(key_type)).drop("_ls_rid"), running
