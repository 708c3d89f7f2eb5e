"""Previous-version values (W2): LAG over a natural key, split-safe.

``LAG(c) OVER (PARTITION BY k ORDER BY o)`` puts every row of one key in one
task.  Method ``sequence`` range-partitions the rows once in (k, o) order, which
splits a heavy key, and takes LAG inside each partition; what a partition's first
row misses is the last row of the partitions before, so those last rows (one per
partition, broadcast) are carried over the boundary.  Rows are neither numbered nor joined
to each other.  Method ``auto`` (default) counts rows per key first (combined
map-side): keys with at most ``heavy_rows`` rows take the plain window, the
few heavy keys (at most total / ``heavy_rows`` of them) take the sequence path.
``window`` forces the plain window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.operators.keys import range_partitions
from loadsmith.session import materialize, materialize_counted


_BROADCAST_KEYS = 1_000_000  # heavy-key lists up to this size are broadcast


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def previous_values(df: DataFrame, partition_by, order_by, columns, prefix: str = "prev_",
                    method: str = "auto", heavy_rows: int = 1_000_000) -> DataFrame:
    parts, order, cols = _as_list(partition_by), _as_list(order_by), _as_list(columns)
    if method == "window":
        return _by_window(df, parts, order, cols, prefix)
    if method == "sequence":
        return _by_sequence(df, parts, order, cols, prefix)
    if method != "auto":
        raise ValueError(f"unknown method {method!r}")
    heavy = (df.groupBy(*parts).agg(F.count(F.lit(1)).alias("_ls_n"))
             .filter(F.col("_ls_n") > heavy_rows).select(*parts))
    if heavy.limit(1).count() == 0:
        return _by_window(df, parts, order, cols, prefix)
    # at most total_rows / heavy_rows keys; counted before it is broadcast
    heavy = materialize(heavy, "heavy_keys")
    side = F.broadcast(heavy) if heavy.count() <= _BROADCAST_KEYS else heavy
    on = [df[p].eqNullSafe(heavy[p]) for p in parts]
    light = df.join(side, on, "left_anti")
    hot = df.join(side, on, "left_semi")
    return (_by_window(light, parts, order, cols, prefix)
            .unionByName(_by_sequence(hot, parts, order, cols, prefix)))


def _by_window(df, parts, order, cols, prefix):
    w = Window.partitionBy(*parts).orderBy(*order)
    return df.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in cols])


def _by_sequence(df, parts, order, cols, prefix):
    staged, rows = materialize_counted(df.withColumn("_ls_tb", F.xxhash64(*df.columns)), "to-order")
    # Written in order: a row's part and place in it then outlive lost executors and sampled bounds.
    placed = materialize(
        staged.repartitionByRange(range_partitions(df, rows), *parts, *order, "_ls_tb")
        .sortWithinPartitions(*parts, *order, "_ls_tb")
        .withColumn("_ls_part", F.spark_partition_id())
        .withColumn("_ls_at", F.monotonically_increasing_id()).drop("_ls_tb"), "ordered")
    carried = _last_rows(placed, parts, cols)
    w = Window.partitionBy("_ls_part", *parts).orderBy("_ls_at")
    same = F.lit(True)
    for i, p in enumerate(parts):
        same = same & F.col(p).eqNullSafe(F.col(f"_ls_key.k{i}"))
    joined = (placed.withColumn("_ls_nth", F.row_number().over(w))
              .withColumns({f"_ls_v{i}": F.lag(c).over(w) for i, c in enumerate(cols)})
              .join(F.broadcast(carried), "_ls_part", "left"))
    return joined.select(*[F.col(c) for c in df.columns], *[
        F.when(F.col("_ls_nth") > 1, F.col(f"_ls_v{i}")).when(same, F.col(f"_ls_value.v{i}")).alias(prefix + c)
        for i, c in enumerate(cols)])


def _last_rows(placed: DataFrame, parts: list[str], cols: list[str]) -> DataFrame:
    """_ls_part, _ls_key, _ls_value: for each partition the last row of the nearest one before that has rows.

    As many rows as partitions; a window without keys over them is no burden.
    """
    key = F.struct(*[F.col(p).alias(f"k{i}") for i, p in enumerate(parts)])
    value = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    last = placed.groupBy("_ls_part").agg(F.max_by(F.struct(key.alias("key"), value.alias("value")), "_ls_at").alias("last"))
    before = last.withColumn("before", F.lag("last").over(Window.orderBy("_ls_part")))
    return before.where("before IS NOT NULL").select(
        "_ls_part", F.col("before.key").alias("_ls_key"), F.col("before.value").alias("_ls_value"))
