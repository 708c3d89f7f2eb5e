"""Surrogate keys and previous values stay exact under a heavy key."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loadsmith.operators import history
from loadsmith.operators.history import previous_values
from loadsmith.operators.keys import assign_surrogate_keys, current_max_key
from loadsmith.operators.lookup import first_per_key


def skewed(spark, n=3000):
    # key 0 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 7 % 11).alias("v"))


def test_keys_dense_unique_in_order(spark):
    df = skewed(spark)
    out = assign_surrogate_keys(df, "sk", ["k", "seq"], start_after=100).collect()
    keys = sorted(r["sk"] for r in out)
    assert keys == list(range(101, 101 + len(out)))
    by_order = [r["sk"] for r in sorted(out, key=lambda r: (r["k"], r["seq"]))]
    assert by_order == keys


def test_keys_with_ties_still_dense(spark):
    df = spark.range(2000).select(F.lit(1).alias("k"))
    keys = sorted(r["sk"] for r in assign_surrogate_keys(df, "sk", ["k"]).collect())
    assert keys == list(range(1, 2001))


def test_keys_do_not_depend_on_the_partitions(spark):
    df = spark.range(3000).select((F.col("id") % 4).alias("k"), (F.col("id") * 7919 % 3000).alias("v"), F.col("id").alias("x"))
    want = None
    for n in (1, 7, 2000):
        got = {r["x"]: r["sk"] for r in assign_surrogate_keys(df.repartition(5, "v"), "sk", ["k"], num_partitions=n).collect()}
        assert sorted(got.values()) == list(range(1, 3001))
        want = want or got
        assert got == want


def test_current_max_key_empty_is_zero(spark):
    assert current_max_key(spark.createDataFrame([], "k long"), "k") == 0


def test_previous_values_match_window(spark):
    df = skewed(spark)
    got = previous_values(df, "k", ["seq"], ["v"]).select("seq", "prev_v")
    w = Window.partitionBy("k").orderBy("seq")
    want = df.select("seq", F.lag("v").over(w).alias("prev_v"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_first_per_key_picks_smallest_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "k int, o int, v string")
    out = {r["k"]: r["v"] for r in first_per_key(df, "k", ["o"]).collect()}
    assert out == {1: "a", 2: "z"}
    out = {r["k"]: r["v"] for r in first_per_key(df, "k", ["o"], ascending=False).collect()}
    assert out == {1: "c", 2: "z"}


def test_keys_with_many_partitions_use_broadcast_offsets(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    out = assign_surrogate_keys(df, "sk", ["k"], start_after=10, num_partitions=1100).collect()
    assert sorted(r["sk"] for r in out) == list(range(11, 5011))
    assert all(r["sk"] == r["k"] + 11 for r in out)


def test_previous_values_auto_splits_heavy_keys(spark):
    df = skewed(spark)  # key 0 holds 1000 of 3000 rows
    w = Window.partitionBy("k").orderBy("seq")
    want = sorted(map(tuple, df.select("seq", F.lag("v").over(w).alias("prev_v")).collect()))
    for heavy_rows in (100, 10_000):  # split path, then pure window path
        got = previous_values(df, "k", ["seq"], ["v"], method="auto", heavy_rows=heavy_rows)
        assert sorted(map(tuple, got.select("seq", "prev_v").collect())) == want


def test_sequence_carries_last_rows_over_partition_boundaries(spark, monkeypatch):
    rows = [(k, i, None if i % 5 == 0 else f"{k}-{i}") for k, n in ((None, 20), (1, 60), (2, 1), (3, 1), (4, 18)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, seq int, v string").repartition(5)
    w = Window.partitionBy("k").orderBy("seq")
    want = sorted(map(repr, map(tuple, df.withColumn("prev_v", F.lag("v").over(w)).collect())))
    for n in (1, 3, 16, 150):  # up to a row per partition, some without rows
        monkeypatch.setattr(history, "range_partitions", lambda df, rows, n=n: n)
        got = previous_values(df, "k", ["seq"], ["v"], method="sequence")
        assert got.columns == ["k", "seq", "v", "prev_v"]
        assert sorted(map(repr, map(tuple, got.collect()))) == want
    assert previous_values(df.limit(0), "k", ["seq"], ["v"], method="sequence").collect() == []


def test_sequence_joins_no_row_to_another(spark):
    plan = previous_values(skewed(spark), "k", ["seq"], ["v"], method="sequence")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") == 1
