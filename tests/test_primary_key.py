import random
from collections import Counter

from pyspark.sql import functions as F

from loadsmith.operators.primary_key import (
    append_keyed,
    check_state,
    key_part,
    key_violations,
    part_count,
    read_keyed,
    renewed_state,
    sketch_cells,
)
from loadsmith.operators.rejects import broken_rules, write_with_rejects


def frame(spark, keys):
    return spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(keys)], "k bigint, v string")


def test_violations_against_plain_python(spark, tmp_dir):
    rng = random.Random(1)
    held = rng.sample(range(100_000), 3000)
    append_keyed(frame(spark, held[:2000]), tmp_dir, "k", 16, 8)
    append_keyed(frame(spark, held[2000:]), tmp_dir, "k", 16, 8)
    batch = [rng.choice(held) for _ in range(50)] + rng.sample(range(100_000, 200_000), 300) + [200_001] * 400 + [None, None]
    judged, read = key_violations(frame(spark, batch), tmp_dir, "k", 16, 8)
    n, held = Counter(batch), set(held)
    want = sorted((f"v{i}", ["no key"] if k is None else [r for r, hit in (
        ("duplicate in batch", n[k] > 1), ("in target", k in held)) if hit]) for i, k in enumerate(batch))
    assert sorted((r["v"], r["reasons"]) for r in judged.collect()) == want
    assert read == sorted(set(read)) and len(read) <= 16


def test_only_suspect_parts_are_read(spark, tmp_dir):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    cells = sketch_cells(20_000, 64)
    append_keyed(rows, tmp_dir, "k", 64, cells)
    judged, read = key_violations(frame(spark, [5, 30_000_000]), tmp_dir, "k", 64, cells)
    part = spark.range(5, 6).select(key_part("id", 64)).first()[0]
    assert part in read and len(read) <= 2
    assert {r["k"]: r["reasons"] for r in judged.collect()} == {5: ["in target"], 30_000_000: []}
    assert [r[0] for r in read_keyed(spark, tmp_dir, [part]).select("part").distinct().collect()] == [part]


def test_state_after_batches_equals_the_full_check_and_leaves_other_parts_unread(spark, tmp_dir):
    rng = random.Random(2)
    keys = [rng.randrange(500) for _ in range(600)]
    append_keyed(frame(spark, keys), tmp_dir, "k", 16, 4)
    state = check_state(spark, tmp_dir, "k").cache()
    second = [3, 3, 1000, keys[0]]
    touched = append_keyed(frame(spark, second), tmp_dir, "k", 16, 4)
    assert len(touched) <= 3
    renewed = renewed_state(state, tmp_dir, "k", touched)
    assert sorted(map(tuple, renewed.collect())) == sorted(map(tuple, check_state(spark, tmp_dir, "k").collect()))
    total = renewed.agg(F.sum("n_rows"), F.sum("n_duplicate_keys")).first()
    n = Counter(keys + second)
    assert tuple(total) == (604, sum(c > 1 for c in n.values()))
    plan = check_state(spark, tmp_dir, "k", touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_sizes():
    assert part_count(0) == 1 and part_count(1_000_001) == 2
    assert sketch_cells(0, 1) == 1 and sketch_cells(1_000_000, 1) == 250_000


def test_all_reasons_and_one_pass(spark, tmp_dir):
    rows = spark.createDataFrame([(1, 5), (2, None), (None, 50), (4, 50)], "a int, b int")
    rules = {"a": F.col("a").isNotNull(), "small": F.col("b") < 10, "even": F.col("b") % 2 == 0}
    assert [r[0] for r in rows.select(broken_rules(rules)).collect()] == [["even"], ["small", "even"], ["a", "small"], ["small"]]
    good, bad = write_with_rejects(rows, {"small": rules["small"], "a": rules["a"]}, f"{tmp_dir}/split")
    assert [tuple(r) for r in good.collect()] == [(1, 5)]
    assert sorted((r["a"] or 0, r["ErrorReasons"]) for r in bad.collect()) == [(0, ["small", "a"]), (2, ["small"]), (4, ["small"])]
    good, bad = write_with_rejects(rows.limit(0), rules, f"{tmp_dir}/none")
    assert good.collect() == [] and bad.collect() == []
