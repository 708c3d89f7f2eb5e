"""Streaming loads equal the same loads applied batch by batch (brute force)."""

import datetime as dt

from pyspark.sql import functions as F

from loadsmith.operators.scd_type6 import type6_changes
from loadsmith.plans.fixtures import table
from loadsmith.plans.jobs import T6_EMPTY
from loadsmith.sinks.publish import current_pointer, read_dimension
from loadsmith.specs import TrackedAttribute, Type6Spec
from loadsmith.streaming import scd_micro_batches, start_scd_stream

SF = "/root/testdata/sf0.001"
SPEC = Type6Spec(carried=(), tracked=(TrackedAttribute("City", "CURRENTCity", "HESTORICALCity", "city"),
                                      TrackedAttribute("Email", "CURRENTEmail", "HESTORICALEmail", "email")),
                 batch_dedup="latest", dedup_order=("event_id",))
EMPTY = T6_EMPTY.replace("Name string, ", "")


def weekly(spark):
    ev = table(spark, SF, "events")
    return ev.select(F.col("user_id").alias("ID"), F.col("event_type").alias("City"),
                     F.col("props").alias("Email"), F.col("ts").cast("date").alias("Update_Date"),
                     "event_id", F.date_trunc("week", "ts").cast("date").alias("week"))


def brute_force(spark, weeks_df):
    dim = spark.createDataFrame([], EMPTY)
    key = 0
    for (w,) in sorted(weeks_df.select("week").distinct().collect()):
        b = weeks_df.filter(F.col("week") == w).drop("week")
        run = b.agg(F.max("Update_Date")).first()[0]
        ch = type6_changes(dim, b, SPEC, run, start_after=key)
        nxt = ch.next_dimension()
        dim = spark.createDataFrame(nxt.collect(), nxt.schema)  # small fixture: brute force
        key = max([r["Emp_Key"] for r in dim.collect()], default=0)
    return dim


def test_stream_matches_batch_by_batch(spark, tmp_dir):
    src = weekly(spark)
    land = f"{tmp_dir}/landing"
    for (w,) in sorted(src.select("week").distinct().collect()):  # one file per week, in order
        src.filter(F.col("week") == w).drop("week").coalesce(1).write.mode("append").parquet(land)
    stream = (spark.readStream.schema(src.drop("week").schema).option("maxFilesPerTrigger", 1)
              .parquet(land))
    q = start_scd_stream(stream, f"{tmp_dir}/dim", SPEC, EMPTY, f"{tmp_dir}/ckpt")
    q.awaitTermination(600)
    got = read_dimension(spark, f"{tmp_dir}/dim")
    want = brute_force(spark, src)
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def rows_of(spark, base):
    return sorted(map(tuple, read_dimension(spark, base).collect()), key=repr)


def halves(spark):
    src = weekly(spark).drop("week")
    return (src.filter(F.col("Update_Date") < dt.date(2024, 1, 15)), src.filter(F.col("Update_Date") >= dt.date(2024, 1, 15)))


def test_replayed_micro_batch_is_skipped(spark, tmp_dir):
    base = f"{tmp_dir}/dim"
    first, second = halves(spark)
    f = scd_micro_batches(spark, base, SPEC, EMPTY, stream_id="s")
    f(first, 0)
    f(second, 1)
    once = rows_of(spark, base)
    again = scd_micro_batches(spark, base, SPEC, EMPTY, stream_id="s")  # after a restart
    again(second, 1)
    assert rows_of(spark, base) == once


def test_empty_micro_batch_keeps_the_dimension(spark, tmp_dir):
    first, second = halves(spark)
    for name, batches in (("gap", (first, first.limit(0), second)), ("none", (first, second))):
        f = scd_micro_batches(spark, f"{tmp_dir}/{name}", SPEC, EMPTY)
        for i, b in enumerate(batches):
            f(b, i)
    assert rows_of(spark, f"{tmp_dir}/gap") == rows_of(spark, f"{tmp_dir}/none")


def test_fresh_checkpoint_goes_on_from_the_dimension(spark, tmp_dir):
    first, second = halves(spark)
    for name, split in (("fresh", True), ("one", False)):
        f = scd_micro_batches(spark, f"{tmp_dir}/{name}", SPEC, EMPTY)
        f(first, 0)
        g, n = (scd_micro_batches(spark, f"{tmp_dir}/{name}", SPEC, EMPTY), 0) if split else (f, 1)
        g(second, n)
    assert rows_of(spark, f"{tmp_dir}/fresh") == rows_of(spark, f"{tmp_dir}/one")


def test_live_stream_with_a_new_checkpoint(spark, tmp_dir):
    first, second = halves(spark)
    first.coalesce(1).write.parquet(f"{tmp_dir}/in1")
    second.coalesce(1).write.parquet(f"{tmp_dir}/in2")
    for i in (1, 2):
        stream = spark.readStream.schema(first.schema).parquet(f"{tmp_dir}/in{i}")
        start_scd_stream(stream, f"{tmp_dir}/dim", SPEC, EMPTY, f"{tmp_dir}/ckpt{i}").awaitTermination(600)
    f = scd_micro_batches(spark, f"{tmp_dir}/plain", SPEC, EMPTY)
    f(first, 0)
    f(second, 1)
    assert rows_of(spark, f"{tmp_dir}/dim") == rows_of(spark, f"{tmp_dir}/plain")
    assert len(current_pointer(spark, f"{tmp_dir}/dim")["streams"]) == 2


def test_latest_per_window_emits_closed_weeks_only(spark, tmp_dir):
    from loadsmith.streaming import latest_per_window
    ev = table(spark, SF, "events").select("user_id", "ts", "event_type", "event_id")
    land = f"{tmp_dir}/ev"
    weeks = ev.select(F.date_trunc("week", "ts").alias("w")).distinct().orderBy("w").collect()
    for (w,) in weeks:
        ev.filter(F.date_trunc("week", "ts") == w).coalesce(1).write.mode("append").parquet(land)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(land)
    out = latest_per_window(stream, "user_id", "ts", "7 days", "1 day", ["event_type", "event_id"],
                            start_offset="4 days")
    q = (out.writeStream.format("memory").queryName("lpw").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = spark.table("lpw")
    wm = ev.agg(F.max("ts")).first()[0] - dt.timedelta(days=1)
    closed = [w for (w,) in weeks if w + dt.timedelta(days=7) <= wm]
    exp = (ev.withColumn("w", F.date_trunc("week", "ts"))
           .filter(F.col("w").isin(closed))
           .groupBy("user_id", "w").agg(F.max(F.struct("ts", "event_type", "event_id")).alias("r")))
    assert got.count() == exp.count() > 0
    assert sorted((r["user_id"], r["event_id"]) for r in got.collect()) == \
        sorted((r["user_id"], r["r"]["event_id"]) for r in exp.collect())
