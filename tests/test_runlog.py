"""The run log: outcomes are stored, failures too, and nothing waits for a write that never ended."""

import datetime as dt
import threading

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loadsmith.plans.jobs import run_product_load, run_type6_load, run_versioned_load
from loadsmith.plans.runlog import later, run_steps
from loadsmith.sources.documents import parse_documents
from loadsmith.specs import DocumentSpec

FEED = "ID bigint, Name string, City string, Email string, Update_Date date"


def stored(spark, path):
    return {r["step"]: (r["status"], r["row_count"]) for r in spark.read.parquet(path).collect()}


def test_counts_settle_after_the_write(spark, tmp_dir):
    obs = Observation("seen")
    rows = spark.range(12).observe(obs, F.count(F.lit(1)).alias("n"))
    steps = [("look", lambda shared: later(obs)), ("write", lambda shared: rows.write.parquet(f"{tmp_dir}/w")),
             ("fixed", lambda shared: 5)]
    outcomes = run_steps(spark, "P", steps, f"{tmp_dir}/log")
    assert stored(spark, f"{tmp_dir}/log") == {"look": ("SUCCEEDED", 12), "write": ("SUCCEEDED", 0), "fixed": ("SUCCEEDED", 5)}
    assert len({o.run_id for o in outcomes}) == 1 and all(o.started_at <= o.ended_at for o in outcomes)


def test_failed_run_is_stored_without_waiting(spark, tmp_dir):
    obs = Observation("never")
    spark.range(3).observe(obs, F.count(F.lit(1)).alias("n"))  # no action runs it

    def broken(shared):
        raise ValueError("no such gauge")

    ended = []

    def run():
        with pytest.raises(ValueError, match="no such gauge"):
            run_steps(spark, "P", [("read", lambda shared: later(obs)), ("apply", broken), ("after", lambda shared: 1)],
                      f"{tmp_dir}/log")
        ended.append(True)

    worker = threading.Thread(target=run, daemon=True)
    worker.start()
    worker.join(60)
    assert ended
    assert stored(spark, f"{tmp_dir}/log") == {"read": ("SUCCEEDED", 0), "apply": ("FAILED", 0)}
    message = spark.read.parquet(f"{tmp_dir}/log").where("step = 'apply'").first()["message"]
    assert message == "ValueError: no such gauge"


def test_jobs_append_to_one_log(spark, tmp_dir):
    log, base, day = f"{tmp_dir}/log", f"{tmp_dir}/dim", dt.date(2020, 5, 5)
    rows = spark.createDataFrame([(i, "n", "c", "e", day) for i in range(6)], FEED)
    run_type6_load(spark, rows, base, day, log_to=log)
    moved = rows.withColumn("City", F.lit("d")).withColumn("Update_Date", F.lit(day + dt.timedelta(days=1)))
    done = run_type6_load(spark, moved.limit(4), base, day + dt.timedelta(days=2), log_to=log)
    second = {o.step: o.row_count for o in done.outcomes}
    assert second == {"compute_watermark": 0, "extract_source": 4, "read_active_dim": 6, "transform_type6": 8,
                      "expire_old_rows": 4, "insert_new_versions": 4}
    assert spark.read.parquet(log).count() == 12
    versions = rows.withColumnRenamed("Update_Date", "Schedule_Date")
    assert run_versioned_load(spark, versions, f"{tmp_dir}/v", log_to=log).inserted == 6
    later_on = versions.withColumn("Schedule_Date", F.lit(day + dt.timedelta(days=3))).limit(2)
    more = run_versioned_load(spark, later_on.unionByName(versions), f"{tmp_dir}/v", mode="incremental", log_to=log)
    assert (more.inserted, more.expired) == (2, 2)
    assert {r["package"] for r in spark.read.parquet(log).collect()} == {"Q2", "Q3"}


def test_failing_constraint_is_logged(spark, tmp_dir):
    doc = '{"products": [{"id": null, "title": "x", "price": 1.5}], "total": 1, "skip": 0, "limit": 30}'
    docs = spark.createDataFrame([(doc,)], "doc string")
    with pytest.raises(Exception, match="id_not_null"):
        run_product_load(spark, docs, f"{tmp_dir}/t", log_to=f"{tmp_dir}/log")
    assert stored(spark, f"{tmp_dir}/log")["load_product_q1"] == ("FAILED", 0)
    assert run_product_load(spark, docs, f"{tmp_dir}/t", constraints={}).inserted == 1


def test_catalog_tables_as_source_and_target(spark, tmp_dir):
    day = dt.date(2020, 5, 5)
    spark.createDataFrame([(i, "n", "c", "e", day) for i in range(3)], FEED).write.mode("overwrite").saveAsTable("feed_in")
    assert run_type6_load(spark, "feed_in", f"{tmp_dir}/dim", day).inserted == 3
    spark.sql("DROP TABLE IF EXISTS product_out")
    docs = spark.createDataFrame([('{"products": [{"id": 4, "title": "x", "price": 1.5}], "skip": 0}',)], "doc string")
    for load_mode, rows in (("append", 1), ("append", 2), ("overwrite", 1)):
        assert run_product_load(spark, docs, "product_out", load_mode).inserted == 1
        assert spark.table("product_out").count() == rows
    for t in ("feed_in", "product_out"):
        spark.sql(f"DROP TABLE {t}")


def test_pretty_printed_pages_in_order_of_skip(spark, tmp_dir):
    import json
    import os

    os.makedirs(f"{tmp_dir}/pages")
    for skip in (60, 0, 30):
        page = {"products": [{"id": skip + i, "title": f"t{skip + i}", "price": 2.5} for i in range(30)],
                "total": 90, "skip": skip, "limit": 30}
        with open(f"{tmp_dir}/pages/p{90 - skip}.json", "w") as f:
            json.dump(page, f, indent=2)
    run_product_load(spark, f"{tmp_dir}/pages", f"{tmp_dir}/t", max_rows=40, multi_line=True)
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_dir}/t").collect()) == list(range(40))
    assert run_product_load(spark, f"{tmp_dir}/pages", f"{tmp_dir}/all", multi_line=True).inserted == 90
    raw = spark.read.text(f"{tmp_dir}/pages", wholetext=True).withColumnRenamed("value", "doc")
    spec = DocumentSpec(schema="products array<struct<id: bigint>>", array_path="products")
    assert parse_documents(raw, "doc", spec).count() == 90
