import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadsmith.streaming.documents_stream import document_batches, read_ingested, start_document_stream

SCHEMA = "id bigint, name string"


def land(path, name, lines):
    with open(f"{path}/{name}", "w") as f:
        f.write("".join(x + "\n" for x in lines))


def doc(i):
    return json.dumps({"id": i, "name": f"n{i}"})


def test_late_empty_and_malformed_files_equal_one_batch(spark, tmp_dir):
    landed, target, log = (f"{tmp_dir}/{x}" for x in ("in", "out", "log"))
    import os
    os.makedirs(landed)
    drops = [("a.json", [doc(1), doc(2)]), ("b.json", []), ("c.json", [doc(3), '{"id": 4', "", '{"id": "x"}'])]
    for name, lines in drops:
        land(landed, name, lines)
        start_document_stream(spark, landed, target, SCHEMA, f"{tmp_dir}/ck", log).awaitTermination()
    good, bad = read_ingested(spark, target, SCHEMA)
    assert sorted((r["id"], r["__FileName"]) for r in good.collect()) == [(1, "a.json"), (2, "a.json"), (3, "c.json")]
    assert sorted(r["ErrorText"] for r in bad.collect()) == ["", '{"id": "x"}', '{"id": 4']
    assert {r["__FileName"] for r in bad.collect()} == {"c.json"}
    rows = spark.read.parquet(log).filter("row_count > 0").orderBy("started_at").collect()
    assert [(r["status"], r["row_count"]) for r in rows] == [("SUCCEEDED", 2), ("SUCCEEDED", 4)]
    assert all(r["ended_at"] >= r["started_at"] for r in rows)


def test_one_file_per_micro_batch(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/in")
    for i in range(3):
        land(f"{tmp_dir}/in", f"{i}.json", [doc(i)])
    start_document_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", SCHEMA, f"{tmp_dir}/ck", files_per_batch=1).awaitTermination()
    good, _ = read_ingested(spark, f"{tmp_dir}/out", SCHEMA)
    rows = good.collect()
    assert sorted(r["batch"] for r in rows) == [0, 1, 2] and sorted(r["id"] for r in rows) == [0, 1, 2]


def test_a_batch_tried_again_counts_once_and_failures_are_logged(spark, tmp_dir):
    batch = spark.createDataFrame([(doc(i), "f") for i in range(5)] + [("{", "f")], "value string, __FileName string")
    target, log = f"{tmp_dir}/out", f"{tmp_dir}/log"
    fails = document_batches(target, SCHEMA, log, constraints={"few": F.col("id") < 3})
    with pytest.raises(PySparkException, match="few"):
        fails(batch, 0)
    work = document_batches(target, SCHEMA, log)
    work(batch, 0)
    work(batch, 0)
    work(batch.limit(0), 1)
    good, bad = read_ingested(spark, target, SCHEMA)
    assert sorted(r["id"] for r in good.collect()) == [0, 1, 2, 3, 4] and bad.count() == 1
    stored = [(r["step"], r["status"], r["row_count"]) for r in spark.read.parquet(log).orderBy("started_at").collect()]
    assert stored == [("batch 0", "FAILED", 0), ("batch 0", "SUCCEEDED", 6), ("batch 0", "SUCCEEDED", 6), ("batch 1", "SUCCEEDED", 0)]
