import pytest
from pyspark.sql import functions as F

from loadsmith.sources.footers import footer_row, max_key_and_rows
from loadsmith.sources.variants import explode_variant, variant_fields, with_variant


def test_variant_fields_and_arrays(spark):
    docs = spark.createDataFrame(
        [(1, '{"a": {"b": 5}, "list": [{"x": 1, "t": "u"}, 7, null]}'), (2, '{"list": []}'), (3, "[1]"), (4, None)], "id int, doc string")
    v = with_variant(docs, "doc", "v")
    got = variant_fields(v, "v", {"b": ("$.a.b", "int"), "list": ("$.list", "string")}, ["id"], strict=False).collect()
    assert [r["b"] for r in got] == [5, None, None, None] and got[0]["list"] == '[{"t":"u","x":1},7,null]'
    rows = explode_variant(v, "v", "$.list", ["id"])
    out = variant_fields(rows, "value", {"x": ("$.x", "int")}, ["id", "pos"], strict=False).collect()
    assert sorted((r["id"], r["pos"], r["x"]) for r in out[:1]) == [(1, 0, 1)] and len(out) == 3
    stored = explode_variant(v, "v", "$", ["id"]).filter("id = 1").select("key").collect()
    assert sorted(r["key"] for r in stored) == ["a", "list"]


def test_malformed_text(spark):
    docs = spark.createDataFrame([("{bad",)], "doc string")
    assert with_variant(docs, "doc", "v", strict=False).select(F.col("v").isNull()).first()[0]
    with pytest.raises(Exception, match="MALFORMED_RECORD|VARIANT"):
        with_variant(docs, "doc", "v").select(F.col("v").cast("string")).collect()


def test_aggregates_come_from_footers(spark, tmp_dir):
    spark.range(1000).selectExpr("id", "cast(id % 7 as int) as m", "if(id % 2 = 0, id, null) as half").repartition(3).write.parquet(f"{tmp_dir}/t")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    row, pushed = footer_row(spark, f"{tmp_dir}/t", {"top": F.max("id"), "low": F.min("m"), "n": F.count(F.lit(1)), "h": F.count("half")})
    assert tuple(row) == (999, 0, 1000, 500)
    assert len(pushed) == 1 and all(x in pushed[0] for x in ("MAX(id)", "MIN(m)", "COUNT(*)", "COUNT(half)"))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert max_key_and_rows(spark, f"{tmp_dir}/t", "id") == (999, 1000)
    spark.range(0).write.parquet(f"{tmp_dir}/none")
    assert max_key_and_rows(spark, f"{tmp_dir}/none", "id") == (0, 0)
