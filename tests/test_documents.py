"""Document ingestion: product load golden cases and the JSON options."""

import json

import pytest
from pyspark.sql import functions as F

from loadsmith.plans.products import transform_products
from loadsmith.sinks.publish import land_documents
from loadsmith.sources.documents import (
    first_rows,
    flatten_array,
    nested_as_string,
    parse_documents,
    read_documents,
    read_raw_documents,
    replace_in_text,
    rows_from_2d,
    to_name_value,
)
from loadsmith.functions.columns import blank_as_null, round_to_bigint
from loadsmith.specs import DocumentSpec

ELEM = ("id bigint, title string, price double, discountPercentage double, stock bigint, "
        "brand string, category string, rating double")
SCHEMA = f"products array<struct<{ELEM.replace(' ', ': ', 1)}>>, total bigint, skip bigint, limit bigint"
SCHEMA = ("products array<struct<id: bigint, title: string, price: double, discountPercentage: double, "
          "stock: bigint, brand: string, category: string, rating: double, images: array<string>>>, "
          "total bigint, skip bigint, limit bigint")
SPEC = DocumentSpec(schema=SCHEMA, array_path="products", parents=("total", "skip", "limit"), keep_position=True)


def product(i, price=549.99):
    return {"id": i, "title": f"t{i}", "price": price, "discountPercentage": 12.96, "stock": 94,
            "brand": "Apple", "category": "smartphones", "rating": 4.69, "images": ["a", "b"]}


def docs(spark, payloads):
    return spark.createDataFrame([(json.dumps(p),) for p in payloads], "doc string")


def test_types_and_rounding(spark):
    d = docs(spark, [{"products": [product(1)], "total": 1, "skip": 0, "limit": 30}])
    r = transform_products(parse_documents(d, "doc", SPEC)).collect()[0]
    assert r["price"] == 550 and r["id"] == 1 and r["stock"] == 94 and r["rating"] == 4.69
    schema = dict(transform_products(parse_documents(d, "doc", SPEC)).dtypes)
    assert schema == {"id": "bigint", "title": "string", "price": "bigint", "discountPercentage": "double",
                      "stock": "bigint", "brand": "string", "category": "string", "rating": "double"}


def test_row_cap_keeps_the_first_rows_of_all_documents(spark):
    d = docs(spark, [{"products": [product(s + i) for i in range(20)], "total": 40, "skip": s, "limit": 20} for s in (20, 0)])
    rows = parse_documents(d, "doc", SPEC)
    first = first_rows(rows, 25, ["P_skip", "pos"]).collect()
    assert sorted(r["id"] for r in first) == list(range(25)) and all(r["P_total"] == 40 for r in first)
    assert first_rows(rows, 0, ["P_skip", "pos"]).count() == 40


def test_rounding_half_up(spark):
    df = spark.createDataFrame([(0.5,), (2.5,), (-0.5,), (1.49,)], "x double")
    assert [r[0] for r in df.select(round_to_bigint(F.col("x"))).collect()] == [1, 3, -1, 1]


def test_missing_array_gives_no_rows_or_parent_row(spark):
    d = docs(spark, [{"total": 0, "skip": 0, "limit": 0}])
    assert parse_documents(d, "doc", SPEC).count() == 0
    outer = DocumentSpec(schema=SCHEMA, array_path="products", parents=("total",),
                         include_parents_when_child_missing=True)
    assert parse_documents(d, "doc", outer).count() == 1


def test_element_with_missing_field_is_null(spark):
    p = product(3)
    del p["brand"]
    d = docs(spark, [{"products": [p], "total": 1, "skip": 0, "limit": 1}])
    assert parse_documents(d, "doc", SPEC).collect()[0]["brand"] is None


def test_malformed_document_fails_fast(spark):
    d = spark.createDataFrame([('{"products": [',)], "doc string")
    with pytest.raises(Exception):
        parse_documents(d, "doc", SPEC).collect()


def test_files_with_file_name_and_many_documents(spark, tmp_dir):
    d = docs(spark, [{"products": [product(i) for i in range(k * 10, k * 10 + 10)], "total": 10,
                      "skip": k * 10, "limit": 10} for k in range(3)])
    path = land_documents(d.repartition(3), f"{tmp_dir}/docs")
    spec = DocumentSpec(schema=SCHEMA, array_path="products", parents=("skip",), keep_position=True)
    rows = read_documents(spark, path, spec, file_name=True)
    assert rows.count() == 30
    assert rows.select("__FileName").distinct().count() >= 1
    first = first_rows(rows, 25, ["P_skip", "pos"]).collect()
    assert sorted(r["id"] for r in first) == list(range(25))
    raw = read_raw_documents(spark, path)
    assert raw.count() == 3


def test_nested_as_string_and_flatten(spark):
    d = docs(spark, [{"products": [product(1)], "total": 1, "skip": 0, "limit": 1}])
    rows = parse_documents(d, "doc", SPEC)
    s = nested_as_string(rows, ["images"]).collect()[0]["images"]
    assert json.loads(s) == ["a", "b"]
    flat = flatten_array(rows, "images", max_items=3).collect()[0]
    assert (flat["images_0"], flat["images_1"], flat["images_2"], flat["images_rest"]) == ("a", "b", None, None)
    long = spark.createDataFrame([(list("abcdefghijklm"),), ([],), (None,)], "images array<string>")
    assert [r["images_rest"] for r in flatten_array(long, "images").collect()] == [["k", "l", "m"], None, None]


def test_unpivot_and_2d_rows(spark):
    d = docs(spark, [{"products": [product(1)], "total": 1, "skip": 0, "limit": 1}])
    rows = transform_products(parse_documents(d, "doc", SPEC))
    up = {r["Pivot_Name"]: r["Pivot_Value"] for r in to_name_value(rows, ["id"], ["price", "rating"]).collect()}
    assert up == {"price": 550.0, "rating": 4.69}
    two = spark.createDataFrame([(["a", "b"], [[1.0, 2.0], [3.0, 4.0]])], "names array<string>, rows array<array<double>>")
    out = rows_from_2d(two, "names", "rows", ["b", "a", "c"]).collect()
    assert [(r["a"], r["b"], r["c"]) for r in out] == [(1.0, 2.0, None), (3.0, 4.0, None)]


def test_replace_before_parse_and_blank_as_null(spark):
    d = spark.createDataFrame([('{"products": [{"id": 1, "title": "old"}]}',)], "doc string")
    fixed = replace_in_text(d, "doc", '"old"', '"new"', regex=False)
    assert parse_documents(fixed, "doc", SPEC).collect()[0]["title"] == "new"
    t = spark.createDataFrame([("",), ("  ",), ("1.5",), ("x",)], "v string")
    assert [r[0] for r in t.select(blank_as_null(F.col("v"), "double")).collect()] == [None, None, 1.5, None]


def test_compressed_many_paths_options_and_permissive(spark, tmp_dir):
    d = docs(spark, [{"products": [product(i)], "total": 1, "skip": i, "limit": 1} for i in range(4)])
    a = land_documents(d.limit(2), f"{tmp_dir}/a", compression="gzip")
    b = land_documents(d.subtract(d.limit(2)), f"{tmp_dir}/nested/b")
    spec = DocumentSpec(schema=SCHEMA, array_path="products")
    assert read_documents(spark, [a, b], spec).count() == 4
    assert read_documents(spark, f"{tmp_dir}/nested", spec, recursive=True).count() == 2
    assert read_documents(spark, [a, f"{tmp_dir}/missing"], spec, ignore_missing=True).count() == 2
    bad = f"{tmp_dir}/bad"
    spark.createDataFrame([('{"products": [{"id": 1}]}',), ("{oops",)], "value string").coalesce(1) \
        .write.text(bad)
    with pytest.raises(Exception):
        read_documents(spark, bad, spec).collect()
    assert read_documents(spark, bad, spec, mode="PERMISSIVE").count() == 1
    dated = f"{tmp_dir}/dated"
    spark.createDataFrame([('{"rows": [{"d": "03/12/2026"}]}',)], "value string").write.text(dated)
    dspec = DocumentSpec(schema="rows array<struct<d: date>>", array_path="rows",
                         extra={"dateFormat": "dd/MM/yyyy"})
    import datetime as dt
    assert read_documents(spark, dated, dspec).collect()[0]["d"] == dt.date(2026, 12, 3)


def test_create_table_if_missing(spark, tmp_dir):
    from loadsmith.sinks.ddl import PRODUCT_DDL, create_table_if_missing
    create_table_if_missing(spark, "product_q1_t", PRODUCT_DDL, location=f"{tmp_dir}/p")
    create_table_if_missing(spark, "product_q1_t", PRODUCT_DDL, location=f"{tmp_dir}/p")
    assert spark.table("product_q1_t").columns[:3] == ["id", "title", "price"]


def test_product_job_length_gate_and_rounding(spark, tmp_dir):
    from loadsmith.plans.jobs import run_product_load
    p = product(1, price=2.5)
    d = docs(spark, [{"products": [p], "total": 1, "skip": 0, "limit": 1}])
    assert run_product_load(spark, d, f"{tmp_dir}/t", rounding="floor").inserted == 1
    assert spark.read.parquet(f"{tmp_dir}/t").collect()[0]["price"] == 2
    d2 = docs(spark, [{"products": [dict(p, title="x" * 200)], "total": 1, "skip": 0, "limit": 1}])
    with pytest.raises(Exception, match="title_length"):
        run_product_load(spark, d2, f"{tmp_dir}/t2")
