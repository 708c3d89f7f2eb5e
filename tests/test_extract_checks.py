"""Watermark, incremental extraction, split, lookup, rejects and the checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadsmith.operators import checks
from loadsmith.operators.lookup import lookup, lookup_match, lookup_no_match
from loadsmith.operators.rejects import enforce, max_length, parse_with_rejects, split_rejects
from loadsmith.operators.split import branch, conditional_split, keep_wired
from loadsmith.operators.watermark import extract, high_watermark, incremental_scan, watermark_value

DIM = "Emp_Key long, ID int, STARTDate date, Active_Flag int"


def test_watermark_floor_and_strict_greater(spark):
    empty = spark.createDataFrame([], DIM)
    assert watermark_value(empty, "STARTDate") == dt.date(1900, 1, 1)
    d = spark.createDataFrame([(1, 1, dt.date(2024, 1, 5), 1), (2, 2, dt.date(2024, 2, 1), 0)], DIM)
    assert high_watermark(d, "STARTDate").first()[0] == dt.date(2024, 1, 5)
    src = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 1, 6)), (3, dt.date(2023, 1, 1))],
                                "ID int, Update_Date date")
    got = sorted(r["ID"] for r in extract(src, "Update_Date", "incremental", d, "STARTDate").collect())
    assert got == [2]  # row dated exactly at the watermark is excluded, late row dropped
    assert extract(src, "Update_Date", "full").count() == 3
    assert incremental_scan(src, "Update_Date", dt.date(2023, 6, 1), upper=dt.date(2024, 1, 6)).count() == 1


def test_conditional_split_first_match_wins(spark):
    df = spark.createDataFrame([(50, 0.1), (5, 0.1), (20, 0.0), (20, 0.05), (None, 0.05)], "q int, d double")
    routed = conditional_split(df, [("bulk", F.col("q") >= 40), ("deep", F.col("d") >= 0.08),
                                    ("free", F.col("d") == 0)], default="other")
    assert [r["route"] for r in routed.collect()] == ["bulk", "deep", "free", "other", "other"]
    assert branch(routed, "deep").count() == 1
    assert keep_wired(routed, ["bulk", "free"]).count() == 2
    strict = conditional_split(df, [("bulk", F.col("q") >= 40)], on_null="fail")
    with pytest.raises(Exception):
        strict.collect()


def test_lookup_outputs(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, s string")
    ref = spark.createDataFrame([(1, None), (1, "y")], "k int, r string")
    l = {r["s"]: r for r in lookup(src, ref, "k", ["r"], dedupe_by=["r"]).collect()}
    assert l["a"]["matched"] and l["a"]["d_r"] is None  # marker, not a data column
    assert not l["b"]["matched"] and not l["c"]["matched"]
    assert lookup_match(src, ref, "k", ["r"]).count() == 2  # duplicate reference keys fan out
    assert sorted(r["s"] for r in lookup_no_match(src, ref, "k").collect()) == ["b", "c"]


def test_rejects_and_gate(spark):
    df = spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": 2'), (3, '{"k": "x"}'), (4, None)], "id int, p string")
    good, bad = parse_with_rejects(df, "p", "k int", keep=["id"])
    assert [r["k"] for r in good.collect()] == [1]
    assert [(r["id"], r["ErrorText"], r["ErrorColumnName"]) for r in bad.orderBy("id").collect()] == [
        (2, '{"k": 2', "p"), (3, '{"k": "x"}', "p"), (4, None, "p")]
    g, b = split_rejects(df, F.col("id") > 1, "id")
    assert g.count() == 3 and b.collect()[0]["ErrorColumn"] == "id"
    assert enforce(df, {"len": max_length("p", 20)}).count() == 4
    with pytest.raises(Exception):
        enforce(df, {"len": max_length("p", 5)}).count()


def test_checks_find_injected_violations(spark):
    dim = spark.createDataFrame(
        [(1, 1, "Cairo", None, dt.date(2024, 1, 1), dt.date(2024, 2, 1), 0),
         (2, 1, "Giza", "X", dt.date(2024, 2, 1), None, 1),      # wrong history
         (3, 2, "Luxor", None, dt.date(2024, 1, 1), None, 1),
         (3, 2, "Luxor", None, dt.date(2024, 1, 1), dt.date(2024, 1, 3), 1)],  # dup key + dating + 2 active
        "Emp_Key long, ID int, CURRENTCity string, HESTORICALCity string, STARTDate date, ENDDate date, "
        "Active_Flag int")
    v = lambda df: df.collect()[0]["violations"]
    assert v(checks.q2_one_active_per_id(dim)) == 1
    assert v(checks.q2_dating(dim)) == 1
    assert v(checks.q2_type6_history(dim)) == 1
    assert v(checks.q2_type6_history(dim, method="window")) == 1
    assert v(checks.q2_emp_key_unique(dim)) == 1
    multi = checks.predicate_checks(dim, {"a": F.col("ID") == 1, "b": F.col("ENDDate").isNull()})
    assert {r["check_name"]: r["violations"] for r in multi.collect()} == {"a": 2, "b": 2}


def test_strict_history_covers_both_attributes(spark):
    dim = spark.createDataFrame(
        [(1, 1, "Cairo", None, "a@x", None, dt.date(2024, 1, 1)),
         (2, 1, "Cairo", None, "b@x", "WRONG", dt.date(2024, 2, 1)),   # email changed, bad history
         (3, 1, "Giza", "Cairo", "b@x", "WRONG", dt.date(2024, 3, 1)),  # city changed, good history
         (4, 2, "Luxor", None, "c@x", None, dt.date(2024, 1, 1))],
        "Emp_Key long, ID int, CURRENTCity string, HESTORICALCity string, CURRENTEmail string, "
        "HESTORICALEmail string, STARTDate date")
    assert checks.q2_type6_history_strict(dim).collect()[0]["violations"] == 1
    assert checks.q2_type6_history(dim).collect()[0]["violations"] == 0
