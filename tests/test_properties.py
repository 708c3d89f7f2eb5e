"""Property tests on random batches: dimension invariants after applying them."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadsmith import Type6Spec, VersionedSpec
from loadsmith.operators import checks
from loadsmith.operators.scd_type6 import type6_apply
from loadsmith.operators.scd_versioned import versioned_apply

T6 = ("Emp_Key bigint, ID int, Name string, CURRENTCity string, HESTORICALCity string, "
      "CURRENTEmail string, HESTORICALEmail string, STARTDate date, ENDDate date, Active_Flag int")
VD = ("Emp_Key bigint, ID int, Name string, City string, Email string, Schedule_Date date, "
      "Active_Flag int, Version_No int")
CITIES = st.sampled_from(["Cairo", "Giza", "Luxor", None])
EMAILS = st.sampled_from(["a@x", "b@x", None])
ROWS = st.lists(st.tuples(st.integers(1, 12), CITIES, EMAILS, st.integers(0, 30)), min_size=1, max_size=25)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def batch(spark, rows, date_name):
    return spark.createDataFrame(
        [(i, f"n{i}", c, e, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for i, c, e, d in rows],
        f"ID int, Name string, City string, Email string, {date_name} date")


def check_type6(dim):
    rows = dim.collect()
    keys = sorted(r["Emp_Key"] for r in rows)
    assert keys == list(range(1, len(rows) + 1))  # dense and unique
    active = [r["ID"] for r in rows if r["Active_Flag"] == 1]
    assert len(active) == len(set(active))  # one active row per key
    assert all((r["Active_Flag"] == 1) == (r["ENDDate"] is None) for r in rows)


@SETTINGS
@given(first=ROWS, second=ROWS, policy=st.sampled_from(["ignore", "distinct"]))
def test_type6_invariants(spark, first, second, policy):
    spec = Type6Spec(null_policy=policy, batch_dedup="latest")
    d = spark.createDataFrame([], T6)
    d = type6_apply(d, batch(spark, first, "Update_Date"), spec, dt.date(2024, 3, 1))
    d = spark.createDataFrame(d.collect(), T6)
    check_type6(d)
    d2 = type6_apply(d, batch(spark, second, "Update_Date"), spec, dt.date(2024, 4, 1))
    d2 = spark.createDataFrame(d2.collect(), T6)
    check_type6(d2)
    again = type6_apply(d2, batch(spark, second, "Update_Date"), spec, dt.date(2024, 5, 1))
    assert again.count() == d2.count()  # re-applying the same batch changes nothing
    if policy == "distinct":  # every change recorded: the history chain is strict
        assert checks.q2_type6_history_strict(d2).collect()[0]["violations"] == 0


@SETTINGS
@given(first=ROWS)
def test_versioned_invariants(spark, first):
    spec = VersionedSpec(batch_dedup="latest")
    d = versioned_apply(spark.createDataFrame([], VD), batch(spark, first, "Schedule_Date"), spec)
    d = spark.createDataFrame(d.collect(), VD)
    n_ids = len({r[0] for r in first})
    assert d.filter("Active_Flag = 1").count() == n_ids == d.count()
    again = versioned_apply(d, batch(spark, first, "Schedule_Date"), spec)
    rows = again.collect()
    assert len(rows) == 2 * n_ids  # every matched member is re-versioned
    assert {r["Version_No"] for r in rows if r["Active_Flag"] == 1} == {2}
    assert sorted(r["Emp_Key"] for r in rows) == list(range(1, 2 * n_ids + 1))
    assert again.filter(F.col("Version_No") < 1).count() == 0
