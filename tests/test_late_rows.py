import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loadsmith import Type6Spec
from loadsmith.operators.late_rows import insert_late_rows, split_late

DIM = ("Emp_Key bigint, ID int, Name string, CURRENTCity string, HESTORICALCity string, CURRENTEmail string, "
       "HESTORICALEmail string, STARTDate date, ENDDate date, Active_Flag int")
SRC = "ID int, Name string, City string, Email string, Update_Date date, seq int"
SPEC = Type6Spec(dedup_order=("seq",))


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def chain(rows):
    """Plain chain of one key from (date, surrogate or None, name, city, email, hist_city, hist_email)."""
    rows = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    runs, out = [], []
    for r in rows:
        if runs and runs[-1][-1][3:5] == r[3:5]:
            runs[-1].append(r)
        else:
            runs.append([r])
    for run in runs:
        old = [r for r in run if r[1] is not None]
        if old:
            out.append((run[0][0], *old[0][1:]))
            out.extend(old[1:])
        else:
            out.append(run[0])
    done = []
    for i, (start, key, name, city, email, hc, he) in enumerate(out):
        if i:
            last = done[-1]
            hc = last[3] if city != last[3] else last[5]
            he = last[4] if email != last[4] else last[6]
        done.append((start, key, name, city, email, hc, he))
    return [(*r, out[i + 1][0] if i + 1 < len(out) else None, int(i + 1 == len(out))) for i, r in enumerate(done)]


def fixture(rng, keys=40):
    dim, late, key = [], [], 0
    for k in range(keys):
        starts = sorted(rng.sample(range(100, 200), rng.randint(1, 5)))
        versions = [(rng.choice("ABC"), rng.choice(["x", "y", None])) for _ in starts]
        for i, (s, (c, e)) in enumerate(zip(starts, versions)):
            key += 1
            before = versions[i - 1] if i else (None, None)
            end = day(starts[i + 1]) if i + 1 < len(starts) else None
            dim.append((key, k, f"n{k}", c, before[0], e, before[1], day(s), end, int(end is None)))
        for j in range(rng.choice([0, 0, 1, 3, 8])):
            late.append((k, f"late{j}", rng.choice("ABC"), rng.choice(["x", "y", None]), day(rng.randrange(50, starts[-1])), j))
    late += [(999, "no version", "A", "x", day(0), 0), (0, "no date", "A", "x", None, 0), (None, "no key", "A", "x", day(0), 0)]
    return dim, late


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_chains_in_any_order(spark, seed):
    rng = random.Random(seed)
    dim, late = fixture(rng)
    rng.shuffle(late)
    df = spark.createDataFrame(dim, DIM)
    on_time, found = split_late(spark.createDataFrame(late, SRC), df, SPEC)
    assert {r["Name"] for r in on_time.collect()} == {"no version", "no date", "no key"}
    got = insert_late_rows(df, found.repartition(4), SPEC).collect()
    want, keep = [], {}
    for k in {r[1] for r in dim}:
        old = [(r[7], r[0], r[2], r[3], r[5], r[4], r[6]) for r in dim if r[1] == k]
        of_key = sorted((r for r in late if r[0] == k and r[4] is not None), key=lambda r: r[5])
        by_day = {r[4]: (r[4], None, r[1], r[2], r[3], None, None) for r in of_key}
        fresh = [r for d, r in by_day.items() if d not in {o[0] for o in old}]
        if of_key:
            want += [(k, *r) for r in chain(old + fresh)]
        else:
            keep[k] = old
    cols = ["ID", "STARTDate", "Emp_Key", "Name", "CURRENTCity", "CURRENTEmail", "HESTORICALCity", "HESTORICALEmail",
            "ENDDate", "Active_Flag"]
    top = max(r[0] for r in dim)
    rows = [tuple((None if c == "Emp_Key" and r[c] > top else r[c]) for c in cols) for r in got if r["ID"] not in keep]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    new = sorted((r["ID"], r["STARTDate"], r["Emp_Key"]) for r in got if r["Emp_Key"] > top)
    assert [r[2] for r in new] == list(range(top + 1, top + 1 + len(new)))
    assert {tuple(r) for r in got if r["ID"] in keep} == {r for r in dim if r[1] in keep}


def test_late_rows_one_batch_at_a_time_give_the_same_chain(spark):
    dim = spark.createDataFrame([(1, 7, "n", "Z", None, "z", None, day(100), None, 1)], DIM)
    late = [(7, "n", f"c{i}", f"e{i // 2}", day(10 * i), i) for i in range(1, 7)]
    whole = insert_late_rows(dim, spark.createDataFrame(late, SRC), SPEC).drop("Emp_Key")
    step = dim
    for row in (late[3], late[0], late[5], late[1], late[4], late[2]):
        step = insert_late_rows(step, spark.createDataFrame([row], SRC), SPEC)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, step.drop("Emp_Key").collect()))
    assert step.select("Emp_Key").distinct().count() == 7
    assert step.filter(F.col("Active_Flag") == 1).select("CURRENTCity", "HESTORICALCity", "Emp_Key").collect() == [("Z", "c6", 1)]


def test_empty_frames(spark):
    dim = spark.createDataFrame([(1, 7, "n", "Z", None, "z", None, day(100), None, 1)], DIM)
    assert insert_late_rows(dim, spark.createDataFrame([], SRC), SPEC).collect() == dim.collect()
    none = spark.createDataFrame([], DIM)
    on_time, late = split_late(spark.createDataFrame([(1, "n", "A", "x", day(1), 0)], SRC), none, SPEC)
    assert on_time.count() == 1 and late.count() == 0
