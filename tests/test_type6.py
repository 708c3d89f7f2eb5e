"""Type-6 dimension held against the rule table, worked out row by row in plain Python."""

import datetime as dt
import itertools
import random

import pytest

from loadsmith import Type6Spec
from loadsmith.operators.scd_type6 import (
    type6_apply,
    type6_changes,
    type6_classify,
    type6_expire,
    type6_inserts,
)
from loadsmith.specs import TrackedAttribute

PLOT = Type6Spec(
    key="plot", surrogate="plot_key", carried=("owner",), source_date="seen_on", start="since", end="until", flag="live",
    tracked=(TrackedAttribute("soil", "soil_now", "soil_before", "soil"),
             TrackedAttribute("crop", "crop_now", "crop_before", "crop")))
DIM = ("plot_key bigint, plot bigint, owner string, soil_now string, soil_before string, crop_now string, "
       "crop_before string, since date, until date, live int")
SURVEY = "plot bigint, owner string, soil string, crop string, seen_on date"
SOWN, SEEN, TODAY = dt.date(2011, 3, 1), dt.date(2013, 4, 9), dt.date(2013, 5, 2)

#: (incoming, current) of an attribute in each relation the rules tell apart
RELATION = {"same": ("loam", "loam"), "other": ("peat", "loam"), "unknown now": (None, "loam"),
            "known at last": ("peat", None), "never known": (None, None)}


def spec(**kw):
    return Type6Spec(**{**PLOT.__dict__, **kw})


def differs(new, old, policy):
    return new != old and (policy == "distinct" or None not in (new, old))


def work_out(dim, batch, today, policy="ignore", start=None):
    """The next dimension by the rules: dim and batch are lists of dicts, the batch one row per plot."""
    rows = [dict(r) for r in dim]
    top = max([r["plot_key"] for r in rows], default=0) if start is None else start
    fresh = []
    for s in sorted(batch, key=lambda s: s["plot"]):
        old = min((r for r in rows if r["live"] == 1 and r["plot"] == s["plot"]), key=lambda r: r["plot_key"], default=None)
        moved = [old is not None and differs(s[a], old[f"{a}_now"], policy) for a in ("soil", "crop")]
        if old is not None and not any(moved):
            continue
        new = {"plot": s["plot"], "owner": s["owner"], "until": None, "live": 1,
               "since": s["seen_on"] if old is None else today}
        for a, m in zip(("soil", "crop"), moved):
            new[f"{a}_now"] = s[a]
            new[f"{a}_before"] = None if old is None else old[f"{a}_now"] if m else old[f"{a}_before"]
        if old is not None:
            old["live"], old["until"] = 0, today
        fresh.append(new)
    for i, new in enumerate(sorted(fresh, key=lambda r: (r["plot"], r["since"]))):
        rows.append({"plot_key": top + 1 + i, **new})
    return rows


def frame(spark, rows, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def table(rows):
    """Rows of a DataFrame or of dicts, in one comparable order."""
    names = [c.split()[0] for c in DIM.split(", ")]
    return sorted((tuple(r[n] for n in names) for r in (rows if isinstance(rows, list) else rows.collect())), key=repr)


def grid():
    """A plot in every pair of relations, plots not met before, and one that the survey doesn't mention."""
    dim, batch = [], []
    for i, ((s_new, s_old), (c_new, c_old)) in enumerate(itertools.product(RELATION.values(), repeat=2)):
        dim.append({"plot_key": 700 - 3 * i, "plot": i, "owner": f"o{i}", "soil_now": s_old, "soil_before": f"s{i}",
                    "crop_now": c_old, "crop_before": None if i % 2 else f"c{i}", "since": SOWN, "until": None, "live": 1})
        batch.append({"plot": i, "owner": f"p{i}", "soil": s_new, "crop": c_new, "seen_on": SEEN})
    batch += [{"plot": 900 + i, "owner": None, "soil": s, "crop": c, "seen_on": SEEN} for i, (s, c) in
              enumerate(itertools.product((None, "clay"), repeat=2))]
    dim.append({**dim[0], "plot_key": 701, "plot": 800})
    dim.append({**dim[1], "plot_key": 702, "live": 0, "until": SOWN})  # closed long ago: no reference
    return dim, batch


@pytest.mark.parametrize("policy", ["ignore", "distinct"])
def test_every_relation_of_both_attributes(spark, policy):
    dim, batch = grid()
    got = type6_apply(frame(spark, dim, DIM), frame(spark, batch, SURVEY), spec(null_policy=policy), TODAY)
    assert table(got) == table(work_out(dim, batch, TODAY, policy))


@pytest.mark.parametrize("policy", ["ignore", "distinct"])
def test_routes_inserts_and_expiries_agree(spark, policy):
    dim, batch = grid()
    s = spec(null_policy=policy)
    seen = type6_classify(frame(spark, batch, SURVEY), frame(spark, [r for r in dim if r["live"]], DIM), s)
    routes = {r["plot"]: r["route"] for r in seen.collect()}
    old = {r["plot"]: r for r in dim if r["live"]}
    for b in batch:
        moved = [a for a in ("soil", "crop") if b["plot"] in old and differs(b[a], old[b["plot"]][f"{a}_now"], policy)]
        want = "new" if b["plot"] not in old else {0: "none", 1: (moved or [""])[0], 2: "both"}[len(moved)]
        assert routes[b["plot"]] == want
    assert {r["plot"] for r in type6_inserts(seen, s, TODAY).collect()} == {p for p, r in routes.items() if r != "none"}
    assert {r["plot_key"] for r in type6_expire(seen, s).collect()} == \
        {old[p]["plot_key"] for p, r in routes.items() if r not in ("none", "new")}


def test_random_seasons_equal_the_rules(spark):
    rng = random.Random(8)
    dim = []
    for season in range(3):
        today = dt.date(2014 + season, 1, 1)
        batch = [{"plot": p, "owner": f"o{rng.randrange(3)}", "soil": rng.choice(["loam", "peat", None]),
                  "crop": rng.choice(["rye", "oats", "kale"]), "seen_on": today - dt.timedelta(days=rng.randrange(90))}
                 for p in rng.sample(range(60), 35)]
        got = type6_apply(frame(spark, dim, DIM), frame(spark, batch, SURVEY), PLOT, today)
        dim = work_out(dim, batch, today)
        assert table(got) == table(dim)
        known = [b for b in batch if None not in (b["soil"], b["crop"])]
        assert table(type6_apply(frame(spark, dim, DIM), frame(spark, known, SURVEY), PLOT, today)) == \
            table(work_out(dim, known, today))


def test_unknown_value_under_the_fail_policy(spark):
    dim, batch = grid()
    with pytest.raises(Exception, match="NULL in change comparison"):
        type6_classify(frame(spark, batch, SURVEY), frame(spark, dim[:25], DIM), spec(null_policy="fail")).collect()


def test_a_plot_surveyed_twice(spark):
    dim, _ = grid()
    twice = [{"plot": 0, "owner": "x", "soil": soil, "crop": "loam", "seen_on": day}
             for soil, day in (("silt", SEEN), ("chalk", TODAY))]
    batch, active = frame(spark, twice, SURVEY), frame(spark, dim[:1], DIM)
    latest = type6_inserts(type6_classify(batch, active, spec(batch_dedup="latest")), PLOT, TODAY).collect()
    assert [r["soil_now"] for r in latest] == ["chalk"]
    assert type6_inserts(type6_classify(batch, active, PLOT), PLOT, TODAY).count() == 2
    with pytest.raises(ValueError):
        type6_classify(batch, active, spec(batch_dedup="error"))


def test_two_live_rows_of_a_plot(spark):
    dim = [{"plot_key": k, "plot": 4, "owner": "o", "soil_now": soil, "soil_before": None, "crop_now": "rye", "crop_before": None,
            "since": SOWN, "until": None, "live": 1} for k, soil in ((31, "marl"), (12, "sand"))]
    batch = [{"plot": 4, "owner": "o", "soil": "clay", "crop": "rye", "seen_on": SEEN}]
    got = table(type6_apply(frame(spark, dim, DIM), frame(spark, batch, SURVEY), PLOT, TODAY))
    assert got == table(work_out(dim, batch, TODAY))


def test_three_tracked_attributes(spark):
    three = Type6Spec(key="k", surrogate="sk", carried=(), source_date="on", start="since", end="until", flag="live",
                      tracked=tuple(TrackedAttribute(a, a + "1", a + "0", a) for a in "xyz"))
    old = spark.createDataFrame([(5, 2, "x", "p", "y", "q", "z", "r", SOWN, None, 1)],
                                "sk long, k int, x1 string, x0 string, y1 string, y0 string, z1 string, z0 string, "
                                "since date, until date, live int")
    for changed in itertools.chain.from_iterable(itertools.combinations("xyz", n) for n in range(4)):
        new = spark.createDataFrame([(2, *("!" if a in changed else a for a in "xyz"), SEEN)],
                                    "k int, x string, y string, z string, on date")
        seen = type6_classify(new, old, three)
        route = {0: "none", 3: "both"}.get(len(changed), "+".join(changed))
        assert seen.first()["route"] == route
        for r in type6_inserts(seen, three, TODAY).collect():
            assert [r[a + "0"] for a in "xyz"] == [a if a in changed else b for a, b in zip("xyz", "pqr")]


def test_first_load_numbers_densely(spark):
    batch = [{"plot": p, "owner": None, "soil": "s", "crop": "c", "seen_on": SEEN} for p in range(40)]
    changes = type6_changes(frame(spark, [], DIM), frame(spark, batch, SURVEY), PLOT, TODAY)
    assert changes.n_inserted == 40
    assert sorted(r["plot_key"] for r in changes.next_dimension().collect()) == list(range(1, 41))


def test_one_plot_with_a_third_of_the_batch(spark):
    """The latest survey per plot is combined before the shuffle, not sorted in one task."""
    rows = [(7, f"o{i}", f"soil{i:04d}", "c", SOWN + dt.timedelta(days=i)) for i in range(500)]
    rows += [(100 + i, "o", "s", "c", SEEN) for i in range(1000)]
    seen = type6_classify(spark.createDataFrame(rows, SURVEY), frame(spark, [], DIM), spec(batch_dedup="latest"))
    assert "Window" not in seen._jdf.queryExecution().executedPlan().toString()
    out = {r["plot"]: r for r in type6_inserts(seen, PLOT, TODAY).collect()}
    assert len(out) == 1001 and out[7]["soil_now"] == "soil0499"


def test_small_batch_streams_the_live_rows(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only explicit, counted broadcasts
    try:
        dim = [{"plot_key": i, "plot": i, "owner": "o", "soil_now": "loam", "soil_before": None, "crop_now": "rye",
                "crop_before": None, "since": SOWN, "until": None, "live": 1} for i in range(1, 2500)]
        batch = [{"plot": p, "owner": "o", "soil": "peat", "crop": "rye", "seen_on": SEEN} for p in (17, 4000)]
        d, b = frame(spark, dim, DIM), frame(spark, batch, SURVEY)
        streamed = type6_changes(d, b, spec(large_active_bytes=0), TODAY)
        plan = streamed.active._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        shuffled = type6_changes(d, b, spec(broadcast_batch_rows=0), TODAY)
        want = table(work_out(dim, batch, TODAY))
        assert table(streamed.next_dimension()) == want == table(shuffled.next_dimension())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
