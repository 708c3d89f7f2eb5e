"""Copy-on-write publishing, observed load counts and what protects a dimension's rows."""

import datetime as dt
import glob

import pytest

from loadsmith.operators.scd_type6 import type6_changes, type6_classify
from loadsmith.plans.jobs import T6_EMPTY, run_type6_load, seed_dimension
from loadsmith.sinks.publish import (
    PublishConflict,
    append_load,
    current_pointer,
    part_reader,
    publish_dimension,
    read_active,
    read_dimension,
    read_history,
    repart_dimension,
    truncate_reload,
    write_observed,
)

FEED = "ID bigint, Name string, City string, Email string, Update_Date date"
DAY = dt.date(2019, 7, 1)


def lamps(spark, ids, city="north"):
    """A dimension with one active row per id."""
    return spark.createDataFrame([(i, i, f"lamp{i}", city, None, f"{i}@grid", None, DAY, None, 1) for i in ids], T6_EMPTY)


def feed(spark, ids, city="south", day=DAY + dt.timedelta(days=9)):
    return spark.createDataFrame([(i, f"lamp{i}", city, f"{i}@grid", day) for i in ids], FEED)


def load(spark, base, rows, batch, run=DAY + dt.timedelta(days=20), load_id=None):
    ptr = current_pointer(spark, base)
    changes = type6_changes(None, rows, run_date=run, start_after=ptr["max_key"], active=read_active(spark, base),
                            history=read_history(spark, base), closing=part_reader(spark, base, ptr, "ID"))
    return publish_dimension(spark, changes, base, batch, "ID", "Emp_Key", ptr["max_key"], load_id=load_id)


def test_append_and_truncate_counts(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert [append_load(spark.range(7), path), append_load(spark.range(5), path)] == [7, 5]
    assert spark.read.parquet(path).count() == 12
    assert truncate_reload(spark.range(3), path) == 3 == spark.read.parquet(path).count()


def test_observed_write_of_a_relation_proven_empty(spark, tmp_dir):
    none = spark.createDataFrame([(1,)], "a int").filter("a > 5")
    assert write_observed(none, f"{tmp_dir}/e", mode="overwrite") == {"rows": 0}


def test_batches_follow_and_old_ones_stay_readable(spark, tmp_dir):
    base = f"{tmp_dir}/d"
    seed_dimension(spark, lamps(spark, range(1, 61)), base)
    first = load(spark, base, feed(spark, [3, 4, 900]), 1)
    assert first == {"closed": 2, "active": 61, "inserted": 3, "max_key": 63}
    second = load(spark, base, feed(spark, [900, 5], "west"), 2)
    assert second == {"closed": 2, "active": 61, "inserted": 2, "max_key": 65}
    whole = read_dimension(spark, base)
    assert whole.count() == 65 and whole.select("Emp_Key").distinct().count() == 65
    assert read_dimension(spark, base, 1).count() == 63 and read_dimension(spark, base, 0).count() == 60


def test_a_load_run_again_changes_nothing(spark, tmp_dir):
    base = f"{tmp_dir}/d"
    seed_dimension(spark, lamps(spark, range(1, 30)), base)
    once = load(spark, base, feed(spark, [3, 50]), 1, load_id="night-7")
    before = sorted(map(tuple, read_dimension(spark, base).collect()), key=repr)
    assert load(spark, base, feed(spark, [3, 50]), 1, load_id="night-7") == once
    assert sorted(map(tuple, read_dimension(spark, base).collect()), key=repr) == before


def test_of_two_loads_from_one_state_the_second_fails(spark, tmp_dir):
    base = f"{tmp_dir}/d"
    seed_dimension(spark, lamps(spark, range(1, 30)), base)
    ptr = current_pointer(spark, base)

    def changes(ids):
        return type6_changes(None, feed(spark, ids), run_date=DAY, start_after=ptr["max_key"],
                             active=read_active(spark, base), history=read_history(spark, base))
    one, two = changes([100, 101]), changes([200])
    publish_dimension(spark, one, base, 1, "ID", "Emp_Key", ptr["max_key"], load_id="a")
    with pytest.raises(PublishConflict):
        publish_dimension(spark, two, base, 1, "ID", "Emp_Key", ptr["max_key"], load_id="b")
    with pytest.raises(PublishConflict):
        publish_dimension(spark, two, base, 0, "ID", "Emp_Key", ptr["max_key"])
    assert {r["ID"] for r in read_active(spark, base).collect()} == {*range(1, 30), 100, 101}


def test_a_small_batch_leaves_untouched_parts_alone(spark, tmp_dir):
    base = f"{tmp_dir}/d"
    seed_dimension(spark, lamps(spark, range(1, 401)), base)
    zero = current_pointer(spark, base)
    files = set(glob.glob(f"{base}/active/**/*.parquet", recursive=True))
    load(spark, base, feed(spark, [11]), 1)
    one = current_pointer(spark, base)
    moved = [p for p in zero["part_folders"] if zero["part_folders"][p] != one["part_folders"][p]]
    assert len(moved) == 1
    fresh = set(glob.glob(f"{base}/active/**/*.parquet", recursive=True)) - files
    assert len(fresh) == 1 and f"_part={moved[0]}/" in fresh.pop()
    assert files <= set(glob.glob(f"{base}/active/**/*.parquet", recursive=True))
    touched = read_active(spark, base, 0, [int(moved[0])])
    assert touched.count() == zero["part_rows"][moved[0]] < 400
    assert read_active(spark, base).count() == 400 and read_history(spark, base).count() == 1


def test_parts_follow_the_counted_rows_and_can_be_dealt_anew(spark, tmp_dir, monkeypatch):
    from loadsmith.sinks import publish

    monkeypatch.setattr(publish, "PART_ROWS", 20)
    base = f"{tmp_dir}/d"
    seed_dimension(spark, lamps(spark, range(1, 401)), base)
    zero = current_pointer(spark, base)
    assert zero["parts"] == 20 and sum(zero["part_rows"].values()) == zero["active"] == 400
    load(spark, base, feed(spark, range(100, 110)), 1)
    one = current_pointer(spark, base)
    moved = [p for p in zero["part_folders"] if zero["part_folders"][p] != one["part_folders"][p]]
    assert one["parts"] == 20 and 0 < len(moved) <= 10
    before = sorted(map(repr, read_dimension(spark, base).collect()))
    monkeypatch.setattr(publish, "PART_ROWS", 10)
    repart_dimension(spark, base, "ID")
    two = current_pointer(spark, base)
    assert two["parts"] == 40 and two["max_key"] == one["max_key"]
    assert sorted(map(repr, read_dimension(spark, base).collect())) == before
    load(spark, base, feed(spark, [11]), 3)
    assert read_active(spark, base).count() == 400 and read_history(spark, base).count() == 11


def test_bucketed_active_rows_join_without_their_own_shuffle(spark, tmp_dir):
    base = f"{tmp_dir}/b"
    seed_dimension(spark, lamps(spark, range(1, 200)), base, bucket_by=4)
    old = current_pointer(spark, base)["table"]
    some = feed(spark, range(150, 260), "south").unionByName(feed(spark, range(1, 10), "north"))
    done = run_type6_load(spark, some, base, DAY + dt.timedelta(days=30), bucket_by=4)
    assert (done.inserted, done.expired) == (110, 50)
    assert not spark.catalog.tableExists(old)
    assert len(glob.glob(f"{base}/active/{current_pointer(spark, base)['folder']}/*.parquet")) <= 4
    active = read_active(spark, base)
    assert active.count() == 259 and read_history(spark, base).count() == 50
    plan = type6_classify(some, active)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan


def test_source_watermark_reads_late_updates(spark, tmp_dir):
    early, late, run = DAY + dt.timedelta(days=4), DAY + dt.timedelta(days=6), DAY + dt.timedelta(days=40)
    for how, found in (("dimension", 0), ("source", 1)):
        base = f"{tmp_dir}/{how}"
        seed_dimension(spark, lamps(spark, [1]), base)
        run_type6_load(spark, feed(spark, [1], day=early), base, run, watermark_from=how)
        both = feed(spark, [1], day=early).unionByName(feed(spark, [2], day=late))
        assert run_type6_load(spark, both, base, run + dt.timedelta(days=1), watermark_from=how).inserted == found
    assert current_pointer(spark, f"{tmp_dir}/source")["source_watermark"] == late.isoformat()


def test_null_key_fails_the_load_and_publishes_nothing(spark, tmp_dir):
    base = f"{tmp_dir}/d"
    seed_dimension(spark, lamps(spark, [1, 2]), base)
    with pytest.raises(Exception, match="ID_not_null"):
        run_type6_load(spark, feed(spark, [1, None]), base, DAY + dt.timedelta(days=30))
    assert current_pointer(spark, base)["batch"] == 0
