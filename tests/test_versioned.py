"""Versioned dimension held against its rule table over a generated grid."""

import datetime as dt
import itertools
import random

import pytest

from loadsmith import VersionedSpec
from loadsmith.operators.scd_versioned import (
    versioned_changes,
    versioned_classify,
    versioned_expire,
    versioned_inserts,
)

DIM = "row_key bigint, buoy bigint, sea string, serviced date, live int, rev int"
LOG = "buoy bigint, sea string, serviced date"
EARLY, LATE = dt.date(1999, 6, 1), dt.date(2001, 2, 3)


def spec(rule="reference", policy="ignore"):
    return VersionedSpec(key="buoy", surrogate="row_key", attributes=("sea",), date="serviced", flag="live",
                         version="rev", version_rule=rule, null_policy=policy)


def grid():
    """Old date x new date x old version, and buoys without a row."""
    dim, log = [], []
    for i, (old, new, rev) in enumerate(itertools.product((EARLY, None), (EARLY, LATE, None), (1, 4, 9))):
        dim.append((50 + 2 * i, i, f"sea{i}", old, 1, rev))
        log.append((i, f"gulf{i}", new))
    log += [(600, "strait", LATE), (601, None, None)]
    dim.append((99, 700, "lake", EARLY, 1, 2))
    return dim, log


def decide(old, new, rule, policy):
    """(inserted with this version or None, old row closed) of a buoy; old: its live row or None."""
    if old is None:
        return 1, False
    _, _, _, date, _, rev = old
    moved = new != date and (policy == "distinct" or None not in (new, date))
    if rule == "reference":
        return (1 if moved else rev + 1), True
    return (rev + 1, True) if moved else (None, False)


@pytest.mark.parametrize("rule,policy", list(itertools.product(["reference", "conventional"], ["ignore", "distinct"])))
def test_grid(spark, rule, policy):
    dim, log = grid()
    s, live = spec(rule, policy), {r[1]: r for r in dim}
    seen = versioned_classify(spark.createDataFrame(log, LOG), spark.createDataFrame(dim, DIM), s)
    got = {r["buoy"]: r for r in versioned_inserts(seen, s).collect()}
    gone = {r["row_key"] for r in versioned_expire(seen, s).collect()}
    verdicts = {b: decide(live.get(b), new, rule, policy) for b, _, new in log}
    assert {b: r["rev"] for b, r in got.items()} == {b: v for b, (v, _) in verdicts.items() if v is not None}
    assert gone == {live[b][0] for b, (_, closed) in verdicts.items() if closed}
    for b, sea, new in log:
        if b in got:
            assert (got[b]["sea"], got[b]["serviced"], got[b]["live"]) == (sea, new, 1)


def test_unknown_rule(spark):
    dim, log = grid()
    seen = versioned_classify(spark.createDataFrame(log, LOG), spark.createDataFrame(dim, DIM), spec())
    with pytest.raises(ValueError):
        versioned_inserts(seen, spec("odd"))


def test_random_logs_keep_the_invariants(spark):
    rng, s, dim = random.Random(2), spec(), spark.createDataFrame([], DIM)
    held: dict[int, tuple] = {}
    for year in (2003, 2004, 2005):
        log = [(b, "s", rng.choice([EARLY, LATE, dt.date(year, 1, 1)])) for b in rng.sample(range(30), 18)]
        changes = versioned_changes(dim, spark.createDataFrame(log, LOG), s)
        rows = changes.next_dimension().collect()
        for b, _, new in log:
            rev, _ = decide(held.get(b), new, "reference", "ignore")
            held[b] = (0, b, "s", new, 1, rev)
        live = [r for r in rows if r["live"] == 1]
        assert {r["buoy"]: (r["serviced"], r["rev"]) for r in live} == {b: (h[3], h[5]) for b, h in held.items()}
        assert len(live) == len(held)
        assert sorted(r["row_key"] for r in rows) == list(range(1, len(rows) + 1))
        assert changes.n_inserted == len(log)
        dim = spark.createDataFrame([tuple(r) for r in rows], DIM)
