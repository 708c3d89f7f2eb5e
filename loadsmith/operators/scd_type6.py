"""Type-6 dimension: current/historical attribute pairs.

One lookup join, one route column, one projection for every branch: the
branches are not unioned filters over the join (which would run the join once
per branch).
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith.functions.columns import changed_flag, typed_null
from loadsmith.operators.keys import current_max_key, keyed_with_max
from loadsmith.operators.scd_common import (
    EXPIRES,
    ChangeSet,
    active_reference,
    batch_touched,
    close_rows,
    prepare_batch,
)
from loadsmith.session import is_large, materialize_counted
from loadsmith.specs import Type6Spec


def change_col(t) -> str:
    return "chg_" + t.source


def type6_classify(source: DataFrame, active: DataFrame, spec: Type6Spec = Type6Spec(),
                   batch_rows: int | None = None) -> DataFrame:
    """Each incoming row + d_* reference columns, ``matched``, change flags, ``route``.

    ``batch_rows``: an exact row count of ``source``, if known (see
    ``Type6Spec.broadcast_batch_rows``).
    """
    src = prepare_batch(source, spec.key, [spec.source_date, *spec.dedup_order], spec.batch_dedup)
    ref_cols = [c for t in spec.tracked for c in (t.current, t.history)]
    active = batch_touched(active, source, spec.key, batch_rows, spec.broadcast_batch_rows)
    ref = active_reference(active, spec.key, spec.surrogate, ref_cols, spec.dedupe_reference)
    joined = src.join(ref, spec.key, "left")
    matched = F.col("_ls_hit").isNotNull()
    flags = [F.when(matched, changed_flag(F.col(t.source), F.col("d_" + t.current),
                                          spec.null_policy, t.source))
             .otherwise(F.lit(0)).alias(change_col(t)) for t in spec.tracked]
    n_changed = sum((F.col(change_col(t)) for t in spec.tracked), F.lit(0))
    route = F.when(~F.col("matched"), F.lit(spec.new_route)).when(n_changed == 0, F.lit(spec.none_route))
    if len(spec.tracked) > 1:
        route = route.when(n_changed == len(spec.tracked), F.lit(spec.all_route))
    route = route.otherwise(F.concat_ws("+", *[
        F.when(F.col(change_col(t)) == 1, F.lit(t.route)) for t in spec.tracked]))
    return (joined.select(*[F.col(c) for c in joined.columns if c != "_ls_hit"],
                          matched.alias("matched"), *flags)
            .withColumn("route", route))


def _insert_rows(classified: DataFrame, spec: Type6Spec, run_date) -> DataFrame:
    is_new = F.col("route") == spec.new_route
    cols = [F.col(spec.key), *[F.col(c) for c in spec.carried]]
    for t in spec.tracked:
        cols.append(F.col(t.source).alias(t.current))
        cols.append(F.when(is_new, typed_null("string"))
                    .when(F.col(change_col(t)) == 1, F.col("d_" + t.current))
                    .otherwise(F.col("d_" + t.history)).alias(t.history))
    cols += [
        F.when(is_new, F.col(spec.source_date).cast("date"))
        .otherwise(F.lit(run_date).cast("date")).alias(spec.start),
        typed_null("date").alias(spec.end),
        F.lit(1).alias(spec.flag),
        F.col("d_" + spec.surrogate).alias(EXPIRES),
    ]
    return classified.filter(F.col("route") != spec.none_route).select(*cols)


def type6_inserts(classified: DataFrame, spec: Type6Spec = Type6Spec(), run_date=None) -> DataFrame:
    """Rows to insert (without surrogate key), per the rule table."""
    return _insert_rows(classified, spec, run_date).drop(EXPIRES)


def type6_expire(classified: DataFrame, spec: Type6Spec = Type6Spec()) -> DataFrame:
    """Surrogate keys of active rows closed by the batch (matched with a change)."""
    changed = F.col("matched") & F.col("route").isin(*spec_changed(spec))
    return classified.filter(changed).select(F.col("d_" + spec.surrogate).alias(spec.surrogate)).distinct()


def spec_changed(spec: Type6Spec) -> list[str]:
    """Every route that means "matched and changed" (k attributes: 2^k - 1 routes)."""
    singles = [t.route for t in spec.tracked]
    combos = ["+".join(c) for k in range(2, len(singles))
              for c in itertools.combinations(singles, k)]
    return singles + combos + [spec.all_route]


def type6_changes(dim: DataFrame, source: DataFrame, spec: Type6Spec = Type6Spec(),
                  run_date=None, start_after: int | None = None,
                  active: DataFrame | None = None, history: DataFrame | None = None,
                  closing=None) -> ChangeSet:
    """Apply one batch; returns the parts of the next dimension.

    ``active``/``history`` may be given separately (e.g. a bucketed active table),
    otherwise they are the two halves of ``dim`` by flag.  ``closing`` (see
    ``part_reader``) gives, for the keyed inserts, the only active rows that may
    close, so the others aren't read again.
    """
    flag = F.col(spec.flag)
    active = dim.filter(flag == 1) if active is None else active
    history = dim.filter(flag.isNull() | (flag != 1)) if history is None else history
    batch_rows = None
    if spec.broadcast_batch_rows and is_large(active, spec.large_active_bytes):
        # one write of the batch gives its exact size and spares re-reading the source
        source, batch_rows = materialize_counted(source, "batch")
    classified = type6_classify(source, active, spec, batch_rows)
    inserts = _insert_rows(classified, spec, run_date)
    if start_after is None:
        start_after = current_max_key(dim, spec.surrogate)
    keyed, max_key = keyed_with_max(inserts, spec.surrogate, [spec.key, spec.start], start_after,
                                    key_type=spec.key_type)
    small = batch_rows is not None and max_key - start_after <= spec.broadcast_batch_rows
    rows, parts = (active, None) if closing is None else closing(keyed)
    kept, closed = close_rows(rows, keyed, spec.key, spec.surrogate, spec.flag,
                              spec.dedupe_reference, spec.end, run_date, broadcast_targets=small)
    cols = spec.dim_columns
    inserted = keyed.select(*cols)
    return ChangeSet(history=history.select(*cols), expired=closed.select(*cols),
                     active=kept.select(*cols).unionByName(inserted), inserted=inserted,
                     n_inserted=max_key - start_after, parts=parts)


def type6_apply(dim: DataFrame, source: DataFrame, spec: Type6Spec = Type6Spec(),
                run_date=None, start_after: int | None = None) -> DataFrame:
    """Next dimension = history + closed rows + kept active rows + keyed inserts."""
    return type6_changes(dim, source, spec, run_date, start_after).next_dimension()
