"""Versioned dimension: one tracked date and a version counter.

Rule ``reference``: a new member gets version 1; a matched member whose date
differs gets version 1; a matched member with the same date (or a NULL on
either side) gets the old version + 1; every matched member's active row is
closed (flag only, no end date) and a new row inserted.
Rule ``conventional``: a changed date gives old + 1, the same date changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith.functions.columns import changed_flag
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
from loadsmith.specs import VersionedSpec


def versioned_classify(source: DataFrame, active: DataFrame,
                       spec: VersionedSpec = VersionedSpec(),
                       batch_rows: int | None = None) -> DataFrame:
    """Incoming rows + d_* reference columns, ``matched``, ``not_same_day``, ``route``."""
    src = prepare_batch(source, spec.key, [spec.date, *spec.dedup_order], spec.batch_dedup)
    active = batch_touched(active, source, spec.key, batch_rows, spec.broadcast_batch_rows)
    ref = active_reference(active, spec.key, spec.surrogate, [spec.date, spec.version],
                           spec.dedupe_reference)
    joined = src.join(ref, spec.key, "left")
    matched = F.col("_ls_hit").isNotNull()
    differs = F.when(matched, changed_flag(F.col(spec.date).cast("date"),
                                           F.col("d_" + spec.date).cast("date"),
                                           spec.null_policy, spec.date)).otherwise(F.lit(0))
    out = joined.select(*[F.col(c) for c in joined.columns if c != "_ls_hit"],
                        matched.alias("matched"), differs.alias("not_same_day"))
    route = (F.when(~F.col("matched"), F.lit(spec.new_route))
             .when(F.col("not_same_day") == 1, F.lit(spec.changed_route))
             .otherwise(F.lit(spec.same_route)))
    return out.withColumn("route", route)


def _version(spec: VersionedSpec):
    route, old = F.col("route"), F.col("d_" + spec.version)
    if spec.version_rule == "reference":
        return F.when(route == spec.same_route, old + 1).otherwise(F.lit(1)).cast("int")
    if spec.version_rule == "conventional":
        return F.when(route == spec.changed_route, old + 1).otherwise(F.lit(1)).cast("int")
    raise ValueError(f"unknown version_rule {spec.version_rule!r}")


def _inserted_routes(spec: VersionedSpec) -> list[str]:
    if spec.version_rule == "conventional":
        return [spec.new_route, spec.changed_route]
    return [spec.new_route, spec.changed_route, spec.same_route]


def _insert_rows(classified: DataFrame, spec: VersionedSpec) -> DataFrame:
    return classified.filter(F.col("route").isin(*_inserted_routes(spec))).select(
        F.col(spec.key), *[F.col(c) for c in spec.attributes],
        F.col(spec.date).cast("date").alias(spec.date),
        F.lit(1).alias(spec.flag),
        _version(spec).alias(spec.version),
        F.col("d_" + spec.surrogate).alias(EXPIRES))


def versioned_inserts(classified: DataFrame, spec: VersionedSpec = VersionedSpec()) -> DataFrame:
    return _insert_rows(classified, spec).drop(EXPIRES)


def versioned_expire(classified: DataFrame, spec: VersionedSpec = VersionedSpec()) -> DataFrame:
    """Reference rule: every matched active key; conventional: changed only."""
    routes = [r for r in _inserted_routes(spec) if r != spec.new_route]
    return (classified.filter(F.col("matched") & F.col("route").isin(*routes))
            .select(F.col("d_" + spec.surrogate).alias(spec.surrogate)).distinct())


def versioned_changes(dim: DataFrame, source: DataFrame, spec: VersionedSpec = VersionedSpec(),
                      start_after: int | None = None, active: DataFrame | None = None,
                      history: DataFrame | None = None, closing=None) -> ChangeSet:
    flag = F.col(spec.flag)
    active = dim.filter(flag == 1) if active is None else active
    history = dim.filter(flag.isNull() | (flag != 1)) if history is None else history
    batch_rows = None
    if spec.broadcast_batch_rows and is_large(active, spec.large_active_bytes):
        # one write of the batch gives its exact size and spares re-reading the source
        source, batch_rows = materialize_counted(source, "batch")
    classified = versioned_classify(source, active, spec, batch_rows)
    inserts = _insert_rows(classified, spec)
    if start_after is None:
        start_after = current_max_key(dim, spec.surrogate)
    keyed, max_key = keyed_with_max(inserts, spec.surrogate, [spec.key, spec.date], start_after,
                                    key_type=spec.key_type)
    small = batch_rows is not None and max_key - start_after <= spec.broadcast_batch_rows
    rows, parts = (active, None) if closing is None else closing(keyed)
    kept, closed = close_rows(rows, keyed, spec.key, spec.surrogate, spec.flag,
                              spec.dedupe_reference, broadcast_targets=small)
    cols = spec.dim_columns
    inserted = keyed.select(*cols)
    return ChangeSet(history=history.select(*cols), expired=closed.select(*cols),
                     active=kept.select(*cols).unionByName(inserted), inserted=inserted,
                     n_inserted=max_key - start_after, parts=parts)


def versioned_apply(dim: DataFrame, source: DataFrame, spec: VersionedSpec = VersionedSpec(),
                    start_after: int | None = None) -> DataFrame:
    return versioned_changes(dim, source, spec, start_after).next_dimension()
