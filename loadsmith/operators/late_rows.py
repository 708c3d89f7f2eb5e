"""Late rows of a type-6 dimension: they get their place in the history.

A row is late if it is dated before the start of its key's active version; an
incremental load would drop it (or let it pass as news).  The versions of the keys
with late rows and the late rows are put in order of date and chained anew:

- rows that change no tracked attribute against the one before them are dropped;
- a late row that says earlier what a later version says first moves that version's
  start back (it keeps its surrogate key);
- any other late row is a new version with a new key: it ends the version before it
  and starts its own interval;
- CURRENT/HISTORICAL pairs and end dates follow from the new neighbours.

Versions of other keys aren't touched, the active row stays active, and no version
is removed.  The rows of one call may come in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.operators.keys import assign_surrogate_keys, current_max_key
from loadsmith.operators.lookup import first_per_key
from loadsmith.session import materialize
from loadsmith.specs import Type6Spec


def split_late(batch: DataFrame, dim: DataFrame, spec: Type6Spec = Type6Spec()) -> tuple[DataFrame, DataFrame]:
    """(on time, late): rows dated before the start of their key's active version are late.

    New keys, rows without a date and rows of keys without an active version are on time.
    """
    starts = (dim.filter(F.col(spec.flag) == 1).groupBy(F.col(spec.key).alias("_ls_key"))
              .agg(F.min(spec.start).alias("_ls_start")))
    placed = batch.join(starts, batch[spec.key] == F.col("_ls_key"), "left")
    late = F.coalesce(F.col(spec.source_date) < F.col("_ls_start"), F.lit(False))
    return placed.filter(~late).select(*batch.columns), placed.filter(late).select(*batch.columns)


def _changed(spec: Type6Spec, order) -> Column:
    """Whether any tracked attribute differs (null-safe) from the row before; true for a key's first row."""
    first = F.lag(F.lit(1)).over(order).isNull()
    differs = [~F.col(t.current).eqNullSafe(F.lag(t.current).over(order)) for t in spec.tracked]
    out = first
    for d in differs:
        out = out | d
    return out


def insert_late_rows(dim: DataFrame, late: DataFrame, spec: Type6Spec = Type6Spec(),
                     start_after: int | None = None) -> DataFrame:
    """The dimension with the late rows in their places.

    ``late`` has the source's columns.  Of several rows of a key and date the last by
    ``spec.dedup_order`` counts; a row dated like an existing version gives way to it.
    Values are compared null-safe.  Rows of a null key match nothing.
    """
    key = spec.key
    late = late.filter(F.col(key).isNotNull() & F.col(spec.source_date).isNotNull())
    by = [key, spec.source_date]
    late = first_per_key(late, by, list(spec.dedup_order) or [c for c in late.columns if c not in by], ascending=False)
    touched = late.select(key).distinct()
    own = dim.join(touched, key, "left_semi").select(*spec.dim_columns)
    rest = dim.join(touched, key, "left_anti").select(*spec.dim_columns)
    blank = {c: F.lit(None).cast(dim.schema[c].dataType) for c in spec.dim_columns}
    new = late.select(*(
        {**blank, key: F.col(key), spec.start: F.col(spec.source_date), **{c: F.col(c) for c in spec.carried},
         **{t.current: F.col(t.source) for t in spec.tracked}}[c].cast(dim.schema[c].dataType).alias(c)
        for c in spec.dim_columns))
    new = new.join(own.select(key, spec.start).distinct(), [key, spec.start], "left_anti").select(*spec.dim_columns)

    rows = own.unionByName(new)
    order = Window.partitionBy(key).orderBy(spec.start, spec.surrogate)
    run = Window.partitionBy(key, "_ls_run")
    told = rows.withColumn("_ls_run", F.sum(_changed(spec, order).cast("int")).over(order))
    # A run says the same thing: its first row stands for it, with the first existing version's key.
    known = F.min(F.when(F.col(spec.surrogate).isNotNull(), F.struct(spec.start, spec.surrogate))).over(run)
    told = told.withColumns({"_ls_first": F.min(spec.start).over(run), "_ls_known": known[spec.surrogate]})
    existing, is_first = F.col(spec.surrogate).isNotNull(), F.col(spec.start) == F.col("_ls_first")
    kept = told.filter(existing | (is_first & F.col("_ls_known").isNull()))
    start = F.when(F.col(spec.surrogate) == F.col("_ls_known"), F.col("_ls_first")).otherwise(F.col(spec.start))
    kept = kept.withColumn(spec.start, start).drop("_ls_run", "_ls_first", "_ls_known")

    # The pairs: what an attribute was before its last change; a key's first version keeps what it has.
    chain = {}
    for t in spec.tracked:
        at_first = F.lag(F.lit(1)).over(order).isNull()
        before = F.lag(t.current).over(order)
        chain[f"_ls_{t.history}"] = F.when(at_first, F.struct(F.col(t.history).alias("v"))).when(
            ~F.col(t.current).eqNullSafe(before), F.struct(before.alias("v")))
    linked = kept.withColumns(chain)
    nxt = F.lead(spec.start).over(order)
    linked = linked.withColumns({
        **{t.history: F.last(f"_ls_{t.history}", ignorenulls=True).over(order)["v"] for t in spec.tracked},
        spec.end: F.coalesce(nxt, F.col(spec.end)),
        spec.flag: F.when(nxt.isNotNull(), F.lit(0)).otherwise(F.col(spec.flag)).cast(dim.schema[spec.flag].dataType)})
    chained = materialize(linked.select(*spec.dim_columns), "late-chains")
    top = current_max_key(dim, spec.surrogate) if start_after is None else start_after
    fresh = assign_surrogate_keys(chained.filter(F.col(spec.surrogate).isNull()).drop(spec.surrogate),
                                  spec.surrogate, [key, spec.start], top, key_type=spec.key_type)
    return (rest.unionByName(chained.filter(F.col(spec.surrogate).isNotNull()))
            .unionByName(fresh.select(*spec.dim_columns)))
