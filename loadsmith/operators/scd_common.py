"""Pieces shared by the two dimension flavours."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith.operators.lookup import first_per_key

EXPIRES = "_ls_expires"  # surrogate of the active row an insert replaces


def prepare_batch(source: DataFrame, key: str, order_by, batch_dedup: str) -> DataFrame:
    """Duplicate incoming keys: keep all, keep the latest, or refuse the batch."""
    if batch_dedup == "none":
        return source
    if batch_dedup == "latest":
        return first_per_key(source, key, order_by, ascending=False)
    if batch_dedup == "error":
        dup = source.groupBy(key).count().filter(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError(f"incoming batch holds duplicate values of {key}")
        return source
    raise ValueError(f"unknown batch_dedup {batch_dedup!r}")


def batch_touched(active: DataFrame, source: DataFrame, key: str, batch_rows: int | None,
                  limit: int) -> DataFrame:
    """Active rows whose key occurs in the batch, when the batch is known small.

    ``batch_rows`` is an exact count of the batch, so the distinct keys
    broadcast here are bounded by ``limit``; the active side is streamed
    through a semi-join instead of being shuffled.  Rows it drops could not
    match the batch anyway.
    """
    if not limit or batch_rows is None or batch_rows > limit:
        return active
    return active.join(F.broadcast(source.select(key).distinct()), key, "left_semi")


def active_reference(active: DataFrame, key: str, surrogate: str, columns,
                     dedupe: bool) -> DataFrame:
    """Active rows as lookup reference: key, d_<surrogate>, d_<col>..., hit marker."""
    ref = active.select(key, surrogate, *columns)
    if dedupe:
        ref = first_per_key(ref, key, [surrogate])
    return ref.select(key, F.col(surrogate).alias("d_" + surrogate),
                      *[F.col(c).alias("d_" + c) for c in columns],
                      F.lit(True).alias("_ls_hit"))


@dataclass
class ChangeSet:
    """Result of applying one batch, kept in parts for copy-on-write publishing.

    history:  rows that were already closed (untouched)
    active:   the next active rows (kept + newly keyed)
    expired:  rows closed by this batch
    inserted: the newly keyed rows (subset of ``active``), ``n_inserted`` of them
    parts:    if set, ``active`` holds the rows of these parts only (see ``publish_dimension``)
    """

    history: DataFrame
    active: DataFrame
    expired: DataFrame
    inserted: DataFrame
    n_inserted: int = 0
    parts: list[int] | None = None

    def next_dimension(self) -> DataFrame:
        return self.history.unionByName(self.expired).unionByName(self.active)


def close_rows(active: DataFrame, keyed_inserts: DataFrame, key: str, surrogate: str,
               flag: str, dedupe: bool, end: str | None = None, end_value=None,
               broadcast_targets: bool = False):
    """Split the active rows into (still active, closed now).

    Expire targets travel with the keyed inserts (read from their checkpoint),
    so the classify join is not executed a second time.  ``broadcast_targets``
    is set by the caller only when the number of inserts (an upper bound of
    the targets) is known to be small.
    """
    targets = keyed_inserts.filter(F.col(EXPIRES).isNotNull())
    if dedupe:
        targets = targets.groupBy(key).agg(F.max(EXPIRES).alias("_ls_x"))
        if broadcast_targets:
            targets = F.broadcast(targets)
        marked = active.join(targets, key, "left").withColumn(
            "_ls_close", F.coalesce(F.col(surrogate) == F.col("_ls_x"), F.lit(False)))
    else:
        targets = targets.select(key, F.col(EXPIRES).alias(surrogate)).distinct() \
            .withColumn("_ls_x", F.lit(True))
        if broadcast_targets:
            targets = F.broadcast(targets)
        marked = active.join(targets, [key, surrogate], "left").withColumn(
            "_ls_close", F.col("_ls_x").isNotNull())
    cols = active.columns
    kept = marked.filter(~F.col("_ls_close")).select(*cols)
    closed_cols = []
    for c in cols:
        if c == flag:
            closed_cols.append(F.lit(0).cast(active.schema[c].dataType).alias(c))
        elif end is not None and c == end:
            closed_cols.append(F.lit(end_value).cast("date").alias(c))
        else:
            closed_cols.append(F.col(c))
    closed = marked.filter(F.col("_ls_close")).select(*closed_cols)
    return kept, closed
