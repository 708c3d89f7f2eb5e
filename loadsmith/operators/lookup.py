"""Lookup against a reference set (J1-J6) and one-row-per-key selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_per_key(df: DataFrame, key, order_by, ascending: bool = True) -> DataFrame:
    """One row per key: the one with the smallest (or largest) ``order_by`` tuple.

    ``min``/``max`` of a struct led by the ordering columns is combined
    map-side before the shuffle, so a key holding a large share of the rows
    never lands whole in one task (a ``row_number()`` window would).  Rows
    tied on the whole ordering are told apart by the remaining columns.
    """
    keys = _as_list(key)
    order = _as_list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = [F.col(c).alias(f"_ls_{i}") for i, c in enumerate(order + rest)]
    pick = F.min if ascending else F.max
    picked = df.groupBy(*keys).agg(pick(F.struct(*fields)).alias("_ls_row"))
    names = order + rest
    return picked.select(*[F.col(c) if c in keys else
                           F.col(f"_ls_row._ls_{names.index(c)}").alias(c) for c in df.columns])


def reference_columns(reference: DataFrame, on, columns=None, prefix: str = "d_",
                      dedupe_by=None) -> DataFrame:
    """Reference side of a lookup: key + renamed copied columns + a hit marker."""
    keys = _as_list(on)
    ref = reference
    if dedupe_by is not None:
        ref = first_per_key(ref.select(*keys, *[c for c in (columns or ref.columns)
                                                if c not in keys]), keys, dedupe_by)
    keep = [c for c in (columns or ref.columns) if c not in keys]
    return ref.select(*keys, *[F.col(c).alias(prefix + c) for c in keep],
                      F.lit(True).alias("_ls_hit"))


def lookup(source: DataFrame, reference: DataFrame, on, columns=None, prefix: str = "d_",
           dedupe_by=None, matched_col: str = "matched") -> DataFrame:
    """Left lookup: every source row, reference columns copied, ``matched`` flag.

    The flag comes from a literal on the reference side, so it is right even when
    a copied reference column is NULL.
    """
    keys = _as_list(on)
    ref = reference_columns(reference, keys, columns, prefix, dedupe_by)
    joined = source.join(ref, keys, "left")
    return joined.withColumn(matched_col, F.col("_ls_hit").isNotNull()).drop("_ls_hit")


def lookup_match(source: DataFrame, reference: DataFrame, on, columns=None,
                 prefix: str = "d_", dedupe_by=None) -> DataFrame:
    """Match output: source rows with a reference row, reference columns added."""
    keys = _as_list(on)
    ref = reference_columns(reference, keys, columns, prefix, dedupe_by).drop("_ls_hit")
    return source.join(ref, keys, "inner")


def lookup_no_match(source: DataFrame, reference: DataFrame, on) -> DataFrame:
    """No-match output: source rows whose key is absent from the reference."""
    keys = _as_list(on)
    return source.join(reference.select(*keys), keys, "left_anti")
