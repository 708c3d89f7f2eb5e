"""Scalar column helpers.  All are built-in Column expressions (codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def changed_flag(incoming: Column, current: Column, null_policy: str = "ignore",
                 label: str = "value") -> Column:
    """``(a != b) ? 1 : 0`` as an int column.

    ignore   – NULL on either side compares as "not changed" (0);
    distinct – null-safe: NULL vs value is a change, NULL vs NULL is not;
    fail     – a NULL on either side raises at run time.
    """
    if null_policy == "ignore":
        return F.when(incoming != current, F.lit(1)).otherwise(F.lit(0))
    if null_policy == "distinct":
        return F.when(~incoming.eqNullSafe(current), F.lit(1)).otherwise(F.lit(0))
    if null_policy == "fail":
        return (F.when(incoming.isNull() | current.isNull(),
                       F.raise_error(F.lit(f"NULL in change comparison of {label}")))
                .when(incoming != current, F.lit(1)).otherwise(F.lit(0)))
    raise ValueError(f"unknown null_policy {null_policy!r}")


def round_to_bigint(c: Column, mode: str = "half_up") -> Column:
    """Double -> bigint.  half_up: 0.5 -> 1, 2.5 -> 3, -0.5 -> -1."""
    if mode == "half_up":
        return F.round(c, 0).cast("bigint")
    if mode == "trunc":
        return c.cast("bigint")
    if mode == "floor":
        return F.floor(c).cast("bigint")
    raise ValueError(f"unknown rounding mode {mode!r}")


def blank_as_null(c: Column, to_type: str) -> Column:
    """Blank or unparsable text -> NULL, else the value cast to ``to_type``."""
    return F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast(to_type)


def typed_null(to_type: str) -> Column:
    return F.lit(None).cast(to_type)


def null_default(c: Column, default) -> Column:
    """NULL -> default (keep-nulls off / watermark floor / max key 0)."""
    return F.coalesce(c, F.lit(default))
