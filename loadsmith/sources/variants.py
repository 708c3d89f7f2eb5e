"""JSON as VARIANT: parsed once, kept typed, read by path.

A VARIANT column keeps nested values with their own types, where ``nested_as_string``
turns them into JSON text again.  Fields come out by path and type; an array turns into rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_variant(df: DataFrame, text_col: str, alias: str, strict: bool = True) -> DataFrame:
    """``df`` with the JSON text parsed into the VARIANT column ``alias``.

    Null text gives null.  Malformed text fails the read, or gives null if not ``strict``.
    """
    parse = F.parse_json if strict else F.try_parse_json
    return df.withColumn(alias, parse(F.col(text_col)))


def variant_fields(df: DataFrame, column: str, fields: dict[str, tuple[str, str]], keep=(), strict: bool = True) -> DataFrame:
    """The kept columns and one typed column per field: name -> (path, type).

    A path that is missing gives null; a value that can't be cast fails the read, or gives null if not
    ``strict``.  Type ``variant`` keeps a nested value as it is.
    """
    get = F.variant_get if strict else F.try_variant_get
    return df.select(*keep, *(get(F.col(column), path, kind).alias(name) for name, (path, kind) in fields.items()))


def explode_variant(df: DataFrame, column: str, path: str = "$", keep=()) -> DataFrame:
    """One row per element of the array (or field of the object) at ``path``: the kept columns, pos, key, value.

    ``value`` is VARIANT.  A missing path, a null and a plain value give no rows.
    """
    inner = df.select(*keep, F.try_variant_get(F.col(column), path, "variant").alias("_ls_v"))
    rows = inner.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_ls_v").outer()))
    return rows.select(*keep, "pos", "key", "value")
