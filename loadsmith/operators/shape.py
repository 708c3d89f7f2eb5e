"""Column mapping, derived columns and sink casts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def map_columns(df: DataFrame, mapping) -> DataFrame:
    """``mapping`` = [(target, source column or Column, type or None), ...]."""
    cols = []
    for target, src, typ in mapping:
        c = F.col(src) if isinstance(src, str) else src
        cols.append((c.cast(typ) if typ else c).alias(target))
    return df.select(*cols)


def conform(df: DataFrame, target_schema: str, defaults: dict | None = None) -> DataFrame:
    """Project to a target schema: missing columns NULL (or default), all cast."""
    st = StructType.fromDDL(target_schema)
    defaults = defaults or {}
    cols = []
    for f in st.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
