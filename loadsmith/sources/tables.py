"""Table scans (S12, S14-S17): catalog tables or parquet paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def is_path(name_or_path: str) -> bool:
    return "/" in name_or_path or ":" in name_or_path


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or files by path."""
    if is_path(name_or_path):
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    """Typed empty dimension for a first load."""
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A catalog table, or a typed empty frame while it doesn't exist."""
    return read_table(spark, name) if spark.catalog.tableExists(name) else empty_frame(spark, schema)
