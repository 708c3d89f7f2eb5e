"""MAX, MIN and COUNT from Parquet footers (A1, A3, A7): no column data is read.

Spark's own Parquet reader answers these from the statistics of the row groups if its
V2 form reads the files and aggregate push-down is on; both are set for the one query only.
Columns whose statistics don't give exact bounds (strings, timestamps of the old kind) are
read as usual: the answer is the same.  Files without any row group have no footer counts: a
pushed count over such files alone is null, not 0.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_V1, _PUSH = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


@contextmanager
def _pushed(spark: SparkSession):
    before = {k: spark.conf.get(k) for k in (_V1, _PUSH)}
    try:
        spark.conf.set(_V1, ",".join(s for s in before[_V1].split(",") if s.strip().lower() != "parquet"))
        spark.conf.set(_PUSH, "true")
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def footer_row(spark: SparkSession, path: str, aggregates: dict[str, Column]) -> tuple[Row, list[str]]:
    """One row of aggregates (``F.max``, ``F.min`` of whole columns, ``F.count``) and what the plan pushed to footers."""
    with _pushed(spark):
        asked = spark.read.parquet(path).agg(*(a.alias(n) for n, a in aggregates.items()))
        row = asked.first()
        return row, _pushed_aggregates(asked)


def _pushed_aggregates(df: DataFrame) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [part.split("]")[0] for part in plan.split("PushedAggregation: [")[1:]]


def max_key_and_rows(spark: SparkSession, path: str, key: str) -> tuple[int, int]:
    """The largest key (0 for an empty table) and the number of rows, from footers."""
    row, _ = footer_row(spark, path, {"top": F.max(key), "n": F.count(F.lit(1))})
    return int(row["top"] or 0), int(row["n"] or 0)
