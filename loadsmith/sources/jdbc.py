"""JDBC source and sink.

Reads are parallel when a numeric/date partition column and bounds are given
(``numPartitions`` range queries); otherwise the query runs as one task.  The
watermark filter should be applied as a DataFrame filter on a ``dbtable``
read so that Spark pushes it into the database as a typed predicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 10000,
              properties: dict | None = None) -> DataFrame:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    reader = reader.option("dbtable", table) if table else reader.option("query", query)
    if partition_column:
        if table is None:
            raise ValueError("partitioned reads need dbtable, not query")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", num_partitions or 8))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               truncate: bool = False, batch_size: int = 10000,
               num_partitions: int | None = None, properties: dict | None = None) -> None:
    """Append, or truncate-and-reload (``mode="overwrite", truncate=True``)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    writer = (out.write.format("jdbc").option("url", url).option("dbtable", table)
              .option("batchsize", batch_size).option("truncate", truncate).mode(mode))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
