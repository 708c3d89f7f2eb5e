"""Create-if-missing table definitions (K11) for the four targets."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Target schemas (column names and types the loads produce).
PRODUCT_DDL = ("id BIGINT, title STRING, price BIGINT, discountPercentage DOUBLE, stock BIGINT, "
               "brand STRING, category STRING, rating DOUBLE")
TYPE6_DDL = ("Emp_Key BIGINT, ID BIGINT, Name STRING, CURRENTCity STRING, HESTORICALCity STRING, "
             "CURRENTEmail STRING, HESTORICALEmail STRING, STARTDate DATE, ENDDate DATE, Active_Flag INT")
VERSIONED_DDL = ("Emp_Key BIGINT, ID BIGINT, Name STRING, City STRING, Email STRING, "
                 "Schedule_Date DATE, Active_Flag INT, Version_No INT")
RUNLOG_DDL = ("run_id STRING, package STRING, step STRING, status STRING, row_count BIGINT, "
              "message STRING, started_at TIMESTAMP, ended_at TIMESTAMP")


def create_table_if_missing(spark: SparkSession, name: str, ddl: str, location: str | None = None,
                            fmt: str = "parquet", partitioned_by=None,
                            bucketed_by: tuple[str, int] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS``; ``bucketed_by=(key, n)`` co-locates joins on key."""
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt}"
    if partitioned_by:
        sql += f" PARTITIONED BY ({', '.join(partitioned_by)})"
    if bucketed_by:
        sql += f" CLUSTERED BY ({bucketed_by[0]}) SORTED BY ({bucketed_by[0]}) INTO {bucketed_by[1]} BUCKETS"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)
