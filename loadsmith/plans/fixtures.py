"""Dimension sources and documents derived from the driver's tables.

The employee-like source is built from ``orders``: a customer's state in a
date window is its last order by (o_orderdate desc, o_orderkey desc) with
ID = o_custkey, City = o_orderpriority, Email = o_orderstatus, date = order date,
Name = c_name.  dim0 = state before 1996; the batch of the single-batch queries is all the
rest; the two-batch and stream queries cut it in two: 1996, and all after it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.operators.keys import assign_surrogate_keys
from loadsmith.operators.lookup import first_per_key
from loadsmith.specs import Type6Spec, VersionedSpec

# Fixed values of the fixture (dates of the windows and run dates).
DIM0_END = dt.date(1996, 1, 1)
BATCH1 = (dt.date(1996, 1, 1), dt.date(1997, 1, 1))
BATCH2 = (dt.date(1997, 1, 1), None)  # to the end of the data
REST = (DIM0_END, None)
RUN1 = dt.date(1997, 1, 1)
RUN2 = dt.date(1999, 1, 1)
CONV_PAGE = 50      # turns per conversation document
PART_PAGE = 100     # products per document
EMB_PAGE = 50       # vectors per 2-D document

T6 = Type6Spec()
VS = VersionedSpec()


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is inferred once per path (the tables are read-only)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _midnight(d: dt.date):
    """Midnight of ``d`` as TIMESTAMP_NTZ, independent of any time zone."""
    return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")


def order_states(spark: SparkSession, sf_dir: str, lo: dt.date | None = None,
                 hi: dt.date | None = None) -> DataFrame:
    """One source row per order, date window [lo, hi) on the raw column (pushed down)."""
    return _states_with_raw(spark, sf_dir, lo, hi, "d").drop("o_orderdate")


def latest_states(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    return first_per_key(order_states(spark, sf_dir, lo, hi), "ID", ["d", "o_orderkey"],
                         ascending=False)


def with_names(spark, sf_dir, df: DataFrame) -> DataFrame:
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ID"),
                                                    F.col("c_name").alias("Name"))
    return df.join(names, "ID", "left")


def employee_source(spark, sf_dir, lo=None, hi=None) -> DataFrame:
    """Per-order source rows (ID, City, Email, Update_Date, o_orderkey) plus the raw
    ``o_orderdate`` the date comes from (for pushed-down extraction bounds)."""
    return _states_with_raw(spark, sf_dir, lo, hi, "Update_Date")


def _states_with_raw(spark, sf_dir, lo, hi, date_name):
    o = table(spark, sf_dir, "orders")
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("o_orderdate") >= _midnight(lo))
    if hi is not None:
        cond = cond & (F.col("o_orderdate") < _midnight(hi))
    return o.filter(cond).select(
        F.col("o_custkey").alias("ID"), F.col("o_orderpriority").alias("City"),
        F.col("o_orderstatus").alias("Email"), F.col("o_orderdate").cast("date").alias(date_name),
        "o_orderkey", "o_orderdate")


def named_source(spark, sf_dir, date_name: str = "Update_Date") -> DataFrame:
    """The source system table: one row per order with the customer's name."""
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ID"),
                                                    F.col("c_name").alias("Name"))
    return (_states_with_raw(spark, sf_dir, None, None, date_name).join(names, "ID", "left")
            .select("ID", "Name", "City", "Email", date_name, "o_orderkey", "o_orderdate"))


def type6_batch(spark, sf_dir, window=REST, null_city: bool = False) -> DataFrame:
    b = with_names(spark, sf_dir, latest_states(spark, sf_dir, *window))
    city = F.when(F.col("ID") % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("City")) \
        if null_city else F.col("City")
    return b.select("ID", "Name", city.alias("City"), "Email", F.col("d").alias("Update_Date"))


def type6_dim0(spark, sf_dir) -> DataFrame:
    s = with_names(spark, sf_dir, latest_states(spark, sf_dir, None, DIM0_END))
    rows = s.select("ID", "Name", F.col("City").alias("CURRENTCity"),
                    F.lit(None).cast("string").alias("HESTORICALCity"),
                    F.col("Email").alias("CURRENTEmail"),
                    F.lit(None).cast("string").alias("HESTORICALEmail"),
                    F.col("d").alias("STARTDate"), F.lit(None).cast("date").alias("ENDDate"),
                    F.lit(1).alias("Active_Flag"))
    return assign_surrogate_keys(rows, "Emp_Key", ["ID"], 0).select(*T6.dim_columns)


def versioned_dim0(spark, sf_dir) -> DataFrame:
    s = with_names(spark, sf_dir, latest_states(spark, sf_dir, None, DIM0_END))
    rows = s.select("ID", "Name", "City", "Email", F.col("d").alias("Schedule_Date"),
                    F.lit(1).alias("Active_Flag"), (F.col("ID") % 5 + 1).cast("int").alias("Version_No"))
    return assign_surrogate_keys(rows, "Emp_Key", ["ID"], 0).select(*VS.dim_columns)


def versioned_batch(spark, sf_dir, dim0: DataFrame) -> DataFrame:
    """The batch with Schedule_Date; for ID % 4 = 0 matched rows keep dim0's date."""
    b = with_names(spark, sf_dir, latest_states(spark, sf_dir, *REST))
    prior = dim0.filter(F.col("Active_Flag") == 1).select("ID", F.col("Schedule_Date").alias("_d0"))
    j = b.join(prior, "ID", "left")
    date = F.when((F.col("ID") % 4 == 0) & F.col("_d0").isNotNull(), F.col("_d0")).otherwise(F.col("d"))
    return j.select("ID", "Name", "City", "Email", date.alias("Schedule_Date"))


# --- documents ----------------------------------------------------------------

CONV_SCHEMA = ("conv_id bigint, page bigint, n_turns bigint, "
               "turns array<struct<turn: bigint, role: string, text: string>>")
PRODUCT_SCHEMA = ("products array<struct<id: bigint, title: string, price: double, "
                  "discountPercentage: double, stock: bigint, brand: string, category: string, "
                  "rating: double>>, total bigint, skip bigint, limit bigint, page bigint")
EMB_SCHEMA = "page bigint, names array<string>, rows array<array<double>>"


def conversation_documents(spark, sf_dir) -> DataFrame:
    """One JSON document (``doc``) per conversation page of at most 50 turns."""
    c = table(spark, sf_dir, "conversations")
    pages = c.groupBy("conv_id", F.expr(f"turn div {CONV_PAGE}").alias("page")).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return pages.select("conv_id", "page",
                        F.to_json(F.struct("conv_id", "page", "n_turns", "turns")).alias("doc"))


def product_documents(spark, sf_dir) -> DataFrame:
    """``part`` as product documents {"products": [...], "total", "skip", "limit"}, 100 per page."""
    p = table(spark, sf_dir, "part")
    elem = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
                    F.col("p_retailprice").alias("price"),
                    F.col("p_size").cast("double").alias("discountPercentage"),
                    F.col("p_size").cast("bigint").alias("stock"), F.col("p_brand").alias("brand"),
                    F.col("p_type").alias("category"),
                    (F.col("p_size").cast("double") / 10).alias("rating"))
    pages = p.groupBy(F.expr(f"p_partkey div {PART_PAGE}").alias("page")).agg(
        F.sort_array(F.collect_list(elem)).alias("products"), F.count(F.lit(1)).alias("total"))
    return pages.select("page", F.to_json(F.struct(
        "products", "total", (F.col("page") * PART_PAGE).alias("skip"),
        F.lit(PART_PAGE).cast("bigint").alias("limit"), "page")).alias("doc"))


def embedding_width(spark, sf_dir) -> int:
    """The longest vector of the table."""
    return int(table(spark, sf_dir, "embeddings").agg(F.max(F.size("embedding"))).first()[0] or 0)


def embedding_columns(width: int) -> list[str]:
    return ["vec_id", "label", *(f"e{i}" for i in range(width))]


def embedding_documents(spark, sf_dir, width: int) -> DataFrame:
    """2-D documents: a names array and rows of all values, 50 vectors per page."""
    e = table(spark, sf_dir, "embeddings")
    row = F.concat(F.array(F.col("vec_id").cast("double"), F.col("label").cast("double")),
                   F.col("embedding").cast("array<double>"))
    pages = e.groupBy(F.expr(f"vec_id div {EMB_PAGE}").alias("page")).agg(
        F.collect_list(row).alias("rows"))
    names = F.array(*[F.lit(n) for n in embedding_columns(width)])
    return pages.select("page", F.to_json(F.struct("page", names.alias("names"), "rows")).alias("doc"))
