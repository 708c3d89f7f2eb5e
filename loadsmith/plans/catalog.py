"""Registered queries: one per operator of the inventory, each with oracle SQL.

Every query reads the driver's tables (or data Spark derives from them) in
full.  ``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the
DuckDB SQL over the same tables.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadsmith.operators import checks
from loadsmith.operators.history import previous_values
from loadsmith.operators.keys import assign_surrogate_keys, current_max_key
from loadsmith.operators.late_rows import insert_late_rows, split_late
from loadsmith.operators.lookup import lookup, lookup_match, lookup_no_match
from loadsmith.operators.primary_key import (
    append_keyed,
    check_state,
    key_violations,
    part_count,
    renewed_state,
    sketch_cells,
)
from loadsmith.operators.rejects import max_length, parse_status, split_rejects, write_with_rejects
from loadsmith.operators.scd_type6 import (
    type6_apply,
    type6_changes,
    type6_classify,
    type6_expire,
    type6_inserts,
)
from loadsmith.operators.scd_versioned import (
    versioned_apply,
    versioned_changes,
    versioned_classify,
    versioned_expire,
    versioned_inserts,
)
from loadsmith.operators.shape import conform
from loadsmith.operators.split import conditional_split, keep_wired
from loadsmith.operators.watermark import full_scan, high_watermark, incremental_scan, watermark_value
from loadsmith.plans import fixtures as fx
from loadsmith.plans import oracle as sql
from loadsmith.plans.products import product_rows, transform_products
from loadsmith.session import materialize, scratch_path
from loadsmith.sinks.publish import (
    append_load,
    land_documents,
    publish_dimension,
    read_active,
    read_dimension,
    read_history,
    truncate_reload,
    write_observed,
)
from loadsmith.sources.documents import (
    first_rows,
    nested_as_string,
    parse_column,
    parse_documents,
    read_documents,
    read_raw_documents,
    replace_in_text,
    rows_from_2d,
    to_name_value,
)
from loadsmith.sources.footers import footer_row
from loadsmith.functions.columns import blank_as_null, changed_flag
from loadsmith.specs import DocumentSpec, Type6Spec, VersionedSpec
from loadsmith.plans.jobs import (
    T6_EMPTY,
    run_product_load,
    run_type6_load,
    run_versioned_load,
    seed_dimension,
)
from loadsmith.sinks.ddl import PRODUCT_DDL, create_table_if_missing
from loadsmith.sources.tables import read_or_empty, read_table
from loadsmith.streaming import read_ingested, start_document_stream, start_scd_stream
from loadsmith.sources.variants import explode_variant, variant_fields, with_variant

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# --- lookups (J1, J4, J5) ------------------------------------------------------

_REF_CUSTOMERS = "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'"


def _ref_customers(spark, sf_dir):
    return (fx.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
            .withColumnRenamed("c_custkey", "o_custkey"))


@register("lookup_match", f"SELECT o.o_orderkey, o.o_custkey, c.c_name AS d_c_name, "
                          f"c.c_nationkey AS d_c_nationkey FROM orders o JOIN ({_REF_CUSTOMERS}) c "
                          f"ON c.c_custkey = o.o_custkey")
def q_lookup_match(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lookup_match(o, _ref_customers(spark, sf_dir), "o_custkey", ["c_name", "c_nationkey"])


@register("lookup_no_match", f"SELECT o.o_orderkey, o.o_custkey FROM orders o WHERE NOT EXISTS "
                             f"(SELECT 1 FROM ({_REF_CUSTOMERS}) c WHERE c.c_custkey = o.o_custkey)")
def q_lookup_no_match(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lookup_no_match(o, _ref_customers(spark, sf_dir), "o_custkey")


@register("lookup_first_match",
          "SELECT o.o_orderkey, o.o_custkey, l.l_linenumber AS d_l_linenumber, "
          "l.l_partkey AS d_l_partkey, l.l_suppkey AS d_l_suppkey, l.l_orderkey IS NOT NULL AS matched "
          "FROM orders o LEFT JOIN (SELECT * FROM lineitem QUALIFY row_number() OVER "
          "(PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1) l "
          "ON l.l_orderkey = o.o_orderkey")
def q_lookup_first_match(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = (fx.table(spark, sf_dir, "lineitem")
          .select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey"))
    return lookup(o, li, "o_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"],
                  dedupe_by=["l_linenumber", "l_partkey", "l_suppkey"])


# --- conditional split / derived columns (P4-P10) -------------------------------------

@register("conditional_split",
          "SELECT route, COUNT(*) AS n_lines, SUM(l_quantity) AS sum_qty FROM (SELECT *, CASE "
          "WHEN l_quantity >= 40 THEN 'bulk' WHEN l_discount >= 0.08 THEN 'deep_discount' "
          "WHEN l_quantity < 10 OR l_discount = 0 THEN 'small_or_free' ELSE 'other' END AS route "
          "FROM lineitem) WHERE route IN ('bulk', 'deep_discount', 'small_or_free') GROUP BY route")
def q_conditional_split(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    q, d = F.col("l_quantity"), F.col("l_discount")
    routed = conditional_split(li, [("bulk", q >= 40), ("deep_discount", d >= 0.08),
                                    ("small_or_free", (q < 10) | (d == 0))], default="other")
    wired = keep_wired(routed, ["bulk", "deep_discount", "small_or_free"])
    return wired.groupBy("route").agg(F.count(F.lit(1)).alias("n_lines"),
                                      F.sum("l_quantity").alias("sum_qty"))


@register("derived_flags", sql.with_(
    [("dim0", sql.T6_DIM0), ("vdim0", sql.V_DIM0), ("b1", sql.t6_batch(null_city=True))],
    f"SELECT b.ID, CASE WHEN b.City <> a.CURRENTCity THEN 1 ELSE 0 END AS city_ignore, "
    f"CASE WHEN b.City IS DISTINCT FROM a.CURRENTCity THEN 1 ELSE 0 END AS city_distinct, "
    f"CASE WHEN b.Email <> a.CURRENTEmail THEN 1 ELSE 0 END AS email_ignore, "
    f"CASE WHEN b.Email IS DISTINCT FROM a.CURRENTEmail THEN 1 ELSE 0 END AS email_distinct, "
    f"CAST(v.Version_No + 1 AS INTEGER) AS next_version, 1 AS Active_Flag, "
    f"{sql.lit_date(fx.RUN2)} AS load_date "
    f"FROM b1 b JOIN dim0 a ON a.ID = b.ID JOIN vdim0 v ON v.ID = b.ID"))
def q_derived_flags(spark, sf_dir):
    dim0 = fx.type6_dim0(spark, sf_dir).select("ID", "CURRENTCity", "CURRENTEmail")
    vdim0 = fx.versioned_dim0(spark, sf_dir).select("ID", "Version_No")
    b = fx.type6_batch(spark, sf_dir, null_city=True)
    m = b.join(dim0, "ID").join(vdim0, "ID")
    c, e = (F.col("City"), F.col("CURRENTCity")), (F.col("Email"), F.col("CURRENTEmail"))
    return m.select(
        "ID",
        changed_flag(*c, "ignore").alias("city_ignore"),
        changed_flag(*c, "distinct").alias("city_distinct"),
        changed_flag(*e, "ignore").alias("email_ignore"),
        changed_flag(*e, "distinct").alias("email_distinct"),
        (F.col("Version_No") + 1).cast("int").alias("next_version"),
        F.lit(1).alias("Active_Flag"),
        F.lit(fx.RUN2).cast("date").alias("load_date"))


# --- watermark / extraction (A1, A2, F8, S12, S13, C8) ---------------------------------

@register("high_watermark", sql.with_(
    [("dim0", sql.T6_DIM0)],
    "SELECT COALESCE(MAX(STARTDate), DATE '1900-01-01') AS watermark FROM dim0 WHERE Active_Flag = 1"))
def q_high_watermark(spark, sf_dir):
    return high_watermark(fx.type6_dim0(spark, sf_dir), "STARTDate")


@register("watermark_empty", sql.with_(
    [("dim0", sql.T6_DIM0)],
    "SELECT COALESCE(MAX(STARTDate), DATE '1900-01-01') AS watermark FROM "
    "(SELECT STARTDate, CASE WHEN ENDDate IS NULL AND Emp_Key > 0 THEN 0 ELSE Active_Flag END AS Active_Flag "
    "FROM dim0) WHERE Active_Flag = 1"))
def q_watermark_empty(spark, sf_dir):
    """Every member is closed by a predicate on its row, so the floor is what is left."""
    gone = F.col("ENDDate").isNull() & (F.col("Emp_Key") > 0)
    closed = fx.type6_dim0(spark, sf_dir).withColumn(
        "Active_Flag", F.when(gone, 0).otherwise(F.col("Active_Flag")))
    return high_watermark(closed, "STARTDate")


@register("watermark_schedule_date", sql.with_(
    [("vdim0", sql.V_DIM0)],
    "SELECT COALESCE(MAX(Schedule_Date), DATE '1900-01-01') AS watermark FROM vdim0 WHERE Active_Flag = 1"))
def q_watermark_schedule_date(spark, sf_dir):
    return high_watermark(fx.versioned_dim0(spark, sf_dir), "Schedule_Date")


_SRC_SQL = ("SELECT o_custkey AS ID, o_orderpriority AS City, o_orderstatus AS Email, "
            "CAST(o_orderdate AS DATE) AS Update_Date, o_orderkey FROM orders")


@register("incremental_scan", sql.with_(
    [("dim0", sql.T6_DIM0), ("src", _SRC_SQL)],
    f"SELECT * FROM src WHERE Update_Date > (SELECT COALESCE(MAX(STARTDate), DATE '1900-01-01') "
    f"FROM dim0 WHERE Active_Flag = 1) AND Update_Date < {sql.lit_date(fx.RUN1)}"))
def q_incremental_scan(spark, sf_dir):
    wm = watermark_value(fx.type6_dim0(spark, sf_dir), "STARTDate")
    return incremental_scan(fx.employee_source(spark, sf_dir), "Update_Date", wm, upper=fx.RUN1,
                            timestamp_col="o_orderdate").drop("o_orderdate")


@register("full_scan", _SRC_SQL)
def q_full_scan(spark, sf_dir):
    return full_scan(fx.employee_source(spark, sf_dir)).drop("o_orderdate")


# --- type-6 dimension (C1-C4, K5, W1) ------------------------------------------------------

def _t6_inputs(spark, sf_dir, null_city=False, window=fx.REST):
    return fx.type6_dim0(spark, sf_dir), fx.type6_batch(spark, sf_dir, window, null_city)


@register("type6_classify", sql.with_(sql.t6_base_ctes(), "SELECT * FROM s1_cls"))
def q_type6_classify(spark, sf_dir):
    dim0, b1 = _t6_inputs(spark, sf_dir)
    return type6_classify(b1, dim0.filter("Active_Flag = 1"))


@register("type6_null_routes", sql.with_(
    sql.t6_base_ctes(null_city=True) + [("d_cls", sql.t6_classify("b1", "dim0", "distinct"))],
    "SELECT 'ignore' AS null_policy, route, COUNT(*) AS n FROM s1_cls GROUP BY route "
    "UNION ALL SELECT 'distinct' AS null_policy, route, COUNT(*) AS n FROM d_cls GROUP BY route"))
def q_type6_null_routes(spark, sf_dir):
    dim0, b1 = _t6_inputs(spark, sf_dir, null_city=True)
    active = dim0.filter("Active_Flag = 1")
    ignored = type6_classify(b1, active, Type6Spec())  # one join; the other policy's flags beside it
    seen = ignored.withColumns({
        f"x_{c}": F.when(F.col("matched"), changed_flag(F.col(c), F.col(f"d_CURRENT{c}"), "distinct")).otherwise(0)
        for c in ("City", "Email")})
    distinct = (F.when(~F.col("matched"), "new").when((F.col("x_City") == 1) & (F.col("x_Email") == 1), "both")
                .when(F.col("x_City") == 1, "city").when(F.col("x_Email") == 1, "email").otherwise("none"))
    both = seen.select(F.explode(F.array(
        F.struct(F.lit("ignore").alias("null_policy"), F.col("route")),
        F.struct(F.lit("distinct").alias("null_policy"), distinct.alias("route")))).alias("p"))
    return both.groupBy("p.null_policy", "p.route").agg(F.count(F.lit(1)).alias("n"))


@register("type6_inserts", sql.with_(
    sql.t6_base_ctes(), f"SELECT {sql.T6_COLS} FROM s1_ins"))
def q_type6_inserts(spark, sf_dir):
    dim0, b1 = _t6_inputs(spark, sf_dir)
    return type6_inserts(type6_classify(b1, dim0.filter("Active_Flag = 1")), run_date=fx.RUN2)


@register("type6_expire", sql.with_(
    sql.t6_base_ctes(), "SELECT DISTINCT x_key AS Emp_Key FROM s1_ins WHERE x_key IS NOT NULL"))
def q_type6_expire(spark, sf_dir):
    dim0, b1 = _t6_inputs(spark, sf_dir)
    return type6_expire(type6_classify(b1, dim0.filter("Active_Flag = 1")))


@register("type6_apply", sql.with_(sql.t6_base_ctes(), "SELECT * FROM s1_next"))
def q_type6_apply(spark, sf_dir):
    dim0, b1 = _t6_inputs(spark, sf_dir)
    return type6_apply(dim0, b1, run_date=fx.RUN2)


@register("type6_apply_streamed", sql.with_(sql.t6_base_ctes(), "SELECT * FROM s1_next"))
def q_type6_apply_streamed(spark, sf_dir):
    """The path for a counted small batch on a large dimension: the active rows aren't shuffled."""
    dim0, b1 = _t6_inputs(spark, sf_dir)
    return type6_apply(dim0, b1, Type6Spec(large_active_bytes=0), fx.RUN2)


def _t6_two_batches(spark, sf_dir):
    """Two published batches: each is applied to the dimension read back from the
    previous publish (as a scheduled load would), and the result is read back."""
    dim0, b1 = _t6_inputs(spark, sf_dir, window=fx.BATCH1)
    base = scratch_path(spark, "type6_dim")
    start = current_max_key(dim0, "Emp_Key")
    ch1 = type6_changes(dim0, b1, run_date=fx.RUN1, start_after=start)
    p1 = publish_dimension(spark, ch1, base, 1, "ID", "Emp_Key", start, include_history=True)
    b2 = fx.type6_batch(spark, sf_dir, fx.BATCH2)
    ch2 = type6_changes(read_dimension(spark, base, 1), b2, run_date=fx.RUN2,
                        start_after=p1["max_key"], active=read_active(spark, base, 1),
                        history=read_history(spark, base, 1))
    publish_dimension(spark, ch2, base, 2, "ID", "Emp_Key", p1["max_key"])
    return read_dimension(spark, base)


@register("type6_two_batches", sql.with_(sql.t6_two_batch_ctes(), "SELECT * FROM s2_next"))
def q_type6_two_batches(spark, sf_dir):
    return _t6_two_batches(spark, sf_dir)


@register("run_summary", sql.with_(
    sql.t6_base_ctes(),
    "SELECT (SELECT COUNT(*) FROM s1_ins) AS rows_inserted, "
    "(SELECT COUNT(DISTINCT x_key) FROM s1_ins) AS rows_expired, "
    "(SELECT COUNT(*) FROM s1_next WHERE Active_Flag = 1) AS rows_active"))
def q_run_summary(spark, sf_dir):
    """Counts observed while the batch's changes are written (no recount)."""
    dim0, b1 = _t6_inputs(spark, sf_dir)
    start_after = current_max_key(dim0, "Emp_Key")
    ch = type6_changes(dim0, b1, run_date=fx.RUN2, start_after=start_after)
    base = scratch_path(spark, "run_summary")
    exp = write_observed(ch.expired, f"{base}/expired", mode="overwrite", name="expired")
    act = write_observed(ch.active, f"{base}/active", mode="overwrite", name="active",
                         metrics={"inserted": F.count_if(F.col("Emp_Key") > F.lit(start_after))})
    return spark.createDataFrame([(int(act["inserted"]), int(exp["rows"]), int(act["rows"]))],
                                 "rows_inserted bigint, rows_expired bigint, rows_active bigint")


# --- versioned dimension (C5-C7) -------------------------------------------------------

def _v_inputs(spark, sf_dir):
    dim0 = fx.versioned_dim0(spark, sf_dir)
    return dim0, fx.versioned_batch(spark, sf_dir, dim0)


@register("versioned_classify", sql.with_(sql.v_ctes(), "SELECT * FROM v_cls"))
def q_versioned_classify(spark, sf_dir):
    dim0, b = _v_inputs(spark, sf_dir)
    return versioned_classify(b, dim0.filter("Active_Flag = 1"))


@register("versioned_inserts", sql.with_(sql.v_ctes(), f"SELECT {sql.V_COLS} FROM v_ins"))
def q_versioned_inserts(spark, sf_dir):
    dim0, b = _v_inputs(spark, sf_dir)
    return versioned_inserts(versioned_classify(b, dim0.filter("Active_Flag = 1")))


@register("versioned_expire", sql.with_(
    sql.v_ctes(), "SELECT DISTINCT x_key AS Emp_Key FROM v_ins WHERE x_key IS NOT NULL"))
def q_versioned_expire(spark, sf_dir):
    dim0, b = _v_inputs(spark, sf_dir)
    return versioned_expire(versioned_classify(b, dim0.filter("Active_Flag = 1")))


@register("versioned_apply", sql.with_(sql.v_ctes(), "SELECT * FROM v_next"))
def q_versioned_apply(spark, sf_dir):
    dim0, b = _v_inputs(spark, sf_dir)
    return versioned_apply(dim0, b)


# --- keys / previous version (W1, A3, W2) ---------------------------------------------

@register("surrogate_keys",
          "SELECT CAST((SELECT COALESCE(MAX(s_suppkey), 0) FROM supplier) + row_number() OVER "
          "(ORDER BY c_custkey) AS BIGINT) AS Emp_Key, c_custkey, c_name FROM customer")
def q_surrogate_keys(spark, sf_dir):
    start = current_max_key(fx.table(spark, sf_dir, "supplier"), "s_suppkey")
    cust = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return assign_surrogate_keys(cust, "Emp_Key", ["c_custkey"], start)


@register("surrogate_keys_many_parts",
          "SELECT CAST(row_number() OVER (ORDER BY c_nationkey, c_custkey) AS BIGINT) AS Emp_Key, c_nationkey, "
          "c_custkey FROM customer")
def q_surrogate_keys_many_parts(spark, sf_dir):
    """Far more partitions than rows in some of them: the same keys."""
    cust = fx.table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey")
    return assign_surrogate_keys(cust, "Emp_Key", ["c_nationkey", "c_custkey"], num_partitions=1500)


_PREV_SQL = ("SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, "
             "LAG(o_orderpriority) OVER w AS prev_o_orderpriority, "
             "LAG(o_orderstatus) OVER w AS prev_o_orderstatus FROM orders "
             "WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")


def _prev(spark, sf_dir, **options):
    o = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    prev = previous_values(o, "o_custkey", ["o_orderdate", "o_orderkey"],
                           ["o_orderpriority", "o_orderstatus"], **options)
    return prev.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"),
                       "prev_o_orderpriority", "prev_o_orderstatus")


@register("prev_version", _PREV_SQL)
def q_prev_version(spark, sf_dir):
    return _prev(spark, sf_dir)


@register("prev_version_heavy", _PREV_SQL)
def q_prev_version_heavy(spark, sf_dir):
    """Customers with over ten orders take the path for heavy keys."""
    return _prev(spark, sf_dir, heavy_rows=10)


# --- data-quality checks (V1-V3) and run-log listing (V4) -------------------------------

def _products_checked(spark, sf_dir) -> DataFrame:
    p = product_rows(spark, sf_dir)
    base = p.select("id", F.when(F.col("id") % 97 == 0, F.lit(None).cast("string"))
                    .otherwise(F.col("title")).alias("title"), "price",
                    F.when(F.col("id") % 89 == 0, F.lit(101.0)).otherwise(F.col("discountPercentage"))
                    .alias("discountPercentage"), "stock", "brand", "category", "rating")
    return base.unionByName(base.filter(F.col("id") % 83 == 0))


def _t6_checked(spark, sf_dir) -> DataFrame:
    d = _t6_two_batches(spark, sf_dir)
    f, i = F.col("Active_Flag"), F.col("ID")
    base = d.select(
        "Emp_Key", "ID", "Name", "CURRENTCity",
        F.when((f == 1) & (i % 67 == 0) & F.col("HESTORICALCity").isNotNull(), F.lit("X"))
        .otherwise(F.col("HESTORICALCity")).alias("HESTORICALCity"),
        "CURRENTEmail", "HESTORICALEmail", "STARTDate",
        F.when((f == 1) & (i % 59 == 0), F.lit(fx.RUN2).cast("date"))
        .when((f == 0) & (i % 61 == 0), F.lit(None).cast("date"))
        .otherwise(F.col("ENDDate")).alias("ENDDate"),
        "Active_Flag")
    extra = base.filter((f == 1) & (i % 53 == 0)).withColumn("Emp_Key", F.col("Emp_Key") + 10_000_000)
    return base.unionByName(extra).unionByName(base.filter((f == 0) & (i % 71 == 0)))


def _v_published(spark, sf_dir) -> DataFrame:
    """The versioned batch applied and published, read back for the checks."""
    dim0, b = _v_inputs(spark, sf_dir)
    base = scratch_path(spark, "versioned_dim")
    start = current_max_key(dim0, "Emp_Key")
    publish_dimension(spark, versioned_changes(dim0, b, start_after=start), base, 1, "ID",
                      "Emp_Key", start, include_history=True)
    return read_dimension(spark, base)


def _v_checked(spark, sf_dir) -> DataFrame:
    d = _v_published(spark, sf_dir)
    f, i = F.col("Active_Flag"), F.col("ID")
    base = d.withColumn("Version_No", F.when(i % 43 == 0, F.lit(0)).otherwise(F.col("Version_No")))
    extra = base.filter((f == 1) & (i % 53 == 0)).withColumn("Emp_Key", F.col("Emp_Key") + 10_000_000)
    return base.unionByName(extra).unionByName(base.filter((f == 0) & (i % 71 == 0)))


_T6_CHECKED = sql.t6_two_batch_ctes() + sql.t6_injected("s2_next")
_V_CHECKED = sql.v_ctes() + sql.v_injected("v_next")


def _dup_sql(rel: str, key: str, name: str, where: str = "TRUE") -> str:
    return (f"SELECT '{name}' AS check_name, COUNT(*) AS violations FROM (SELECT {key} FROM {rel} "
            f"WHERE {where} GROUP BY {key} HAVING COUNT(*) > 1)")


@register("check_q1_rowcount",
          f"SELECT 'Q1_rowcount' AS check_name, COUNT(*) AS actual, (SELECT CAST(SUM(n) AS BIGINT) FROM "
          f"(SELECT COUNT(*) AS n FROM part GROUP BY p_partkey // {fx.PART_PAGE})) AS expected FROM part")
def q_check_q1_rowcount(spark, sf_dir):
    """Loaded rows against the totals that the documents themselves give."""
    docs = fx.product_documents(spark, sf_dir)
    told = docs.agg(F.sum(F.get_json_object("doc", "$.total").cast("bigint"))).first()[0]
    return checks.q1_rowcount(product_rows(spark, sf_dir), int(told or 0))


@register("check_q1_null_keys", sql.with_(
    sql.PRODUCTS_CHECKED,
    "SELECT 'Q1_null_keys' AS check_name, COUNT(*) AS violations FROM prod_checked "
    "WHERE id IS NULL OR title IS NULL"))
def q_check_q1_null_keys(spark, sf_dir):
    return checks.q1_null_keys(_products_checked(spark, sf_dir))


@register("check_q1_domain", sql.with_(
    sql.PRODUCTS_CHECKED,
    "SELECT 'Q1_domain' AS check_name, COUNT(*) AS violations FROM prod_checked WHERE "
    "discountPercentage < 0 OR discountPercentage > 100 OR rating < 0 OR rating > 5 OR stock < 0"))
def q_check_q1_domain(spark, sf_dir):
    return checks.q1_domain(_products_checked(spark, sf_dir))


@register("check_q1_dupes", sql.with_(sql.PRODUCTS_CHECKED, _dup_sql("prod_checked", "id", "Q1_dupes")))
def q_check_q1_dupes(spark, sf_dir):
    return checks.q1_dupes(_products_checked(spark, sf_dir))


@register("check_q2_one_active_per_id", sql.with_(
    _T6_CHECKED, _dup_sql("t6_checked", "ID", "Q2_one_active_per_id", "Active_Flag = 1")))
def q_check_q2_one_active(spark, sf_dir):
    return checks.q2_one_active_per_id(_t6_checked(spark, sf_dir))


@register("check_q2_dating", sql.with_(
    _T6_CHECKED,
    "SELECT 'Q2_dating' AS check_name, COUNT(*) AS violations FROM t6_checked WHERE "
    "(Active_Flag = 1 AND ENDDate IS NOT NULL) OR (Active_Flag = 0 AND ENDDate IS NULL)"))
def q_check_q2_dating(spark, sf_dir):
    return checks.q2_dating(_t6_checked(spark, sf_dir))


@register("check_q2_type6_history", sql.with_(
    _T6_CHECKED + [("ranked", "SELECT *, LAG(CURRENTCity) OVER (PARTITION BY ID ORDER BY STARTDate, "
                              "Emp_Key) AS prev_city FROM t6_checked")],
    "SELECT 'Q2_type6_history' AS check_name, COUNT(*) AS violations FROM ranked WHERE "
    "prev_city IS NOT NULL AND CURRENTCity <> prev_city AND HESTORICALCity <> prev_city"))
def q_check_q2_history(spark, sf_dir):
    return checks.q2_type6_history(_t6_checked(spark, sf_dir))


@register("check_q2_emp_key_unique", sql.with_(
    _T6_CHECKED, _dup_sql("t6_checked", "Emp_Key", "Q2_emp_key_unique")))
def q_check_q2_key_unique(spark, sf_dir):
    return checks.q2_emp_key_unique(_t6_checked(spark, sf_dir))


@register("check_q3_one_active_per_id", sql.with_(
    _V_CHECKED, _dup_sql("v_checked", "ID", "Q3_one_active_per_id", "Active_Flag = 1")))
def q_check_q3_one_active(spark, sf_dir):
    return checks.q3_one_active_per_id(_v_checked(spark, sf_dir))


@register("check_q3_version_positive", sql.with_(
    _V_CHECKED, "SELECT 'Q3_version_positive' AS check_name, COUNT(*) AS violations "
                "FROM v_checked WHERE Version_No < 1"))
def q_check_q3_version(spark, sf_dir):
    return checks.q3_version_positive(_v_checked(spark, sf_dir))


@register("check_q3_emp_key_unique", sql.with_(
    _V_CHECKED, _dup_sql("v_checked", "Emp_Key", "Q3_emp_key_unique")))
def q_check_q3_key_unique(spark, sf_dir):
    return checks.q3_emp_key_unique(_v_checked(spark, sf_dir))


@register("topk_audit",
          "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS ts_date FROM events "
          "ORDER BY ts DESC, event_id DESC LIMIT 50")
def q_topk_audit(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    top = checks.latest_entries(ev, 50, ts="ts", tie="event_id")
    return top.select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("ts_date"))


# --- documents (S1-S10, S18-S21, F9, F11) ----------------------------------------------------

CONV_SPEC = DocumentSpec(schema=fx.CONV_SCHEMA, array_path="turns")
_TURNS_SQL = "SELECT turn, role, text FROM conversations"


@register("json_array_path", _TURNS_SQL)
def q_json_array_path(spark, sf_dir):
    return parse_documents(fx.conversation_documents(spark, sf_dir), "doc", CONV_SPEC)


@register("json_parent_columns",
          f"SELECT conv_id AS P_conv_id, COUNT(*) OVER (PARTITION BY conv_id, turn // {fx.CONV_PAGE}) "
          f"AS P_n_turns, turn, role, text FROM conversations")
def q_json_parent_columns(spark, sf_dir):
    spec = DocumentSpec(schema=fx.CONV_SCHEMA, array_path="turns", parents=("conv_id", "n_turns"))
    return parse_documents(fx.conversation_documents(spark, sf_dir), "doc", spec)


@register("json_max_rows", f"SELECT * FROM ({sql.PRODUCTS}) ORDER BY id LIMIT 25")
def q_json_max_rows(spark, sf_dir):
    spec = DocumentSpec(schema=fx.PRODUCT_SCHEMA, array_path="products", parents=("page",),
                        keep_position=True)
    rows = parse_documents(fx.product_documents(spark, sf_dir), "doc", spec)
    first = first_rows(rows, 25, ["P_page", "pos"])
    return transform_products(first)


@register("json_nested_as_string",
          f"SELECT conv_id, turn // {fx.CONV_PAGE} AS page, COUNT(*) AS n_turns, "
          f"CAST(COUNT(*) AS INTEGER) AS n_items, arg_min(role, turn) AS first_role, "
          f"md5(string_agg(turn || '|' || role || '|' || text, chr(10) ORDER BY turn, role, text)) AS all_turns "
          f"FROM conversations GROUP BY conv_id, turn // {fx.CONV_PAGE}")
def q_json_nested_as_string(spark, sf_dir):
    """The kept text, parsed again, holds every turn whole."""
    docs = fx.conversation_documents(spark, sf_dir)
    parsed = docs.select(F.from_json("doc", fx.CONV_SCHEMA).alias("d")).select("d.*")
    kept = nested_as_string(parsed, ["turns"])
    again = F.from_json("turns", "array<struct<turn: bigint, role: string, text: string>>")
    lines = F.transform(again, lambda t: F.concat_ws("|", t["turn"].cast("string"), t["role"], t["text"]))
    return kept.select("conv_id", "page", "n_turns",
                       F.json_array_length("turns").alias("n_items"),
                       F.get_json_object("turns", "$[0].role").alias("first_role"),
                       F.md5(F.array_join(lines, "\n").cast("binary")).alias("all_turns"))


@register("json_unpivot",
          " UNION ALL ".join(f"SELECT id, '{c}' AS Pivot_Name, CAST({c} AS DOUBLE) AS Pivot_Value "
                             f"FROM ({sql.PRODUCTS})" for c in
                             ("price", "discountPercentage", "stock", "rating")))
def q_json_unpivot(spark, sf_dir):
    return to_name_value(product_rows(spark, sf_dir), ["id"],
                         ["price", "discountPercentage", "stock", "rating"])


@register("json_2d_rows",
          "SELECT CAST(vec_id AS DOUBLE) AS vec_id, CAST(label AS DOUBLE) AS label, p.i AS place, "
          "CAST(embedding[p.i + 1] AS DOUBLE) AS x FROM embeddings, unnest(range(len(embedding))) AS p(i)")
def q_json_2d_rows(spark, sf_dir):
    """All values of every row; the width comes from the data's own arrays."""
    width = fx.embedding_width(spark, sf_dir)
    docs = fx.embedding_documents(spark, sf_dir, width)
    parsed = docs.select(F.from_json("doc", fx.EMB_SCHEMA).alias("d")).select("d.*")
    wide = rows_from_2d(parsed, "names", "rows", fx.embedding_columns(width))
    values = F.array(*[F.col(f"e{i}") for i in range(width)])
    return (wide.select("vec_id", "label", F.posexplode(values).alias("place", "x"))
            .where("x is not null").withColumn("place", F.col("place").cast("bigint")))


def _landed_conversations(spark, sf_dir) -> str:
    path = scratch_path(spark, "conversation_docs")
    return land_documents(fx.conversation_documents(spark, sf_dir), path)


@register("json_raw_document",
          f"SELECT conv_id, turn // {fx.CONV_PAGE} AS page, CAST(COUNT(*) AS INTEGER) AS n_items "
          f"FROM conversations GROUP BY conv_id, turn // {fx.CONV_PAGE}")
def q_json_raw_document(spark, sf_dir):
    raw = read_raw_documents(spark, _landed_conversations(spark, sf_dir))
    return raw.select(F.get_json_object("value", "$.conv_id").cast("bigint").alias("conv_id"),
                      F.get_json_object("value", "$.page").cast("bigint").alias("page"),
                      F.json_array_length(F.get_json_object("value", "$.turns")).alias("n_items"))


@register("json_replace",
          "SELECT turn, CASE WHEN role = 'assistant' THEN 'bot' ELSE role END AS role, text "
          "FROM conversations")
def q_json_replace(spark, sf_dir):
    docs = replace_in_text(fx.conversation_documents(spark, sf_dir), "doc",
                           '"role":"assistant"', '"role":"bot"', regex=False)
    return parse_documents(docs, "doc", CONV_SPEC)


@register("json_file_name",
          "SELECT COUNT(*) AS n_rows, COUNT(*) AS n_named, true AS several_files FROM conversations")
def q_json_file_name(spark, sf_dir):
    """Every row carries the name of the file it came from (the names themselves SQL cannot know)."""
    docs = fx.conversation_documents(spark, sf_dir).repartition(3, "conv_id")
    path = land_documents(docs, scratch_path(spark, "conversation_docs"))
    rows = read_documents(spark, path, CONV_SPEC, file_name=True)
    name = F.col("__FileName")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(name.rlike("^part-.+")).alias("n_named"),
                    (F.count_distinct(name) > 1).alias("several_files"))


@register("json_many_paths", _TURNS_SQL)
def q_json_many_paths(spark, sf_dir):
    """A list of paths, one a glob over compressed files in a deeper folder, read as one set."""
    docs = fx.conversation_documents(spark, sf_dir)
    root, odd = scratch_path(spark, "many"), F.col("conv_id") % 2 == 1
    land_documents(docs.filter(odd), f"{root}/odd")
    land_documents(docs.filter(~F.coalesce(odd, F.lit(False))), f"{root}/deep/even", compression="gzip")
    return read_documents(spark, [f"{root}/odd", f"{root}/*/even"], CONV_SPEC)


@register("json_skip_missing", _TURNS_SQL)
def q_json_skip_missing(spark, sf_dir):
    """A path that doesn't exist is skipped."""
    path = _landed_conversations(spark, sf_dir)
    return read_documents(spark, [path, f"{path}-not-there"], CONV_SPEC, ignore_missing=True)


@register("json_skip_bad", "SELECT turn, role, text FROM conversations WHERE conv_id % 5 <> 0 OR conv_id IS NULL")
def q_json_skip_bad(spark, sf_dir):
    """Documents cut in half are skipped, the others read (S9, PERMISSIVE)."""
    docs = fx.conversation_documents(spark, sf_dir)
    half = F.expr("substring(doc, 1, cast(length(doc) / 2 as int))")
    broken = docs.withColumn("doc", F.when(F.col("conv_id") % 5 == 0, half).otherwise(F.col("doc")))
    spec = DocumentSpec(schema=f"{fx.CONV_SCHEMA}, _corrupt_record string", array_path="turns", parents=("_corrupt_record",))
    path = land_documents(broken, scratch_path(spark, "broken"))
    rows = read_documents(spark, path, spec, mode="PERMISSIVE")
    return rows.where("P__corrupt_record is null").drop("P__corrupt_record")


@register("json_paged", f"SELECT id, CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS place FROM ({sql.PRODUCTS})")
def q_json_paged(spark, sf_dir):
    """Pages in any number of files, brought into the order that their own ``skip`` gives."""
    docs = fx.product_documents(spark, sf_dir).repartition(5)
    path = land_documents(docs, scratch_path(spark, "paged"))
    spec = DocumentSpec(schema=fx.PRODUCT_SCHEMA, array_path="products", parents=("skip",), keep_position=True)
    rows = read_documents(spark, path, spec).select("id", "P_skip", "pos")
    return assign_surrogate_keys(rows, "place", ["P_skip", "pos"]).select("id", "place")


@register("json_read_options", _TURNS_SQL)
def q_json_read_options(spark, sf_dir):
    """Reader options: single-quoted documents with a comment."""
    docs = fx.conversation_documents(spark, sf_dir)
    noted = docs.withColumn("doc", F.concat(F.lit("/* page */ "), F.regexp_replace("doc", '"conv_id":', "'conv_id':")))
    path = land_documents(noted, scratch_path(spark, "noted"))
    return read_documents(spark, path, CONV_SPEC, options={"allowComments": "true", "allowSingleQuotes": "true"})


@register("json_file_scan", _TURNS_SQL)
def q_json_file_scan(spark, sf_dir):
    """Landed JSON Lines documents read back from files and exploded."""
    return read_documents(spark, _landed_conversations(spark, sf_dir), CONV_SPEC)


@register("json_column_parse",
          "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def q_json_column_parse(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select("event_id", "props")
    return parse_column(ev, "props", "k int").select("event_id", "k")


@register("blank_as_null",
          "SELECT p_partkey AS id, CASE WHEN p_size % 7 = 0 OR p_size % 11 = 0 THEN NULL "
          "ELSE p_retailprice END AS price FROM part")
def q_blank_as_null(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    text = (F.when(F.col("p_size") % 7 == 0, F.lit(""))
            .when(F.col("p_size") % 11 == 0, F.lit("   "))
            .otherwise(F.col("p_retailprice").cast("string")))
    return p.select(F.col("p_partkey").alias("id"), blank_as_null(text, "double").alias("price"))


@register("product_load", sql.PRODUCTS)
def q_product_load(spark, sf_dir):
    return product_rows(spark, sf_dir)


_BAD_PROPS_SQL = ("SELECT event_id, CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 13 = 0 THEN rtrim(props, '}') "
                  "WHEN event_id % 17 = 0 THEN '{\"k\": \"x\"}' ELSE props END AS props FROM events")


@register("rejects",
          f"SELECT event_id, CASE WHEN ok THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k, "
          f"NOT ok AS rejected, CASE WHEN NOT ok THEN 'props' END AS ErrorColumnName, "
          f"CASE WHEN NOT ok THEN props END AS ErrorText FROM "
          f"(SELECT *, CASE WHEN json_valid(props) THEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') "
          f"ELSE false END AS ok "
          f"FROM ({_BAD_PROPS_SQL}))")
def q_rejects(spark, sf_dir):
    """Good and rejected rows from one parse; missing, cut and mistyped documents are rejected."""
    ev = fx.table(spark, sf_dir, "events")
    eid = F.col("event_id")
    props = (F.when(eid % 19 == 0, F.lit(None)).when(eid % 13 == 0, F.rtrim(F.col("props"), F.lit("}")))
             .when(eid % 17 == 0, F.lit('{"k": "x"}')).otherwise(F.col("props")))
    parsed = parse_status(ev.select("event_id", props.alias("props")), "props", "k int", keep=["event_id"])
    return parsed.select("event_id", "k", "rejected", "ErrorColumnName", "ErrorText")


@register("constraint_rejects",
          f"SELECT id, title, CASE WHEN id % 97 <> 0 AND length(title) <= 20 THEN 'good' ELSE 'rejected' END AS status, "
          f"CASE WHEN id % 97 <> 0 AND length(title) <= 20 THEN NULL ELSE 'title' END AS ErrorColumnName "
          f"FROM ({sql.PRODUCTS})")
def q_constraint_rejects(spark, sf_dir):
    """NOT NULL and VARCHAR(n) as a gate that sets broken rows aside."""
    p = product_rows(spark, sf_dir).select("id", "title")
    valid = (F.col("id") % 97 != 0) & max_length("title", 20)
    good, bad = split_rejects(p, valid, "title")
    return (good.select("id", "title", F.lit("good").alias("status"), F.lit(None).cast("string").alias("ErrorColumnName"))
            .unionByName(bad.select("id", "title", F.lit("rejected").alias("status"), "ErrorColumnName")))


@register("conform_defaults",
          "SELECT p_partkey AS id, coalesce(CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand END, 'none') AS brand, "
          "CAST(p_size AS BIGINT) AS stock, CAST(0 AS DOUBLE) AS rating, CAST(NULL AS VARCHAR) AS note FROM part")
def q_conform_defaults(spark, sf_dir):
    """Keep-nulls off: null or missing columns get the target's default, others stay null (K9)."""
    p = fx.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 7 != 0, F.col("p_brand")).alias("brand"),
        F.col("p_size").alias("stock"))
    return conform(p, "id bigint, brand string, stock bigint, rating double, note string",
                   {"brand": "none", "rating": 0.0})


@register("table_scan", "SELECT c_custkey, c_name, 'missing' AS other FROM customer")
def q_table_scan(spark, sf_dir):
    """A table by path, one made if missing and read by name, and a typed empty one."""
    rows = read_table(spark, f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    name = f"scan_{uuid.uuid4().hex[:12]}"
    for _ in range(2):  # the second time it is there
        create_table_if_missing(spark, name, "c_custkey BIGINT, c_name STRING", scratch_path(spark, "scan"))
    rows.write.insertInto(name)
    none = read_or_empty(spark, f"{name}_absent", PRODUCT_DDL).select("id")
    state = "missing" if none.isEmpty() else "there"
    return read_table(spark, name).withColumn("other", F.lit(state))


@register("append_load", f"SELECT * FROM ({sql.PRODUCTS}) UNION ALL SELECT * FROM ({sql.PRODUCTS})")
def q_append_load(spark, sf_dir):
    path = scratch_path(spark, "append_load")
    rows = product_rows(spark, sf_dir)
    append_load(rows, path)
    append_load(rows, path)
    return spark.read.parquet(path)


@register("truncate_reload", sql.PRODUCTS)
def q_truncate_reload(spark, sf_dir):
    path = scratch_path(spark, "truncate_reload")
    rows = product_rows(spark, sf_dir)
    append_load(rows, path)
    truncate_reload(rows, path)
    return spark.read.parquet(path)


# --- the loads end to end with their run log (G1-G3, C8, C9, K5) ---------------------

_WM_SQL = "(SELECT COALESCE(MAX(STARTDate), DATE '1900-01-01') FROM dim0 WHERE Active_Flag = 1)"
_JOB_CTES = [("dim0", sql.T6_DIM0),
             ("jb", sql.job_batch(f"d > {_WM_SQL}", "Update_Date"))] + \
    sql.t6_step("j", "dim0", "jb", fx.RUN2)
_JOB_SPEC = Type6Spec(batch_dedup="latest", dedup_order=("o_orderkey",))


def _type6_job(spark, sf_dir, **options):
    base = scratch_path(spark, "type6_job")
    seed_dimension(spark, fx.type6_dim0(spark, sf_dir), base, bucket_by=options.get("bucket_by"))
    log = scratch_path(spark, "log")
    run_type6_load(spark, fx.named_source(spark, sf_dir), base, fx.RUN2, _JOB_SPEC,
                   **{"mode": "incremental", "timestamp_col": "o_orderdate", "log_to": log, **options})
    return base, log


def _stored_log(spark, log):
    return spark.read.parquet(log).select("package", "step", "status", "row_count")


def _log_sql(package: str, counts: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{package}' AS package, '{step}' AS step, 'SUCCEEDED' AS status, "
                              f"CAST(({n}) AS BIGINT) AS row_count" for step, n in counts)


def _job_log_sql(package: str, source: str, active: str, ins: str) -> str:
    inserted, expired = f"SELECT COUNT(*) FROM {ins}", f"SELECT COUNT(DISTINCT x_key) FROM {ins}"
    return _log_sql(package, [
        ("compute_watermark", "0"), ("extract_source", f"SELECT COUNT(*) FROM {source}"),
        ("read_active_dim", f"SELECT COUNT(*) FROM {active} WHERE Active_Flag = 1"),
        ("transform_type6", f"SELECT ({inserted}) + ({expired})"), ("expire_old_rows", expired),
        ("insert_new_versions", inserted)])


@register("type6_job_runlog", sql.with_(
    _JOB_CTES + [("src", f"SELECT * FROM ({sql.NAMED_SOURCE}) WHERE d > {_WM_SQL}")], _job_log_sql("Q2", "src", "dim0", "j_ins")))
def q_type6_job_runlog(spark, sf_dir):
    """The type-6 job's stored run log: one row per step, counts from observations."""
    return _stored_log(spark, _type6_job(spark, sf_dir)[1])


_STEP_ORDER = ["compute_watermark", "extract_source", "read_active_dim", "transform_type6", "expire_old_rows",
               "insert_new_versions"]


@register("type6_job_step_times", sql.with_(
    _JOB_CTES + [("src", f"SELECT * FROM ({sql.NAMED_SOURCE}) WHERE d > {_WM_SQL}"),
                 ("steps", _job_log_sql("Q2", "src", "dim0", "j_ins"))],
    "SELECT package, step, row_count, CASE step "
    + " ".join(f"WHEN '{step}' THEN {place}" for place, step in enumerate(_STEP_ORDER, 1))
    + " END AS place, true AS ended_after_start, true AS after_the_step_before FROM steps"))
def q_type6_job_step_times(spark, sf_dir):
    """The stored times of a job's steps: each ends after it started and starts after the step before it ended."""
    log = spark.read.parquet(_type6_job(spark, sf_dir)[1])
    in_time = Window.partitionBy("run_id").orderBy("started_at", "ended_at")
    before = F.lag("ended_at").over(in_time)
    return log.select("package", "step", "row_count", F.row_number().over(in_time).alias("place"),
                      (F.col("ended_at") >= F.col("started_at")).alias("ended_after_start"),
                      (before.isNull() | (F.col("started_at") >= before)).alias("after_the_step_before"))


@register("type6_job_dimension", sql.with_(_JOB_CTES, "SELECT * FROM j_next"))
def q_type6_job_dimension(spark, sf_dir):
    """Seeded dimension + one incremental job run, read back from the publish."""
    return read_dimension(spark, _type6_job(spark, sf_dir)[0])


@register("type6_job_bucketed_dimension", sql.with_(_JOB_CTES, "SELECT * FROM j_next"))
def q_type6_job_bucketed(spark, sf_dir):
    """The same job with the active rows published bucketed on the natural key."""
    return read_dimension(spark, _type6_job(spark, sf_dir, bucket_by=8)[0])


@register("type6_job_source_watermark", sql.with_(
    [("dim0", sql.T6_DIM0), ("jb", sql.job_batch("TRUE", "Update_Date"))]
    + sql.t6_step("j", "dim0", "jb", fx.RUN2), "SELECT * FROM j_next"))
def q_type6_job_source_watermark(spark, sf_dir):
    """Watermark kept from source dates: a seeded dimension has none yet, so the first run reads everything."""
    base = scratch_path(spark, "type6_job_srcwm")
    seed_dimension(spark, fx.type6_dim0(spark, sf_dir), base)
    run_type6_load(spark, fx.named_source(spark, sf_dir), base, fx.RUN2, _JOB_SPEC, watermark_from="source")
    return read_dimension(spark, base)


_FIRST_CTES = [("none0", f"SELECT * FROM ({sql.T6_DIM0}) WHERE Emp_Key < 0"),
               ("fb", sql.job_batch("TRUE", "Update_Date"))] + sql.t6_step("f", "none0", "fb", fx.RUN2)


@register("type6_first_load", sql.with_(
    _FIRST_CTES, "SELECT f_next.* EXCLUDE (STARTDate), STARTDate, false AS starts_today FROM f_next"))
def q_type6_first_load(spark, sf_dir):
    """No dimension yet: the load starts from a typed empty one, and its run date is today."""
    base = scratch_path(spark, "type6_first")
    run_type6_load(spark, fx.named_source(spark, sf_dir), base, None, _JOB_SPEC)
    return read_dimension(spark, base).withColumn("starts_today", F.col("STARTDate") == F.current_date())


_STREAM_CTES = sql.t6_two_batch_ctes()


@register("type6_stream_dimension", sql.with_(_STREAM_CTES, "SELECT * FROM s2_next"))
def q_type6_stream_dimension(spark, sf_dir):
    """A live stream on a seeded dimension: a batch, an empty micro-batch, the other batch."""
    base, landed = scratch_path(spark, "type6_stream"), scratch_path(spark, "stream_in")
    seed_dimension(spark, fx.type6_dim0(spark, sf_dir), base)
    one, two = (fx.type6_batch(spark, sf_dir, w) for w in (fx.BATCH1, fx.BATCH2))
    for rows in (one, one.limit(0), two):
        rows.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(one.schema).parquet(landed)
        start_scd_stream(stream, base, Type6Spec(), T6_EMPTY, f"{landed}-checkpoint",
                         run_date_of=_stream_run_date).awaitTermination()
    return read_dimension(spark, base)


def _stream_run_date(batch):
    last = batch.agg(F.max("Update_Date")).first()[0]
    return fx.RUN1 if last < fx.RUN1 else fx.RUN2


def _versioned_job(spark, sf_dir, mode: str):
    base, log = scratch_path(spark, "versioned_job"), scratch_path(spark, "log")
    seed_dimension(spark, fx.versioned_dim0(spark, sf_dir), base)
    run_versioned_load(spark, fx.named_source(spark, sf_dir, "Schedule_Date"), base,
                       VersionedSpec(batch_dedup="latest", dedup_order=("o_orderkey",)),
                       mode=mode, timestamp_col="o_orderdate", log_to=log)
    return base, log


_VJOB_CTES = [("vdim0", sql.V_DIM0), ("vj", sql.job_batch("TRUE", "Schedule_Date"))] + \
    sql.v_step("vjob", "vdim0", "vj")
_VWM_SQL = "(SELECT MAX(Schedule_Date) FROM vdim0 WHERE Active_Flag = 1)"


@register("versioned_job_dimension", sql.with_(_VJOB_CTES, "SELECT * FROM vjob_next"))
def q_versioned_job_dimension(spark, sf_dir):
    """Versioned job in full-extraction mode over the whole source."""
    return read_dimension(spark, _versioned_job(spark, sf_dir, "full")[0])


@register("versioned_job_runlog", sql.with_(
    _VJOB_CTES + [("src", sql.NAMED_SOURCE)], _job_log_sql("Q3", "src", "vdim0", "vjob_ins")))
def q_versioned_job_runlog(spark, sf_dir):
    return _stored_log(spark, _versioned_job(spark, sf_dir, "full")[1])


@register("versioned_job_incremental", sql.with_(
    [("vdim0", sql.V_DIM0), ("vj", sql.job_batch(f"d > {_VWM_SQL}", "Schedule_Date"))]
    + sql.v_step("vjob", "vdim0", "vj"), "SELECT * FROM vjob_next"))
def q_versioned_job_incremental(spark, sf_dir):
    """Versioned job over the rows after the watermark of Schedule_Date (A2)."""
    return read_dimension(spark, _versioned_job(spark, sf_dir, "incremental")[0])


def _product_job(spark, sf_dir, max_rows: int):
    docs = land_documents(fx.product_documents(spark, sf_dir), scratch_path(spark, "product_docs"))
    target, log = scratch_path(spark, "product_q1"), scratch_path(spark, "log")
    run_product_load(spark, docs, target, max_rows=max_rows, log_to=log)
    return target, log


@register("product_job", f"SELECT * FROM ({sql.PRODUCTS}) ORDER BY id LIMIT 25")
def q_product_job(spark, sf_dir):
    """Product documents landed as files, first 25 loaded (L1 end to end, S5)."""
    return spark.read.parquet(_product_job(spark, sf_dir, 25)[0])


@register("product_job_runlog", sql.with_([("p", sql.PRODUCTS)], _log_sql("Q1", [
    (step, "SELECT COUNT(*) FROM p") for step in ("extract_json", "transform", "load_product_q1")])))
def q_product_job_runlog(spark, sf_dir):
    """All products loaded; the stored run log."""
    return _stored_log(spark, _product_job(spark, sf_dir, 0)[1])


@register("failed_job_runlog",
          "SELECT 'Q1' AS package, step, CASE WHEN step = 'load_product_q1' AND n > 0 THEN 'FAILED' ELSE 'SUCCEEDED' END "
          "AS status, CAST(0 AS BIGINT) AS row_count FROM (SELECT COUNT(*) AS n FROM part), "
          "(VALUES ('extract_json'), ('transform'), ('load_product_q1')) AS s(step)")
def q_failed_job_runlog(spark, sf_dir):
    """A price above what the target takes fails the load; its log is stored all the same."""
    docs = land_documents(fx.product_documents(spark, sf_dir), scratch_path(spark, "product_docs"))
    log = scratch_path(spark, "log")
    try:
        run_product_load(spark, docs, scratch_path(spark, "product_q1"), constraints={"cheap": F.col("price") < 0},
                         log_to=log)
    except PySparkException as error:
        if "cheap" not in str(error):
            raise
    return _stored_log(spark, log)


@register("versioned_conventional_apply", sql.with_(
    [("vdim0", sql.V_DIM0), ("vb1", sql.v_batch("vdim0"))] + sql.v_step("vc", "vdim0", "vb1", "conventional"),
    "SELECT * FROM vc_next"))
def q_versioned_conventional(spark, sf_dir):
    """Conventional version rule: a changed date gives old + 1, the same date nothing."""
    dim0, b = _v_inputs(spark, sf_dir)
    return versioned_apply(dim0, b, VersionedSpec(version_rule="conventional"))


# --- late rows (C4, C8), keys and rules on load (K10, K12, A5) -----------------------------

_LATE_CTES = sql.t6_base_ctes() + sql.t6_late("l", "s1_next")


@register("type6_late_rows", sql.with_(_LATE_CTES, "SELECT * FROM l_next"))
def q_type6_late_rows(spark, sf_dir):
    """Every order dated before its customer's active version gets its place in the history."""
    dim0, b1 = _t6_inputs(spark, sf_dir)
    dim = materialize(type6_apply(dim0, b1, run_date=fx.RUN2), "dim")
    spec = Type6Spec(dedup_order=("o_orderkey",))
    late = split_late(fx.named_source(spark, sf_dir).drop("o_orderdate"), dim, spec)[1]
    return insert_late_rows(dim, late, spec)


def _keyed_customers(spark, sf_dir):
    """All customers in a folder by key part, with their sketch: path, parts, cells."""
    rows = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    n = rows.count()
    parts = max(part_count(n), 8)
    cells, path = sketch_cells(n, parts), scratch_path(spark, "keyed")
    append_keyed(rows, path, "c_custkey", parts, cells)
    return path, parts, cells


@register("constraint_primary_key",
          "WITH b AS (SELECT p_partkey AS c_custkey, p_name FROM part UNION ALL "
          "SELECT p_partkey, p_name FROM part WHERE p_partkey % 83 = 0), "
          "n AS (SELECT c_custkey, COUNT(*) AS n FROM b GROUP BY c_custkey) "
          "SELECT b.c_custkey, b.p_name, concat_ws(', ', CASE WHEN n.n > 1 THEN 'duplicate in batch' END, "
          "CASE WHEN b.c_custkey IN (SELECT c_custkey FROM customer) THEN 'in target' END) AS reasons "
          "FROM b JOIN n USING (c_custkey)")
def q_constraint_primary_key(spark, sf_dir):
    """Parts loaded under customer keys: rows whose key repeats in the batch or is in the target."""
    path, parts, cells = _keyed_customers(spark, sf_dir)
    rows = fx.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("c_custkey"), "p_name")
    batch = rows.unionAll(rows.filter("c_custkey % 83 = 0"))
    judged, _ = key_violations(batch, path, "c_custkey", parts, cells)
    return judged.select("c_custkey", "p_name", F.array_join("reasons", ", ").alias("reasons"))


@register("check_incremental_unique",
          "WITH t AS (SELECT c_custkey FROM customer UNION ALL SELECT n_nationkey FROM nation) "
          "SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) FILTER (n > 1) AS n_duplicate_keys "
          "FROM (SELECT c_custkey, COUNT(*) AS n FROM t GROUP BY c_custkey)")
def q_check_incremental_unique(spark, sf_dir):
    """Duplicate keys after a second batch (nation keys under customer keys), from the touched parts alone."""
    path, parts, cells = _keyed_customers(spark, sf_dir)
    state = materialize(check_state(spark, path, "c_custkey"), "check-state")
    second = fx.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("c_custkey"), F.col("n_name").alias("c_name"))
    touched = append_keyed(second, path, "c_custkey", parts, cells)
    return renewed_state(state, path, "c_custkey", touched).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_duplicate_keys").alias("n_duplicate_keys"))


@register("rejects_all_reasons", sql.with_(
    sql.PRODUCTS_CHECKED,
    "SELECT id, concat_ws(', ', CASE WHEN title IS NULL THEN 'title' END, "
    "CASE WHEN discountPercentage IS NULL OR discountPercentage NOT BETWEEN 0 AND 100 THEN 'discount' END, "
    "CASE WHEN stock IS NULL OR stock >= 40 THEN 'stock' END, "
    "CASE WHEN rating IS NULL OR rating > 3 THEN 'rating' END) AS reasons FROM prod_checked"))
def q_rejects_all_reasons(spark, sf_dir):
    """Good and rejected products written in one pass, each rejected one with every rule it breaks."""
    rules = {"title": F.col("title").isNotNull(), "discount": F.col("discountPercentage").between(0, 100),
             "stock": F.col("stock") < 40, "rating": F.col("rating") <= 3}
    good, bad = write_with_rejects(_products_checked(spark, sf_dir), rules, scratch_path(spark, "products-split"))
    return good.select("id", F.lit("").alias("reasons")).unionAll(
        bad.select("id", F.array_join("ErrorReasons", ", ").alias("reasons")))


# --- JSON as VARIANT (S2, S7, F9), aggregates from footers (A1, A3, A7) ----------------------

@register("json_variant_path",
          "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, "
          "CAST(json_extract(props, '$.nowhere') AS VARCHAR) AS missing FROM events")
def q_json_variant_path(spark, sf_dir):
    ev = with_variant(fx.table(spark, sf_dir, "events").select("event_id", "props"), "props", "v")
    return variant_fields(ev, "v", {"k": ("$.k", "int"), "missing": ("$.nowhere", "string")}, ["event_id"])


@register("json_variant_array", "SELECT conv_id, turn, role, text FROM conversations")
def q_json_variant_array(spark, sf_dir):
    """Conversation documents as VARIANT: their nested array as rows, fields read typed."""
    docs = with_variant(fx.conversation_documents(spark, sf_dir), "doc", "v")
    turns = explode_variant(docs, "v", "$.turns", ["conv_id"])
    return variant_fields(turns, "value", {"turn": ("$.turn", "bigint"), "role": ("$.role", "string"),
                                           "text": ("$.text", "string")}, ["conv_id"])


@register("footer_max_and_count",
          "SELECT 'orders' AS name, MAX(o_orderkey) AS top, MIN(o_orderkey) AS low, COUNT(*) AS n_rows, "
          "COUNT(o_custkey) AS n_keys, true AS pushed FROM orders UNION ALL "
          "SELECT 'customer', MAX(c_custkey), MIN(c_custkey), COUNT(*), COUNT(c_nationkey), true FROM customer")
def q_footer_max_and_count(spark, sf_dir):
    """Current max key and row count of two tables from their footers (``pushed``: the plan reads nothing else)."""
    out = []
    for name, key, other in (("orders", "o_orderkey", "o_custkey"), ("customer", "c_custkey", "c_nationkey")):
        row, pushed = footer_row(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", {
            "top": F.max(key), "low": F.min(key), "n_rows": F.count(F.lit(1)), "n_keys": F.count(other)})
        out.append((name, *row, bool(pushed) and all("MAX" in p and "COUNT" in p for p in pushed)))
    return spark.createDataFrame(out, "name string, top bigint, low bigint, n_rows bigint, n_keys bigint, pushed boolean")


# --- landed documents as a stream, with its run log (S8, S10, K1, K12, G1, G2, A8) ----------

def _streamed_documents(spark, sf_dir, log=None):
    """Conversation documents landed in three drops (the second empty; the third late, with those of conv_id % 5 = 0
    cut in half), each ingested as it lands: the target folder."""
    docs = fx.conversation_documents(spark, sf_dir)
    half = F.expr("substring(doc, 1, cast(length(doc) / 2 as int))")
    docs = docs.withColumn("doc", F.when(F.col("conv_id") % 5 == 0, half).otherwise(F.col("doc")))
    target, landed = scratch_path(spark, "ingested"), scratch_path(spark, "landing")
    for drop in (F.col("conv_id") % 2 == 0, F.lit(False), F.coalesce(F.col("conv_id") % 2 != 0, F.lit(True))):
        docs.filter(drop).select("doc").write.mode("append").text(landed)
        start_document_stream(spark, landed, target, fx.CONV_SCHEMA, f"{target}-checkpoint", log).awaitTermination()
    return target


@register("stream_documents",
          "SELECT conv_id, turn, role, text, true AS named FROM conversations WHERE conv_id % 5 <> 0 OR conv_id IS NULL "
          "UNION ALL SELECT NULL, NULL, 'rejected', 'malformed or mistyped JSON', true FROM "
          f"(SELECT DISTINCT conv_id, turn // {fx.CONV_PAGE} FROM conversations WHERE conv_id % 5 = 0)")
def q_stream_documents(spark, sf_dir):
    """Streamed documents give the rows and rejects of a batch load, each with its file."""
    good, bad = read_ingested(spark, _streamed_documents(spark, sf_dir), fx.CONV_SCHEMA)
    turns = good.select("conv_id", F.col("__FileName").isNotNull().alias("named"), F.explode("turns").alias("t"))
    return turns.select("conv_id", "t.turn", "t.role", "t.text", "named").unionAll(bad.select(
        F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), F.lit("rejected"), "ErrorMessage",
        F.col("__FileName").isNotNull()))


@register("stream_runlog",
          f"WITH p AS (SELECT DISTINCT conv_id, turn // {fx.CONV_PAGE} AS page FROM conversations) "
          "SELECT 'documents' AS package, 'SUCCEEDED' AS status, COUNT(*) AS row_count, true AS in_order FROM p "
          "WHERE conv_id % 2 = 0 HAVING COUNT(*) > 0 UNION ALL "
          "SELECT 'documents', 'SUCCEEDED', COUNT(*), true FROM p WHERE conv_id % 2 <> 0 OR conv_id IS NULL HAVING COUNT(*) > 0 "
          "UNION ALL SELECT 'documents', 'FAILED', 0, true FROM (SELECT COUNT(*) AS n FROM p) WHERE n > 0")
def q_stream_runlog(spark, sf_dir):
    """The stored log of the streams: a row per micro-batch that had documents, and one of a batch that failed."""
    log = scratch_path(spark, "stream-log")
    _streamed_documents(spark, sf_dir, log)
    landed = land_documents(fx.conversation_documents(spark, sf_dir), scratch_path(spark, "landing"))
    failing = start_document_stream(spark, landed, scratch_path(spark, "ingested"), fx.CONV_SCHEMA,
                                    scratch_path(spark, "checkpoint"), log, {"no_turns": F.col("n_turns") < 0})
    try:
        failing.awaitTermination()
    except PySparkException as error:
        if "no_turns" not in str(error):
            raise
    rows = spark.read.parquet(log).filter("row_count > 0 or status = 'FAILED'")
    return rows.select("package", "status", "row_count", (F.col("ended_at") >= F.col("started_at")).alias("in_order"))


FLAGSHIP = "type6_apply"
