"""The three loads end to end: product documents, type-6 and versioned dimensions.

Each job is a list of steps run under the run log.  Dimension jobs read the last
published batch (or start from a typed empty dimension), extract incrementally
after the watermark (or in full), apply the batch, and publish expiries and inserts
together.  Counts come from observations, so the source is scanned once per run.
Sources are DataFrames, catalog tables or paths.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadsmith.operators.rejects import enforce, max_length
from loadsmith.operators.scd_common import ChangeSet
from loadsmith.operators.scd_type6 import type6_changes
from loadsmith.operators.scd_versioned import versioned_changes
from loadsmith.operators.watermark import DEFAULT_FLOOR, full_scan, incremental_scan, watermark_value
from loadsmith.plans.products import PRODUCT_LENGTHS, PRODUCT_SPEC, transform_products
from loadsmith.plans.runlog import StepOutcome, later, run_steps
from loadsmith.sinks.ddl import PRODUCT_DDL, create_table_if_missing
from loadsmith.sinks.publish import (
    current_pointer,
    observed_metrics,
    part_reader,
    publish_dimension,
    read_active,
    read_history,
    write_observed,
)
from loadsmith.sources.documents import first_rows, parse_documents, read_documents
from loadsmith.sources.tables import empty_frame, is_path, read_table
from loadsmith.specs import DocumentSpec, Type6Spec, VersionedSpec

T6_EMPTY = ("Emp_Key bigint, ID bigint, Name string, CURRENTCity string, HESTORICALCity string, "
            "CURRENTEmail string, HESTORICALEmail string, STARTDate date, ENDDate date, Active_Flag int")
V_EMPTY = ("Emp_Key bigint, ID bigint, Name string, City string, Email string, Schedule_Date date, "
           "Active_Flag int, Version_No int")


@dataclass(frozen=True)
class LoadResult:
    """What a load did; ``outcomes`` are its run-log rows."""

    inserted: int
    expired: int
    outcomes: list[StepOutcome]


def product_constraints() -> dict[str, Column]:
    return {"id_not_null": F.col("id").isNotNull(),
            **{f"{c}_length": max_length(c, n) for c, n in PRODUCT_LENGTHS.items()}}


def run_product_load(spark: SparkSession, documents, target: str, load_mode: str = "append",
                     max_rows: int = 0, spec: DocumentSpec = PRODUCT_SPEC, order_by=("skip",),
                     rounding: str = "half_up", constraints: dict | None = None,
                     multi_line: bool = False, log_to: str | None = None) -> LoadResult:
    """Documents (a path, or a DataFrame with a ``doc`` column) -> products -> typed target.

    ``max_rows`` keeps the first so many in document order (by ``order_by``, root
    fields, then place in the array); 0 keeps all.  ``multi_line`` reads one
    pretty-printed document per file.  ``target`` is a folder or a catalog table,
    created if missing.  ``constraints`` (default: key not null, VARCHAR limits)
    are checked inside the writing pass; a broken one fails the load.
    """
    extracted = Observation("extracted")

    def extract(shared: dict):
        keyed = DocumentSpec(schema=spec.schema, array_path=spec.array_path,
                             parents=tuple(order_by), keep_position=True)
        if isinstance(documents, DataFrame):
            rows = parse_documents(documents, "doc", keyed)
        else:
            rows = read_documents(spark, documents, keyed, multi_line=multi_line)
        rows = first_rows(rows, max_rows, [f"P_{c}" for c in order_by] + ["pos"])
        shared["rows"] = rows.observe(extracted, F.count(F.lit(1)).alias("n"))
        return later(extracted)

    def transform(shared: dict):
        gate = product_constraints() if constraints is None else constraints
        shared["out"] = enforce(transform_products(shared["rows"], rounding), gate)
        return later(extracted)

    def load(shared: dict):
        mode = "overwrite" if load_mode == "overwrite" else "append"
        if is_path(target):
            shared["written"] = write_observed(shared["out"], target, mode)["rows"]
        else:
            create_table_if_missing(spark, target, PRODUCT_DDL)
            obs = Observation("loaded")
            shared["out"].observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(target, mode == "overwrite")
            shared["written"] = observed_metrics(obs, [])["rows"]
        written.append(shared["written"])
        return shared["written"]

    written: list[int] = []
    outcomes = run_steps(spark, "Q1", [("extract_json", extract), ("transform", transform),
                                       ("load_product_q1", load)], log_to)
    return LoadResult(written[0], 0, outcomes)


def seed_dimension(spark: SparkSession, dim: DataFrame, base: str, surrogate: str = "Emp_Key",
                   flag: str = "Active_Flag", key: str = "ID",
                   bucket_by: int | None = None) -> dict:
    """Publish an existing dimension as batch 0 (closed rows + active rows)."""
    active = dim.filter(F.col(flag) == 1)
    closed = dim.filter(F.col(flag).isNull() | (F.col(flag) != 1))
    empty = dim.limit(0)
    return publish_dimension(spark, ChangeSet(history=closed, active=active, expired=empty,
                                              inserted=empty),
                             base, 0, key, surrogate, None, include_history=True,
                             bucket_by=bucket_by)


def _dimension_job(spark, source, base: str, package: str, *, date_col: str, dim_date: str,
                   empty_schema: str, apply, spec, mode: str, floor: str, upper,
                   bucket_by: int | None, watermark_from: str, timestamp_col: str | None,
                   constraints: dict | None, log_to: str | None) -> LoadResult:
    if mode not in ("incremental", "full"):
        raise ValueError(f"unknown extraction mode {mode!r}")
    seen = Observation("source")

    def compute_watermark(shared: dict):
        ptr = current_pointer(spark, base)
        shared["first"] = ptr is None
        if ptr is None:
            empty = empty_frame(spark, empty_schema)
            shared |= {"active": empty, "history": empty, "ptr": {"batch": 0, "max_key": 0, "active": 0}}
        else:
            b = int(ptr["batch"])
            shared |= {"active": read_active(spark, base, b), "history": read_history(spark, base, b), "ptr": ptr}
            if not bucket_by:
                shared["closing"] = part_reader(spark, base, ptr, spec.key)
        if mode == "incremental" and watermark_from == "source":
            # the latest source date already loaded: updates dated before the last
            # run date but loaded later are still read
            shared["after"] = dt.date.fromisoformat(shared["ptr"].get("source_watermark") or floor)
        elif mode == "incremental":
            shared["after"] = watermark_value(shared["active"], dim_date, floor=floor)
        return 0

    def extract_source(shared: dict):
        table = read_table(spark, source) if isinstance(source, str) else source
        rows = (full_scan(table, upper, date_col, timestamp_col) if mode == "full" else
                incremental_scan(table, date_col, shared["after"], upper, timestamp_col))
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.max(F.col(date_col).cast("date")).alias("max_date"))
        gate = {f"{spec.key}_not_null": F.col(spec.key).isNotNull()} if constraints is None else constraints
        shared["source"] = enforce(rows, gate)
        return later(seen)

    def read_active_dim(shared: dict):
        return int(shared["ptr"]["active"])  # observed when the batch was published: no scan here

    def transform(shared: dict):
        shared["changes"] = apply(shared["source"], int(shared["ptr"]["max_key"]), shared["active"],
                                  shared["history"], shared.get("closing"))
        return lambda: published["inserted"] + published["closed"]

    def expire(shared: dict):
        # expiries and inserts are published together: one visible change
        latest = observed_metrics(seen, ["max_date"])["max_date"]
        dates = [d for d in (latest and latest.isoformat(), shared["ptr"].get("source_watermark")) if d]
        published.update(publish_dimension(
            spark, shared["changes"], base, int(shared["ptr"]["batch"]) + 1, spec.key, spec.surrogate,
            int(shared["ptr"]["max_key"]), include_history=shared["first"], bucket_by=bucket_by,
            extra={"source_watermark": max(dates, default=None), "streams": shared["ptr"].get("streams", {})}))
        return published["closed"]

    published: dict = {}
    outcomes = run_steps(spark, package, [
        ("compute_watermark", compute_watermark), ("extract_source", extract_source),
        ("read_active_dim", read_active_dim), ("transform_type6", transform), ("expire_old_rows", expire),
        ("insert_new_versions", lambda shared: published["inserted"])], log_to)
    return LoadResult(published["inserted"], published["closed"], outcomes)


def run_type6_load(spark: SparkSession, source, base: str, run_date: dt.date | None = None,
                   spec: Type6Spec = Type6Spec(), mode: str = "incremental",
                   floor: str = DEFAULT_FLOOR, upper=None,
                   bucket_by: int | None = None,
                   watermark_from: str = "dimension",
                   timestamp_col: str | None = None, constraints: dict | None = None,
                   log_to: str | None = None) -> LoadResult:
    """One type-6 load.  ``run_date`` defaults to today.

    ``watermark_from``: ``dimension`` (max start date of the active rows, as the
    reference does; changed rows start at the run date, so an update dated
    before the last run but loaded later is skipped) or ``source`` (the latest
    source date already loaded, kept in the publish pointer).

    ``bucket_by=n`` publishes the active rows bucketed on the natural key, so the
    next run's lookup and expire joins do not shuffle the dimension.
    ``constraints`` (default: the key is not null) are checked inside the reading
    pass; a broken one fails the load before anything is published."""
    if run_date is None:
        run_date = spark.range(1).select(F.current_date()).first()[0]

    def apply(src, max_key, active, history, closing):
        return type6_changes(None, src, spec, run_date, start_after=max_key, active=active,
                             history=history, closing=closing)
    return _dimension_job(spark, source, base, "Q2", date_col=spec.source_date, dim_date=spec.start,
                          empty_schema=T6_EMPTY, apply=apply, spec=spec, mode=mode, floor=floor, upper=upper,
                          bucket_by=bucket_by, watermark_from=watermark_from, timestamp_col=timestamp_col,
                          constraints=constraints, log_to=log_to)


def run_versioned_load(spark: SparkSession, source, base: str,
                       spec: VersionedSpec = VersionedSpec(), mode: str = "full",
                       floor: str = DEFAULT_FLOOR, upper=None,
                       bucket_by: int | None = None,
                       timestamp_col: str | None = None, constraints: dict | None = None,
                       log_to: str | None = None) -> LoadResult:
    """One versioned load.  ``full`` is the default: under the watermark the
    same-date branch cannot be reached."""
    def apply(src, max_key, active, history, closing):
        return versioned_changes(None, src, spec, start_after=max_key, active=active,
                                 history=history, closing=closing)
    return _dimension_job(spark, source, base, "Q3", date_col=spec.date, dim_date=spec.date,
                          empty_schema=V_EMPTY, apply=apply, spec=spec, mode=mode, floor=floor, upper=upper,
                          bucket_by=bucket_by, watermark_from="dimension", timestamp_col=timestamp_col,
                          constraints=constraints, log_to=log_to)
