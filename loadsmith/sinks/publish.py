"""Loads and publishing.

Row counts come from an ``Observation`` attached to the write itself, so the
written data is never counted by a second scan.

Dimension publishing is copy-on-write, because plain parquet has no row-level
UPDATE.  Every attempt writes to folders of its own; a small pointer file, which
names those folders, makes the batch visible.  A pointer is put only if none
of its number exists and none is newer: of two loads that start from the same
state one fails instead of hiding the other's rows, and a load that is run again
finds its own pointer and does nothing.  Active rows are kept in hash parts of the
key; a batch rewrites the parts it touches and names the others again.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadsmith.operators.scd_common import ChangeSet

#: Rows of a part of the active rows, and the fewest parts; the number follows the counted rows.
PART_ROWS, LEAST_PARTS = 1_000_000, 8


class PublishConflict(RuntimeError):
    """Another load has published since the state that this one was built on."""


def observed_metrics(obs: Observation, names) -> dict:
    """Metrics of a write that has ended; ``rows`` 0 and the others None for a relation
    that the optimizer proved empty (Spark then reports none)."""
    try:
        found = dict(obs.get)
    except Py4JJavaError as e:  # a row without fields can't be converted
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        found = {}
    return {n: found.get(n, 0 if n == "rows" else None) for n in ("rows", *names)}


def write_observed(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet",
                   metrics: dict | None = None, partition_by=None, name: str = "write",
                   bucket: tuple[int, str] | None = None, table: str | None = None) -> dict:
    """Write ``df`` and return metrics observed during that same write.

    ``bucket=(n, key)`` writes a bucketed catalog ``table`` at ``path``.
    """
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [v.alias(k) for k, v in (metrics or {}).items()]
    observed = df.observe(obs, *exprs)
    if bucket:  # one task per bucket, so one file per bucket
        observed = observed.repartition(bucket[0], bucket[1])
    writer = observed.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if bucket:
        writer.bucketBy(bucket[0], bucket[1]).sortBy(bucket[1]).option("path", path).saveAsTable(table)
    else:
        writer.save(path)
    return observed_metrics(obs, metrics or {})


def append_load(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Insert-only load; returns rows written."""
    return write_observed(df, path, "append", fmt)["rows"]


def truncate_reload(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Replace the target's content; returns rows written."""
    return write_observed(df, path, "overwrite", fmt)["rows"]


def land_documents(docs: DataFrame, path: str, column: str = "doc",
                   compression: str | None = None) -> str:
    """Write one JSON document per line (JSON Lines text files)."""
    writer = docs.select(F.col(column).alias("value")).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
    return path


# --- copy-on-write dimension ------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointer_path(root: str, batch: int) -> str:
    return f"{root}/_batches/b={batch:09d}.json"


def _put_pointer(spark: SparkSession, root: str, batch: int, doc: dict) -> None:
    """Write the batch's pointer under a temporary name, then rename it; fail if one exists."""
    jvm, tmp, fs = _fs(spark, f"{root}/_batches/.tmp-{uuid.uuid4().hex}")
    final = jvm.org.apache.hadoop.fs.Path(_pointer_path(root, batch))
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(doc).encode("utf-8")))
    out.close()
    if fs.exists(final) or not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise PublishConflict(f"batch {batch} of {root} has been published by another load")


def _get_pointer(spark: SparkSession, path: str) -> dict | None:
    jvm, p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    reader = jvm.java.util.Scanner(fs.open(p), "UTF-8").useDelimiter("\\A")
    try:
        return json.loads(reader.next())
    finally:
        reader.close()


def _bucket_table(root: str, attempt: str) -> str:
    return f"loadsmith_dim_{hashlib.md5(root.encode()).hexdigest()[:12]}_{attempt}"


def part_of(key: str, parts: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")


def touched_parts(keyed: DataFrame, key: str, parts: int) -> list[int]:
    """Parts that hold a key of ``keyed`` (at most ``parts`` numbers)."""
    return sorted(r[0] for r in keyed.select(part_of(key, parts)).distinct().collect())


def publish_dimension(spark: SparkSession, changes: ChangeSet, base: str, batch: int,
                      key: str, surrogate: str | None = None, start_after: int | None = None,
                      include_history: bool = False, bucket_by: int | None = None,
                      extra: dict | None = None, load_id: str | None = None,
                      parts: int | None = None) -> dict:
    """Publish one batch on top of the newest one; returns counts observed during the writes.

    ``batch`` must be above the newest pointer's number, else ``PublishConflict``;
    only the load that published a number under the same ``load_id`` gets its
    recorded counts back.  ``include_history`` also writes the already-closed rows
    (first publish of a dimension that was loaded elsewhere); later batches only
    add the rows they close.  If ``changes.parts`` is set, ``changes.active`` holds
    the rows of those parts only and the other parts stay as they are.  The pointer
    records the batch and the largest surrogate key, so the next batch starts
    numbering without scanning the dimension.  ``bucket_by=n`` writes the active
    rows as a table bucketed (and sorted) on ``key`` instead: the next batch's
    lookup and expire joins then read them without a shuffle.  ``parts`` is counted from the
    rows unless given; batches that touch some parts only keep the number (see ``repart_dimension``).
    """
    root = base.rstrip("/")
    newest = current_pointer(spark, root)
    if newest is not None and int(newest["batch"]) >= batch:
        own = current_pointer(spark, root, batch)
        if load_id is not None and own is not None and own.get("load_id") == load_id:
            return own["counts"]
        raise PublishConflict(f"batch {batch} of {root} isn't above the newest, {newest['batch']}")
    attempt = uuid.uuid4().hex
    closed = changes.expired.unionByName(changes.history) if include_history else changes.expired
    most = {"max_key": F.max(surrogate)} if surrogate else {}
    hist = write_observed(closed, f"{root}/history/{attempt}", metrics=most, name=f"closed_{attempt}")
    metrics = dict(most)
    if surrogate is not None and start_after is not None:
        metrics["inserted"] = F.count_if(F.col(surrogate) > F.lit(start_after))
    folder = f"{root}/active/{attempt}"
    pointer = {"batch": batch, "load_id": load_id, "schema": changes.active.schema.json(),
               "history": [*(newest or {}).get("history", []), *([attempt] if hist["rows"] else [])]}
    if bucket_by:
        table = _bucket_table(root, attempt)
        active = write_observed(changes.active, folder, metrics=metrics, name=f"active_{attempt}",
                                bucket=(bucket_by, key), table=table)
        pointer |= {"bucketed": bucket_by, "key": key, "table": table, "folder": attempt}
        rows = active["rows"]
    else:
        rows_of = {}
        if changes.parts is not None:
            parts, rows_of = int(newest["parts"]), dict(newest["part_rows"])
        elif parts is None:
            known = changes.active.count() if newest is None else int(newest["active"]) + changes.n_inserted
            parts = parts_for(known)
        folders = dict(newest["part_folders"]) if changes.parts is not None else {}
        split = changes.active.withColumn("_part", part_of(key, parts) if key else F.lit(0))
        active = write_observed(split.repartition(parts, "_part"), folder, metrics=metrics,
                                partition_by="_part", name=f"active_{attempt}")
        written = {}
        if active["rows"]:  # counted from the files' footers
            written = dict(spark.read.parquet(folder).groupBy("_part").count().collect())
        for p in range(parts) if changes.parts is None else changes.parts:
            folders[str(p)], rows_of[str(p)] = attempt, int(written.get(p, 0))
        rows = sum(rows_of.values())
        pointer |= {"parts": parts, "part_folders": folders, "part_rows": rows_of}
    max_key = max([m for m in (hist["max_key"] if most else None, active["max_key"] if most else None, start_after)
                   if m is not None], default=0)
    out = {"closed": hist["rows"], "active": int(rows), "max_key": int(max_key)}
    if "inserted" in metrics:
        out["inserted"] = int(active["inserted"] or 0)
    pointer |= {"max_key": int(max_key), "active": int(rows), "counts": out, **(extra or {})}
    _put_pointer(spark, root, batch, pointer)  # the switch readers follow
    if newest is not None and newest.get("table"):  # superseded; its files stay for readers
        spark.sql(f"DROP TABLE IF EXISTS {newest['table']}")
    return out


#: Pointer fields that a publish sets itself; the others are carried over.
_OWN_FIELDS = {"batch", "load_id", "schema", "history", "bucketed", "key", "table", "folder", "parts", "part_folders",
               "part_rows", "max_key", "active", "counts"}


def parts_for(rows: int) -> int:
    return max(-(-rows // PART_ROWS), LEAST_PARTS)


def repart_dimension(spark: SparkSession, base: str, key: str, parts: int | None = None) -> dict:
    """Publish the active rows anew in as many parts as their number asks for (or in ``parts``); nothing else changes."""
    ptr = _pointer(spark, base.rstrip("/"), None)
    active = read_active(spark, base, int(ptr["batch"]))
    none = active.limit(0)
    return publish_dimension(spark, ChangeSet(none, active, none, none), base, int(ptr["batch"]) + 1, key,
                             start_after=int(ptr["max_key"]), parts=parts or parts_for(int(ptr["active"])),
                             extra={k: v for k, v in ptr.items() if k not in _OWN_FIELDS})


def current_pointer(spark: SparkSession, base: str, batch: int | None = None) -> dict | None:
    """The pointer of the newest batch (or of ``batch``); metadata only."""
    root = base.rstrip("/")
    if batch is not None:
        return _get_pointer(spark, _pointer_path(root, batch))
    jvm, pattern, fs = _fs(spark, f"{root}/_batches/b=*.json")
    found = fs.globStatus(pattern)
    if not found:
        return None
    return _get_pointer(spark, _pointer_path(root, max(int(st.getPath().getName()[2:-5]) for st in found)))


def current_batch(spark: SparkSession, base: str) -> int | None:
    p = current_pointer(spark, base)
    return None if p is None else int(p["batch"])


def _pointer(spark: SparkSession, root: str, batch: int | None) -> dict:
    ptr = current_pointer(spark, root, batch)
    if ptr is None:
        raise FileNotFoundError(f"no dimension published under {root}" + ("" if batch is None else f" as batch {batch}"))
    return ptr


def read_active(spark: SparkSession, base: str, batch: int | None = None,
                parts: list[int] | None = None) -> DataFrame:
    """The active rows of a batch, or those of some of its parts (a bucketed table scan
    when published bucketed)."""
    root = base.rstrip("/")
    ptr = _pointer(spark, root, batch)
    schema = StructType.fromJson(json.loads(ptr["schema"]))
    if not ptr.get("bucketed"):
        wanted = range(int(ptr["parts"])) if parts is None else parts
        paths = [f"{root}/active/{ptr['part_folders'][str(p)]}/_part={p}" for p in wanted if ptr["part_rows"][str(p)]]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    name, path = ptr["table"], f"{root}/active/{ptr['folder']}"
    if not spark.catalog.tableExists(name):  # a new session: register the files again
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({ptr['key']}) "
                  f"SORTED BY ({ptr['key']}) INTO {ptr['bucketed']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def read_history(spark: SparkSession, base: str, batch: int | None = None) -> DataFrame:
    """The closed rows of all batches up to ``batch`` (each batch's folder is in its pointer)."""
    root = base.rstrip("/")
    ptr = _pointer(spark, root, batch)
    schema = StructType.fromJson(json.loads(ptr["schema"]))
    paths = [f"{root}/history/{folder}" for folder in ptr["history"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_dimension(spark: SparkSession, base: str, batch: int | None = None) -> DataFrame:
    """History up to the batch plus that batch's active rows."""
    root = base.rstrip("/")
    b = int(_pointer(spark, root, batch)["batch"])
    return read_history(spark, root, b).unionByName(read_active(spark, root, b))


def part_reader(spark: SparkSession, base: str, ptr: dict, key: str):
    """Given the keyed inserts of a batch: the parts it touches and their active rows.

    None for a bucketed dimension, which is rewritten whole.
    """
    if ptr.get("bucketed"):
        return None

    def closing(keyed: DataFrame) -> tuple[DataFrame, list[int]]:
        touched = touched_parts(keyed, key, int(ptr["parts"]))
        return read_active(spark, base, int(ptr["batch"]), touched), touched
    return closing
