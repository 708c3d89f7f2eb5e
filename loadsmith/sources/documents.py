"""JSON document ingestion.

Documents are either files (``read_documents``: JSON Lines by default, one
document per line, splittable; ``multi_line=True`` for one pretty-printed
document per file) or a string column (``parse_documents``).  Either way the
document is parsed against a declared schema on the executors, the array under
``array_path`` is exploded with its position, and root scalars ride along as
``P_``-prefixed parent columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.specs import DocumentSpec

FILE_NAME = "__FileName"


def _explode(parsed: DataFrame, doc: str, spec: DocumentSpec, passthrough) -> DataFrame:
    arr = F.col(f"{doc}.{spec.array_path}")
    gen = F.posexplode_outer(arr) if spec.include_parents_when_child_missing else F.posexplode(arr)
    parents = [F.col(f"{doc}.{p}").alias(spec.parent_prefix + p) for p in spec.parents]
    rows = parsed.select(*passthrough, *parents, gen.alias("_ls_pos", "_ls_elem"))
    elem_fields = rows.schema["_ls_elem"].dataType
    if hasattr(elem_fields, "fieldNames"):
        elem = [F.col("_ls_elem." + f).alias(f) for f in elem_fields.fieldNames()]
    else:
        elem = [F.col("_ls_elem").alias("value")]
    pos = [F.col("_ls_pos").alias("pos")] if spec.keep_position else []
    parent_names = [spec.parent_prefix + p for p in spec.parents]
    return rows.select(*passthrough, *parent_names, *pos, *elem)


def parse_documents(docs: DataFrame, text_col: str, spec: DocumentSpec,
                    mode: str = "FAILFAST", passthrough=()) -> DataFrame:
    """JSON documents held in a string column -> one row per array element."""
    opts = {"mode": mode, **spec.extra}
    parsed = docs.select(*passthrough, F.from_json(F.col(text_col), spec.schema, opts).alias("_ls_doc"))
    return _explode(parsed, "_ls_doc", spec, list(passthrough))


def read_documents(spark: SparkSession, paths, spec: DocumentSpec, multi_line: bool = False,
                   file_name: bool = False, file_path: bool = False, recursive: bool = False,
                   ignore_missing: bool = False, mode: str = "FAILFAST",
                   options: dict | None = None, path_glob: str | None = None) -> DataFrame:
    """Landed documents -> one row per array element.

    One call reads a list of paths, a glob, a folder (``recursive``), and any
    compression codec known by extension.  ``mode``: FAILFAST (default, a bad
    document fails the read) or PERMISSIVE.
    """
    reader = (spark.read.schema(spec.schema).option("multiLine", multi_line)
              .option("mode", mode).option("recursiveFileLookup", recursive)
              .option("ignoreMissingFiles", ignore_missing))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    for k, v in {**spec.extra, **(options or {})}.items():
        reader = reader.option(k, v)
    paths = [paths] if isinstance(paths, str) else list(paths)
    if ignore_missing:
        paths = existing_paths(spark, paths)
        if not paths:
            return _explode(spark.createDataFrame([], spec.schema).select(
                F.struct("*").alias("_ls_doc")), "_ls_doc", spec, [])
    raw = reader.json(paths)
    meta, names = [], []
    if file_name:
        meta.append(F.col("_metadata.file_name").alias(FILE_NAME))
        names.append(FILE_NAME)
    if file_path:
        meta.append(F.col("_metadata.file_path").alias("__FilePath"))
        names.append("__FilePath")
    parsed = raw.select(*meta, F.struct(*[F.col(c) for c in raw.columns]).alias("_ls_doc"))
    return _explode(parsed, "_ls_doc", spec, names)


def existing_paths(spark: SparkSession, paths) -> list[str]:
    """Paths (or globs) that match something; a metadata call, no data read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        found = hp.getFileSystem(conf).globStatus(hp)
        if found is not None and len(found) > 0:
            out.append(p)
    return out


def read_raw_documents(spark: SparkSession, paths, whole_file: bool = False) -> DataFrame:
    """One string per document (``value``): per line, or per file with ``whole_file``."""
    return spark.read.text(paths, wholetext=whole_file)


def first_rows(rows: DataFrame, n: int, order_by) -> DataFrame:
    """First ``n`` rows in document order across many documents (a bounded top-n)."""
    if n <= 0:
        return rows
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return rows.orderBy(*order).limit(n)


def nested_as_string(df: DataFrame, columns) -> DataFrame:
    """Keep nested arrays/objects as their JSON text (flattening off)."""
    return df.withColumns({c: F.to_json(F.col(c)) for c in columns})


def flatten_array(df: DataFrame, column: str, max_items: int = 10, separator: str = "_",
                  fields=None) -> DataFrame:
    """Flattening on: element i (< max_items) becomes ``<col>_<i>[_<field>]`` columns.

    Elements from ``max_items`` on are kept, as an array, in ``<col>_rest`` (null if
    there are none).
    """
    size = F.size(column)
    cols = [F.when(size > max_items, F.slice(column, max_items + 1, F.greatest(size - max_items, F.lit(0))))
            .alias(f"{column}{separator}rest")]
    for i in range(max_items):
        item = F.get(F.col(column), i)  # NULL past the end (ANSI-safe)
        if fields:
            cols += [item.getField(f).alias(f"{column}{separator}{i}{separator}{f}") for f in fields]
        else:
            cols.append(item.alias(f"{column}{separator}{i}"))
    return df.select("*", *cols).drop(column)


def to_name_value(df: DataFrame, ids, values, value_type: str = "double") -> DataFrame:
    """Columns to rows: ``Pivot_Name`` / ``Pivot_Value``."""
    cast = df.select(*ids, *[F.col(v).cast(value_type).alias(v) for v in values])
    return cast.unpivot(list(ids), list(values), "Pivot_Name", "Pivot_Value")


def rows_from_2d(df: DataFrame, names_col: str, rows_col: str, columns,
                 passthrough=(), value_type: str | None = None) -> DataFrame:
    """2-D array to rows: one row per inner array; values named by ``names_col``.

    ``columns`` (the custom column list) fixes the output schema; a name missing
    from a document's name list gives NULL.
    """
    exploded = df.select(*passthrough, F.col(names_col).alias("_ls_names"),
                         F.explode(F.col(rows_col)).alias("_ls_row"))
    # a ragged row (shorter or longer than the name list) pairs what it can
    n = F.least(F.size("_ls_names"), F.size("_ls_row"))
    named = exploded.select(*passthrough, F.map_from_arrays(F.slice("_ls_names", 1, n),
                                                            F.slice("_ls_row", 1, n)).alias("_ls_map"))
    out = []
    for c in columns:
        v = F.col("_ls_map").getItem(c)
        out.append((v.cast(value_type) if value_type else v).alias(c))
    return named.select(*passthrough, *out)


def replace_in_text(df: DataFrame, column: str, pattern: str, replacement: str,
                    regex: bool = True) -> DataFrame:
    """Search/replace inside the raw document before it is parsed."""
    if regex:
        new = F.regexp_replace(F.col(column), pattern, replacement)
    else:
        new = F.replace(F.col(column), F.lit(pattern), F.lit(replacement))
    return df.withColumn(column, new)


def parse_column(df: DataFrame, column: str, schema: str, alias: str | None = None,
                 mode: str = "PERMISSIVE") -> DataFrame:
    """JSON held in a column -> typed fields (``from_json`` with a declared schema)."""
    parsed = F.from_json(F.col(column), schema, {"mode": mode})
    if alias:
        return df.withColumn(alias, parsed)
    return df.select("*", parsed.alias("_ls_j")).select(
        *[F.col(c) for c in df.columns], "_ls_j.*")
