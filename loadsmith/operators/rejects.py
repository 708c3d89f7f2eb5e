"""Reject outputs (K12) and the pre-write constraint gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"


def parse_status(df: DataFrame, text_col: str, schema: str | StructType, keep=None) -> DataFrame:
    """Parse JSON text in one pass: the kept columns, the fields, ``rejected`` and the error columns.

    A text that is null, malformed or mistyped is rejected: its fields are null and
    ErrorCode, ErrorColumn, ErrorColumnName, ErrorMessage and ErrorText (the raw
    text) say why; they are null in good rows.
    """
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in st.fields)
    kept = list(keep or df.columns)
    parsed = df.select(*kept, F.col(text_col).alias("_ls_text"),
                       F.from_json(F.col(text_col), f"{ddl}, {CORRUPT} string",
                                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
                       .alias("_ls_p"))
    bad = F.col("_ls_p").isNull() | F.col("_ls_p." + CORRUPT).isNotNull()
    message = F.when(F.col("_ls_text").isNull(), "no document").otherwise("malformed or mistyped JSON")
    return parsed.select(
        *kept, *(F.when(~bad, F.col(f"_ls_p.`{f.name}`")).alias(f.name) for f in st.fields),
        bad.alias("rejected"), F.when(bad, -1).alias("ErrorCode"), F.when(bad, F.lit(text_col)).alias("ErrorColumn"),
        F.when(bad, F.lit(text_col)).alias("ErrorColumnName"), F.when(bad, message).alias("ErrorMessage"),
        F.when(bad, F.col("_ls_text")).alias("ErrorText"))


def parse_with_rejects(df: DataFrame, text_col: str, schema: str | StructType,
                       keep=None) -> tuple[DataFrame, DataFrame]:
    """``parse_status`` as two frames: good rows with fields, rejected rows with error columns.

    Each frame parses when it is used; take ``parse_status`` where both go to one place.
    """
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept, errors = list(keep or df.columns), ["ErrorCode", "ErrorColumn", "ErrorColumnName", "ErrorMessage", "ErrorText"]
    rows = parse_status(df, text_col, st, kept)
    return (rows.filter("not rejected").select(*kept, *(f.name for f in st.fields)),
            rows.filter("rejected").select(*kept, *errors))


def split_rejects(df: DataFrame, valid: Column, error_column: str = "",
                  message: str = "constraint violated") -> tuple[DataFrame, DataFrame]:
    """Rows failing ``valid`` go to the reject output with error columns."""
    ok = F.coalesce(valid, F.lit(False))
    good = df.filter(ok)
    bad = df.filter(~ok).select("*", F.lit(-1).alias("ErrorCode"),
                                F.lit(error_column).alias("ErrorColumn"),
                                F.lit(error_column).alias("ErrorColumnName"),
                                F.lit(message).alias("ErrorMessage"))
    return good, bad


def broken_rules(rules: dict) -> Column:
    """Names of all rules that a row breaks (NULL = broken), in the order of ``rules``; empty for a good row."""
    return F.filter(F.array(*(F.when(~F.coalesce(pred, F.lit(False)), F.lit(name)) for name, pred in rules.items())),
                    lambda name: name.isNotNull())


def write_with_rejects(df: DataFrame, rules: dict, path: str) -> tuple[DataFrame, DataFrame]:
    """Write good and rejected rows to two targets in one pass; (good, rejected) as read back.

    The targets are the two partitions of ``path``, so each read opens its own files only.
    Rejected rows have a column ``ErrorReasons`` with every rule they break.
    """
    schema = df.schema
    judged = df.withColumn("ErrorReasons", broken_rules(rules))
    (judged.withColumn("rejected", F.size("ErrorReasons") > 0)
     .write.mode("overwrite").partitionBy("rejected").parquet(path))
    stored = df.sparkSession.read.schema(judged.schema.add("rejected", "boolean")).parquet(path)
    return stored.filter("not rejected").select(*schema.names), stored.filter("rejected").drop("rejected")


def enforce(df: DataFrame, constraints: dict) -> DataFrame:
    """Fail the job on the first row breaking a constraint, inside the same pass.

    ``constraints`` maps a name to a predicate that must hold (NULL = broken).
    Evaluated lazily as part of whatever action writes the frame.
    """
    out = df
    for name, pred in constraints.items():
        out = out.filter(F.when(F.coalesce(pred, F.lit(False)), F.lit(True))
                         .otherwise(F.raise_error(F.lit(f"constraint {name} violated")).cast("boolean")))
    return out


def max_length(col: str, n: int) -> Column:
    """String length limit (VARCHAR(n)); over-long values fail like a truncation."""
    return F.col(col).isNull() | (F.length(F.col(col)) <= n)
