"""Small tables and plain-Python versions that the operators are held against."""

import re

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, ids=None, langs=None, sources=None):
    """A documents table from texts; ids count from 0 unless given."""
    n = len(texts)
    rows = [((ids or range(n))[i], texts[i], (langs or ["en"] * n)[i], (sources or ["s"] * n)[i],
             None if texts[i] is None else len(texts[i])) for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def rows(df, *cols):
    """All rows as tuples, sorted by their text form."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
