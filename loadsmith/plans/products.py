"""Document-to-warehouse product load (L1): documents -> 8 typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.functions.columns import round_to_bigint
from loadsmith.operators.shape import map_columns
from loadsmith.plans import fixtures as fx
from loadsmith.sources.documents import parse_documents
from loadsmith.specs import DocumentSpec

PRODUCT_TARGET = ("id bigint, title string, price bigint, discountPercentage double, stock bigint, "
                  "brand string, category string, rating double")

PRODUCT_SPEC = DocumentSpec(schema=fx.PRODUCT_SCHEMA, array_path="products")

# String length limits of the product target (VARCHAR(n)).
PRODUCT_LENGTHS = {"title": 152, "brand": 104, "category": 60}


def transform_products(df: DataFrame, rounding: str = "half_up") -> DataFrame:
    """The eight mapped columns with warehouse types; price rounded to bigint."""
    return map_columns(df, [
        ("id", "id", "bigint"),
        ("title", "title", "string"),
        ("price", round_to_bigint(F.col("price"), rounding), None),
        ("discountPercentage", "discountPercentage", "double"),
        ("stock", "stock", "bigint"),
        ("brand", "brand", "string"),
        ("category", "category", "string"),
        ("rating", "rating", "double"),
    ])


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product of every document, typed for the warehouse."""
    rows = parse_documents(fx.product_documents(spark, sf_dir), "doc", PRODUCT_SPEC)
    return transform_products(rows)
