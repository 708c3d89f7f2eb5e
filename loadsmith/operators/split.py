"""Ordered conditional split (P8-P10): first matching predicate wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route_column(cases, default: str | None = "default", on_null: str = "skip") -> Column:
    """CASE over ``cases`` = [(route, predicate), ...] in evaluation order.

    on_null: ``skip`` (a NULL predicate does not match) or ``fail``.
    """
    expr = None
    for name, pred in cases:
        cond = pred
        if on_null == "fail":
            cond = F.when(pred.isNull(), F.raise_error(F.lit(f"NULL condition in route {name}"))) \
                .otherwise(pred)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))


def conditional_split(df: DataFrame, cases, default: str | None = "default",
                      route_col: str = "route", on_null: str = "skip") -> DataFrame:
    """Add the route column once; branches are filters on it."""
    return df.withColumn(route_col, route_column(cases, default, on_null))


def branch(routed: DataFrame, route: str, route_col: str = "route") -> DataFrame:
    return routed.filter(F.col(route_col) == F.lit(route))


def keep_wired(routed: DataFrame, wired, route_col: str = "route") -> DataFrame:
    """Outputs with no outgoing path drop their rows."""
    return routed.filter(F.col(route_col).isin(list(wired)))
