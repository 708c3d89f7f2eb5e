"""Post-load data-quality checks (V1.1-V3.3) and the run-log listing (V4).

Every check returns a one-row DataFrame ``(check_name, violations)`` (V1.1 also
``actual``/``expected``).  Checks that are plain predicates can be evaluated
together in one pass with ``predicate_checks``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadsmith.operators.history import previous_values


def rowcount_check(df: DataFrame, expected: int, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("actual"),
                  F.lit(expected).cast("bigint").alias("expected"))


def violation_count(df: DataFrame, predicate: Column, name: str) -> DataFrame:
    return df.agg(F.lit(name).alias("check_name"),
                  F.count_if(F.coalesce(predicate, F.lit(False))).alias("violations"))


def predicate_checks(df: DataFrame, checks: dict) -> DataFrame:
    """Several predicate checks in one scan; one row per check."""
    aggs = [F.count_if(F.coalesce(p, F.lit(False))).alias(f"c{i}") for i, p in enumerate(checks.values())]
    wide = df.agg(*aggs)
    rows = [wide.select(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("violations"))
            for i, n in enumerate(checks)]
    return reduce(DataFrame.unionByName, rows)


def duplicate_count(df: DataFrame, keys, name: str, where: Column | None = None) -> DataFrame:
    """Number of key values that occur more than once (partial aggregation)."""
    src = df if where is None else df.filter(where)
    keys = [keys] if isinstance(keys, str) else list(keys)
    dups = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dups.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("violations"))


# --- product table (V1) -----------------------------------------------------

def q1_rowcount(df: DataFrame, expected: int = 25) -> DataFrame:
    return rowcount_check(df, expected, "Q1_rowcount")


def q1_null_keys(df: DataFrame) -> DataFrame:
    return violation_count(df, F.col("id").isNull() | F.col("title").isNull(), "Q1_null_keys")


def q1_domain(df: DataFrame) -> DataFrame:
    d, r, s = F.col("discountPercentage"), F.col("rating"), F.col("stock")
    return violation_count(df, (d < 0) | (d > 100) | (r < 0) | (r > 5) | (s < 0), "Q1_domain")


def q1_dupes(df: DataFrame) -> DataFrame:
    return duplicate_count(df, "id", "Q1_dupes")


# --- type-6 dimension (V2) --------------------------------------------------

def q2_one_active_per_id(dim: DataFrame, key: str = "ID", flag: str = "Active_Flag") -> DataFrame:
    return duplicate_count(dim, key, "Q2_one_active_per_id", F.col(flag) == 1)


def q2_dating(dim: DataFrame, flag: str = "Active_Flag", end: str = "ENDDate") -> DataFrame:
    f, e = F.col(flag), F.col(end)
    return violation_count(dim, ((f == 1) & e.isNotNull()) | ((f == 0) & e.isNull()), "Q2_dating")


def q2_type6_history(dim: DataFrame, key: str = "ID", start: str = "STARTDate",
                     surrogate: str = "Emp_Key", current: str = "CURRENTCity",
                     history: str = "HESTORICALCity", strict: bool = False,
                     method: str = "auto") -> DataFrame:
    """City changed against the previous version but the history does not hold it.

    As written the comparison is ``<>``, so a NULL history is not flagged;
    ``strict`` compares null-safely.
    """
    ranked = previous_values(dim, key, [start, surrogate], [current], method=method)
    prev, cur, hist = F.col("prev_" + current), F.col(current), F.col(history)
    if strict:
        bad = prev.isNotNull() & ~cur.eqNullSafe(prev) & ~hist.eqNullSafe(prev)
    else:
        bad = prev.isNotNull() & (cur != prev) & (hist != prev)
    return violation_count(ranked, bad, "Q2_type6_history")


def q2_type6_history_strict(dim: DataFrame, key: str = "ID", start: str = "STARTDate",
                            surrogate: str = "Emp_Key",
                            pairs=(("CURRENTCity", "HESTORICALCity"),
                                   ("CURRENTEmail", "HESTORICALEmail")),
                            method: str = "auto") -> DataFrame:
    """Strict history check over every tracked pair, NULL-safe, in one pass:
    a version whose current value differs from the previous version's must hold
    that previous value as its history."""
    ranked = previous_values(dim, key, [start, surrogate], [c for c, _ in pairs], method=method)
    bad = F.lit(False)
    for cur, hist in pairs:
        prev = F.col("prev_" + cur)
        first = F.col("prev_" + pairs[0][0]).isNull() & F.col("prev_" + pairs[-1][0]).isNull()
        bad = bad | (~first & ~F.col(cur).eqNullSafe(prev) & ~F.col(hist).eqNullSafe(prev))
    return violation_count(ranked, bad, "Q2_type6_history_strict")


def q2_emp_key_unique(dim: DataFrame, surrogate: str = "Emp_Key") -> DataFrame:
    return duplicate_count(dim, surrogate, "Q2_emp_key_unique")


# --- versioned dimension (V3) -----------------------------------------------

def q3_one_active_per_id(dim: DataFrame, key: str = "ID", flag: str = "Active_Flag") -> DataFrame:
    return duplicate_count(dim, key, "Q3_one_active_per_id", F.col(flag) == 1)


def q3_version_positive(dim: DataFrame, version: str = "Version_No") -> DataFrame:
    return violation_count(dim, F.col(version) < 1, "Q3_version_positive")


def q3_emp_key_unique(dim: DataFrame, surrogate: str = "Emp_Key") -> DataFrame:
    return duplicate_count(dim, surrogate, "Q3_emp_key_unique")


# --- run log (V4) -----------------------------------------------------------

def latest_entries(log: DataFrame, n: int = 50, ts: str = "started_at", tie: str | None = None) -> DataFrame:
    """Top-n by time, newest first (a bounded TakeOrderedAndProject)."""
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    return log.orderBy(*order).limit(n)
