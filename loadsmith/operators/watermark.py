"""High-watermark incremental extraction."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_FLOOR = "1900-01-01"


def high_watermark(dim: DataFrame, date_col: str, flag_col: str = "Active_Flag",
                   floor: str = DEFAULT_FLOOR, alias: str = "watermark") -> DataFrame:
    """MAX(date) over active rows, ``floor`` when there are none (one row)."""
    active = dim.filter(F.col(flag_col) == 1)
    return active.agg(F.coalesce(F.max(F.col(date_col).cast("date")),
                                 F.lit(floor).cast("date")).alias(alias))


def watermark_value(dim: DataFrame, date_col: str, flag_col: str = "Active_Flag",
                    floor: str = DEFAULT_FLOOR) -> dt.date:
    """The watermark as a Python date, to be used as a literal (pushed down)."""
    return high_watermark(dim, date_col, flag_col, floor).first()[0]


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def _midnight(d: dt.date):
    return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")


def incremental_scan(source: DataFrame, date_col: str, watermark, upper=None,
                     timestamp_col: str | None = None) -> DataFrame:
    """Rows strictly after the watermark (and before ``upper`` when given).

    ``timestamp_col`` names the raw timestamp the date was cast from.  A
    predicate on a cast cannot be pushed into a Parquet or JDBC scan, so the
    same bounds are also put on the raw column as midnight literals
    (``date > wm`` is ``ts >= wm + 1 day``); those are pushed down.
    """
    wm = _as_date(watermark)
    cond = F.col(date_col) > F.lit(wm)
    if timestamp_col:
        cond = cond & (F.col(timestamp_col) >= _midnight(wm + dt.timedelta(days=1)))
    if upper is not None:
        cond = cond & (F.col(date_col) < F.lit(_as_date(upper)))
        if timestamp_col:
            cond = cond & (F.col(timestamp_col) < _midnight(_as_date(upper)))
    return source.filter(cond)


def full_scan(source: DataFrame, upper=None, date_col: str | None = None,
              timestamp_col: str | None = None) -> DataFrame:
    if upper is None or date_col is None:
        return source
    cond = F.col(date_col) < F.lit(_as_date(upper))
    if timestamp_col:
        cond = cond & (F.col(timestamp_col) < _midnight(_as_date(upper)))
    return source.filter(cond)


def extract(source: DataFrame, date_col: str, mode: str = "incremental", dim=None,
            dim_date: str | None = None, flag_col: str = "Active_Flag",
            floor: str = DEFAULT_FLOOR, upper=None, timestamp_col: str | None = None) -> DataFrame:
    """``incremental``: after the dimension's watermark; ``full``: everything."""
    if mode == "full":
        return full_scan(source, upper, date_col, timestamp_col)
    if mode != "incremental":
        raise ValueError(f"unknown extraction mode {mode!r}")
    wm = floor if dim is None else watermark_value(dim, dim_date or date_col, flag_col, floor)
    return incremental_scan(source, date_col, wm, upper, timestamp_col)
