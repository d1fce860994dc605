"""Local purchase dates: UTC wall clock shifted by a fixed offset, no DST."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.fixed_values import LOCAL_OFFSET_HOURS


def _as_col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def local_date(col, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """``cast(ts + offset hours as date)``."""
    return (_as_col(col) + F.make_dt_interval(hours=F.lit(offset_hours))).cast("date")


def _as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def local_day_bounds(first, last, offset_hours: int = LOCAL_OFFSET_HOURS):
    """UTC instants ``[lo, hi)`` that hold exactly the local days first..last."""
    shift = dt.timedelta(hours=offset_hours)
    lo = hi = None
    if first is not None:
        lo = dt.datetime.combine(_as_date(first), dt.time()) - shift
    if last is not None:
        hi = dt.datetime.combine(_as_date(last) + dt.timedelta(days=1), dt.time()) - shift
    return lo, hi


def purchased_between(df: DataFrame, col: str, first, last,
                      offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """Keep rows whose local date lies in the closed range ``[first, last]``.

    Written as a half-open range on the raw column, so the predicate is
    pushed into the Parquet scan (a predicate on the shifted, cast value is
    not).  When the table carries the ``<col>_month`` partition column of
    ``land_table(month_of=col)``, the months outside the range are pruned too.
    Same rows as ``local_date(col) BETWEEN first AND last``.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.DateType):
        cond = F.lit(True)
        if first is not None:
            cond = cond & (F.col(col) >= F.lit(_as_date(first)))
        if last is not None:
            cond = cond & (F.col(col) <= F.lit(_as_date(last)))
        return df.filter(cond)
    cast_to = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    lo, hi = local_day_bounds(first, last, offset_hours)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= F.lit(lo.isoformat(sep=" ")).cast(cast_to))
    if hi is not None:
        cond = cond & (F.col(col) < F.lit(hi.isoformat(sep=" ")).cast(cast_to))
    month = f"{col}_month"
    if month in df.columns:
        # Landed partitioned by the column's UTC month: prune whole months.
        if lo is not None:
            cond = cond & (F.col(month) >= F.lit(lo.strftime("%Y-%m")))
        if hi is not None:
            cond = cond & (F.col(month) <= F.lit((hi - dt.timedelta(microseconds=1)).strftime("%Y-%m")))
    return df.filter(cond)
