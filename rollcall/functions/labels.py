"""Report labels: names, payment method, age and age band, refund mark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.fixed_values import (AGE_BANDS, NEGATIVE_AGE_LABEL, NO_PAYMENT_LABEL,
                                   OVER_60_LABEL, PAYMENT_LABELS, REFUNDABLE_MARK)


def _as_col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def full_name(first, last) -> Column:
    """``upper(concat(first, ' ', last))``: null when either part is null."""
    return F.upper(F.concat(_as_col(first), F.lit(" "), _as_col(last)))


def payment_label(option) -> Column:
    option = _as_col(option)
    expr = F.when(option.isNull(), F.lit(NO_PAYMENT_LABEL))
    for raw, label in PAYMENT_LABELS.items():
        expr = expr.when(option == raw, F.lit(label))
    return expr.otherwise(option)


def age_years(birth, as_of) -> Column:
    """Calendar-year difference ``year(as_of) - year(birth)`` (not the exact age)."""
    if isinstance(as_of, (str, dt.date)):
        as_of = F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)
    return (F.year(as_of) - F.year(_as_col(birth))).cast("int")


def age_band(age) -> Column:
    """Bands overlap at their ends; the first matching band wins."""
    age = _as_col(age)
    expr = None
    for low, high, label in AGE_BANDS:
        cond = age.between(low, high)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return (expr.when(age > AGE_BANDS[-1][1], F.lit(OVER_60_LABEL))
                .when(age < 0, F.lit(NEGATIVE_AGE_LABEL))
                .otherwise(F.lit(None).cast("string")))


def refund_mark(flag) -> Column:
    """Null for flag 0, the mark otherwise, including a missing summary row."""
    return F.when(_as_col(flag) == 0, F.lit(None).cast("string")).otherwise(F.lit(REFUNDABLE_MARK))
