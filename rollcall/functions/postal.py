"""Postal-code cleaning: ``_`` becomes ``0``, hyphens go, pad or cut to 8, re-hyphenate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.fixed_values import POSTAL_DIGITS, POSTAL_PAD, POSTAL_PREFIX_LEN


def _as_col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def raw_text(col) -> Column:
    """The answer as text, a missing answer as the empty string."""
    return F.coalesce(_as_col(col).cast("string"), F.lit(""))


def stripped(col) -> Column:
    """Underscores to zeros and hyphens removed, in one pass."""
    return F.translate(raw_text(col), "_-", POSTAL_PAD)


def normalised(col) -> Column:
    """``NNNNN-NNN``: rpad pads a short code and cuts a long one to 8 characters."""
    digits = F.rpad(stripped(col), POSTAL_DIGITS, POSTAL_PAD)
    return F.concat(F.substring(digits, 1, POSTAL_PREFIX_LEN), F.lit("-"),
                    F.substring(digits, POSTAL_PREFIX_LEN + 1, POSTAL_DIGITS - POSTAL_PREFIX_LEN))


def underscore_count(col) -> Column:
    text = raw_text(col)
    return F.length(text) - F.length(F.replace(text, F.lit("_"), F.lit("")))
