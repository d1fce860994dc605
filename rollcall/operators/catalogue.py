"""Edition catalogue: sorted distinct editions, optionally filtered by a pattern."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_editions(eventcomplement: DataFrame, contains: str | None = None,
                  col: str = "globalEvent") -> DataFrame:
    """Distinct values of ``col``; ``contains`` is a case-insensitive LIKE fragment.

    ``%`` and ``_`` inside ``contains`` stay wildcards, as in the SQL LIKE the
    catalogue is defined by; a backslash before one of them (or another
    backslash) makes it literal, any other backslash stands for itself.  ``None`` or ``''`` lists every edition.  Nulls
    sort first.  The distinct runs as a partial (map-side) plus final hash
    aggregate, so a popular edition never concentrates rows in one task.
    """
    editions = eventcomplement.select(col)
    if contains:
        contains = re.sub(r"\\([%_\\])|\\", lambda m: m[0] if m[1] else "\\\\", contains)
        editions = editions.filter(F.like(F.lower(F.col(col)), F.lower(F.lit(f"%{contains}%"))))
    return editions.distinct().orderBy(F.col(col).asc_nulls_first())
