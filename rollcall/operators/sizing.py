"""Broadcast only behind a checked size bound.

``has_at_most`` counts, so each task sends one number; a side that is costly
to compute is written first (``key_set``) and the written copy is counted.
Sides above the bound are merge-joined: the planner, which looks at the bytes of
files and shuffles, would still send the driver some of them, once for every join.
An id set above it makes the restricted table shuffle on its key once.  So what a
job sends to the driver does not grow with its tables beyond the bounds.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import materialize, run_concurrently

DEFAULT_BROADCAST_ROWS = 250_000


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if has_at_most(df, max_rows) else df.hint("merge")


# An id set is one long per row, and filters a dozen tables of an extraction, each
# with its own broadcast (collected by the driver, then sent to every executor).
ID_SET_ROWS = 500_000
_IDS = "__rc_ids"


class IdSet(NamedTuple):
    """Distinct ids, and the range they lie in (``None`` when there are none)."""
    ids: DataFrame
    low: object
    high: object


def key_set(df: DataFrame, col: str, max_rows: int = ID_SET_ROWS) -> IdSet:
    """Distinct non-null values of ``col`` as column ``__rc_ids``, broadcast when the bound holds, with their range.

    The set is written once to the shared checkpoint folder: the one look that
    counts it and finds its range, and every table it filters, read that small
    file instead of each re-aggregating ``df``.
    """
    ids = materialize(df.select(F.col(col).alias(_IDS)).filter(F.col(_IDS).isNotNull()).distinct(), "ids")
    n, low, high = ids.agg(F.count("*"), F.min(_IDS), F.max(_IDS)).first()
    return IdSet(F.broadcast(ids) if n <= max_rows else ids.hint("merge"), low, high)


def key_sets(df: DataFrame, *cols: str, max_rows: int = ID_SET_ROWS) -> list[IdSet]:
    """``key_set`` of several columns of ``df``, computed as concurrent jobs."""
    return run_concurrently(df.sparkSession, *[lambda c=c: key_set(df, c, max_rows) for c in cols])


def restrict(df: DataFrame, col: str, ids: IdSet) -> DataFrame:
    """Rows of ``df`` whose ``col`` is in ``ids``.

    A semi-join (a map-side filter when the ids are broadcast, a shuffle by
    ``col`` beyond the bound), behind a comparison with the ids' range that
    reaches the scan: of a table clustered by ``col`` (``land_table``) it reads
    only the row groups that overlap the range, whatever the number of ids.
    """
    if ids.low is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(col).between(F.lit(ids.low), F.lit(ids.high))).join(ids.ids, F.col(col) == F.col(_IDS), "left_semi")
