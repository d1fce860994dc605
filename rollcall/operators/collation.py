"""Joins under a case/accent-insensitive collation without shuffling the large side.

Spark plans an equality of non-binary collated strings only as a sort-merge
join hashed on the collation key.  When the large side holds one key very
often (every postal-code answer carries the same question id) that sends
all of it to one task.  Instead:

1. the distinct raw keys of the large side are collected by a partial
   (map-side) aggregate, so a hot key costs one row per task;
2. only those keys are matched to the small side under the collation;
3. the large side is joined to that mapping on the raw, binary key, with the
   mapping broadcast after a size check: the large side is never shuffled.
   The mapping is written once to the shared checkpoint folder, so the check
   and the join read it instead of scanning the large side's keys twice.

Same rows as the direct collated join, including every match of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.sizing import broadcast_if_small
from rollcall.session import materialize

_RAW = "__rc_coll_raw"


def join_collated(df: DataFrame, col: str, small: DataFrame, small_col: str, collation: str,
                  how: str = "inner") -> DataFrame:
    """``df JOIN small ON collate(df.col) = collate(small.small_col)``; ``how`` is inner or left."""
    keys = df.select(F.col(col).alias(_RAW)).filter(F.col(_RAW).isNotNull()).distinct()
    pairs = materialize(
        keys.join(small, F.collate(F.col(_RAW), collation) == F.collate(F.col(small_col), collation)), "collated")
    return df.join(broadcast_if_small(pairs), F.col(col) == F.col(_RAW), how).drop(_RAW)
