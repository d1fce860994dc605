"""Participant report: participants left-joined to their resolved addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.fixed_values import REPORT_ADDRESS_NAMES


def join_addresses(participants: DataFrame, addresses: DataFrame, id_col: str = "item_id",
                   names: dict[str, str] = REPORT_ADDRESS_NAMES, same: tuple[str, str] | None = None) -> DataFrame:
    """``participants.*`` plus the renamed address fields, one row per match.

    The address key is text and the participant key an integer.  The text is
    read as a number the way the original join compared them (``'12.0'`` is
    12, blanks are trimmed) through ``decimal(38,0)``, and with ``try_cast``,
    so a malformed key misses instead of failing the job.  A participant with
    several answered codes repeats.  ``same`` names a column of each side that
    must be equal as well.
    """
    key = F.col("item_id").try_cast("decimal(38,0)").try_cast("bigint")
    addr = addresses.select(key.alias("__rc_addr_key"), *([F.col(same[1]).alias("__rc_addr_same")] if same else []),
                            *[F.col(src).alias(dst) for src, dst in names.items()])
    matches = F.col(id_col) == F.col("__rc_addr_key")
    if same:
        matches &= F.col(same[0]) == F.col("__rc_addr_same")
    return participants.join(addr, matches, "left").drop("__rc_addr_key", "__rc_addr_same")
