"""Ticket trades: the item and holder a participant's ticket came from or went to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.fixed_values import PAID_STATUS
from rollcall.functions.labels import full_name
from rollcall.operators.fanout import attach_sides
from rollcall.operators.sizing import broadcast_if_small, restrict
from rollcall.session import materialize


OLD, NEW = "old", "new"


def trade_roles(trades: DataFrame, ids: DataFrame | None = None, paid_status: str = PAID_STATUS) -> DataFrame:
    """One row per trade and participant it attaches to, from one scan of ``trades``, written once.

    ``__rc_role`` is ``old`` where the participant is the trade's ``participantId``
    and ``new`` where it is its ``originalParticipantId``; ``__rc_key`` is the
    participant, ``__rc_other`` the other one, ``__rc_name`` the name on the trade.
    ``ids`` (a ``key_set`` of the participants to correlate) is applied to the
    keys before anything is shuffled.
    """
    def role(name: str, key: str, other: str):
        return F.struct(F.lit(name).alias("role"), F.col(key).alias("key"), F.col(other).alias("other"))
    both = F.explode(F.array(role(OLD, "participantId", "originalParticipantId"), role(NEW, "originalParticipantId", "participantId")))
    rows = trades.select(both.alias("r"), (F.col("status") == F.lit(paid_status)).alias("__rc_paid"),
                         full_name("participantName", "participantSurname").alias("__rc_name"))
    rows = rows.select(F.col("r.role").alias("__rc_role"), F.col("r.key").alias("__rc_key"), F.col("r.other").alias("__rc_other"),
                       "__rc_paid", "__rc_name").filter(F.col("__rc_key").isNotNull())
    return materialize(restrict(rows, "__rc_key", ids) if ids is not None else rows, "trade-roles")


def trade_sides(roles: DataFrame, participants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of the trade correlation (from ``trade_roles``), keyed by the participant they attach to.

    * as the *old* item (``trade.participantId = id``): the correlated item is
      ``originalParticipantId``, its holder's name comes from the participant
      table (self-join);
    * as the *new* item (``trade.originalParticipantId = id``): the correlated
      item is ``participantId``, the name is the one stored on the trade.
    """
    paid = roles.filter(F.col("__rc_paid"))
    by_participant = paid.filter(F.col("__rc_role") == OLD).select(
        F.col("__rc_key").alias("__rc_old_key"), F.col("__rc_other").alias("__rc_old_new_item"))
    # Only the holders of traded tickets are needed: the participant table is
    # semi-joined to the (size-checked, broadcast) set of their ids, so it is
    # scanned but never shuffled whole for a handful of names.
    wanted = materialize(by_participant.select(F.col("__rc_old_new_item").alias("__rc_holder_id")).distinct(), "traded")
    holders = (participants.select(F.col("id").alias("__rc_holder_id"),
                                   full_name("name", "surname").alias("__rc_holder_name"))
                           .join(broadcast_if_small(wanted), "__rc_holder_id", "left_semi"))
    as_old = materialize(by_participant.join(holders, F.col("__rc_old_new_item") == F.col("__rc_holder_id"), "left")
                         .drop("__rc_holder_id"), "trades-old")
    as_new = paid.filter(F.col("__rc_role") == NEW).select(
        F.col("__rc_key").alias("__rc_new_key"), F.col("__rc_other").alias("__rc_new_old_item"),
        F.col("__rc_name").alias("__rc_new_name"))
    return as_old, as_new


def correlated(df: DataFrame) -> DataFrame:
    """Coalesce id and name of the joined sides independently (new-item side first)."""
    return (df.withColumn("correlated_item_id", F.coalesce("__rc_new_old_item", "__rc_old_new_item"))
              .withColumn("correlated_participant", F.coalesce("__rc_new_name", "__rc_holder_name"))
              .drop("__rc_old_new_item", "__rc_holder_name", "__rc_new_old_item", "__rc_new_name"))


def correlate_trades(df: DataFrame, trades: DataFrame, participants: DataFrame, id_col: str,
                     paid_status: str = PAID_STATUS, ids: DataFrame | None = None) -> DataFrame:
    """Add ``correlated_item_id`` and ``correlated_participant`` (see ``trade_sides``).

    Several paid trades per participant multiply its rows, as the joins do.
    """
    as_old, as_new = trade_sides(trade_roles(trades, ids, paid_status), participants)
    return correlated(attach_sides(df, id_col, [(as_old, "__rc_old_key"), (as_new, "__rc_new_key")]))
