"""Purchase options (shirt size, kit pickup slot) chosen per participant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.sizing import broadcast_if_small
from rollcall.session import materialize


def unnest_options(participant_options: DataFrame, id_col: str = "id",
                   array_col: str = "questionIDs") -> DataFrame:
    """One row per participant and chosen option id (the un-nesting view)."""
    return participant_options.select(F.col(id_col).alias("id"),
                                      F.explode(array_col).alias("questionIDs"))


def option_answers(options_view: DataFrame, items: DataFrame, item_complements: DataFrame,
                   stocks: DataFrame, stock_names, fields: dict[str, str],
                   out_key: str = "participant_id") -> DataFrame:
    """Options whose stock is named in ``stock_names``, with complement ``fields``.

    ``fields`` maps complement columns to output names.  Items and stock are
    inner (the name filter rejects a missing stock), the complement is left:
    a matched option without complement gives nulls, several complements
    repeat it.  The three catalogue tables are joined first into one small
    dimension, broadcast after a size check, so the large option view is
    joined once and never shuffled for it.
    """
    chosen = (items.select(F.col("id").alias("__rc_item"), F.col("ticketStockId").alias("__rc_stock"))
                   .join(stocks.filter(F.col("name").isin(list(stock_names)))
                               .select(F.col("id").alias("__rc_stock")), "__rc_stock")
                   .join(item_complements.select(F.col("stockitemsid").alias("__rc_item"),
                                                 *[F.col(c).alias(n) for c, n in fields.items()]),
                         "__rc_item", "left")
                   .drop("__rc_stock"))
    return (options_view.join(broadcast_if_small(chosen), F.col("questionIDs") == F.col("__rc_item"))
                        .select(F.col("id").alias(out_key), *fields.values()))


def option_answer_groups(options_view: DataFrame, items: DataFrame, item_complements: DataFrame,
                         stocks: DataFrame, groups: dict[str, tuple], out_key: str = "participant_id"
                         ) -> dict[str, DataFrame]:
    """Several ``option_answers`` from one pass over the option view.

    ``groups`` maps a result name to ``(stock_names, fields)``.  The view is
    exploded and joined once against the catalogue of every group (broadcast
    after a size check); the matched options, a small fraction of the view,
    are written once to the shared checkpoint folder and each group filters
    that copy.  (Filters on a shared in-plan subtree would be pushed below
    any exchange, and Spark would explode the view once per group.)
    """
    names = sorted({n for stock_names, _ in groups.values() for n in stock_names})
    columns = sorted({c for _, fields in groups.values() for c in fields})
    chosen = (items.select(F.col("id").alias("__rc_item"), F.col("ticketStockId").alias("__rc_stock"))
                   .join(stocks.filter(F.col("name").isin(names))
                               .select(F.col("id").alias("__rc_stock"), F.col("name").alias("__rc_stock_name")),
                         "__rc_stock")
                   .join(item_complements.select(F.col("stockitemsid").alias("__rc_item"), *columns),
                         "__rc_item", "left")
                   .drop("__rc_stock"))
    matched = materialize(
        options_view.join(broadcast_if_small(chosen), F.col("questionIDs") == F.col("__rc_item"))
                    .select(F.col("id").alias(out_key), "__rc_stock_name", *columns), "options")
    return {name: matched.filter(F.col("__rc_stock_name").isin(list(stock_names)))
                         .select(out_key, *[F.col(c).alias(a) for c, a in fields.items()])
            for name, (stock_names, fields) in groups.items()}
