"""Connected components of links held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import materialize


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v``, which is no other's ``u``."""
    ends = F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("below"), F.lit(0).alias("above")),
                   F.struct(F.col("v").alias("n"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    roles = edges.select(F.explode(ends).alias("e")).groupBy("e.n").agg(F.sum("e.below").alias("below"), F.max("e.above").alias("above"))
    return roles.filter((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0))).isEmpty()


def close_links(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node but the roots' own row, by alternating large-star and small-star contraction.

    ``links`` has ``leader, node``; the root is the least node of its component.  Both sides of each join are
    written tables, so that a node with very many links can be split.
    """
    def stars(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("u", "v")
        if large:
            both = materialize(both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "star-edges")
        least = materialize(both.groupBy(F.col("u").alias("centre")).agg(F.min("v").alias("m")), "star-minima") \
            .select("centre", F.least("m", "centre").alias("m"))
        joined = both.join(least.hint("merge"), F.col("u") == F.col("centre"))
        out = joined.filter(F.col("v") > F.col("u")) if large else joined
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            out = out.unionByName(least.select(F.col("centre").alias("u"), F.col("m").alias("v")))
        out = out.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        return materialize(out, "large-star" if large else "small-star")

    edges = materialize(links.select(F.greatest("leader", "node").alias("u"), F.least("leader", "node").alias("v"))
                        .filter(F.col("u") != F.col("v")).distinct(), "edges")
    while not _are_stars(edges):
        edges = stars(stars(edges, True), False)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
