"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored

MAX_ROUNDS = 40
BROADCAST_EDGES = 500_000     # at most as many nodes of 16 bytes are sent along; beyond it a shuffle join


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges``.

    ``edges`` has bigint columns a and b.  Each round hangs every node's larger
    neighbours (large star), then its smaller ones (small star), under its
    smallest neighbour; the number of rounds grows with the logarithm of the
    graph's size.  A round is two aggregations and two joins over the edges,
    written to the shared folder, so lineage does not grow; a hub's edges are
    combined before the shuffle and its join partition can be split.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                               F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _is_stars(now):
            break
        few = now.count() <= BROADCAST_EDGES
        now = stored(_small_star(_large_star(now, few), few), "edges")
    else:
        raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _is_stars(edges: DataFrame) -> bool:
    """Every node hangs under one other, and none of those hangs itself."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")),
        F.struct(F.col("v").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above")))).alias("e")).select("e.*")
    odd = (ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
           .filter("below > 1 or (below = 1 and above = 1)"))
    return odd.isEmpty()


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Edges u > v.  Every node's larger neighbours move to its smallest
    neighbour (or to the node itself, where it is smaller than all of them)."""
    both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(
        F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(F.broadcast(low) if few else low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    """Edges u > v.  A node's smaller neighbours and the node itself move to
    the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(F.broadcast(low) if few else low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (moved.unionByName(low.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct())
