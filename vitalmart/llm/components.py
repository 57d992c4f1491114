"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of one orderable type -> (node, root), one row per node of an edge.

    Each round every node takes the neighbour (or itself) that comes first in an order
    hashed anew for the round, edges move to the chosen nodes, and loops go. A random
    order shortens long chains by a constant share per round, so the rounds grow with
    the logarithm of the graph. A hub of any degree is one row per task before the
    shuffle; its rows in the joins are split by adaptive execution. Rows with a NULL end
    and loops carry no link and are ignored; no edges give an empty result.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels, salt = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(salt), c).alias("h"), F.col(c).alias("n"))
        picks = both.groupBy("a").agg(F.min(rank("b")).alias("near")).select(
            F.col("a").alias("node"), F.least("near", rank("a"))["n"].alias("root"))
        picks = stored(picks, "picks")
        if labels is None:
            labels = picks
        else:
            moved = picks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = stored(labels.join(moved, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")), "labels")
        of = lambda c: picks.select(F.col("node").alias(c), F.col("root").alias(f"{c}2"))
        edges = stored(edges.join(of("a"), "a").join(of("b"), "b").select(
            F.col("a2").alias("a"), F.col("b2").alias("b")).where("a <> b").distinct(), "edges")
        salt += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
