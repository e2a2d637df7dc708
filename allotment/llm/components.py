"""Connected components of a graph that is held in tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row per node that has an edge: ``node`` and ``component``, its smallest node.

    Each round hooks every node to its smallest smaller neighbour, follows the
    hooks to their roots by pointer jumping, and replaces the ends of all edges by
    their roots; edges inside a root vanish. Rounds and jumps grow with the
    logarithm of the graph. Nothing but row counts reaches the driver. Minima are
    combined before each shuffle, and joins have one row per key on one side, so
    that a node with very many edges can be split. Loops, repeated edges and either
    direction are fine; edges with a NULL end are left out.
    """
    scratch = Scratch(edges.sparkSession)
    low, high = F.least(a, b), F.greatest(a, b)
    work = scratch.write(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(low.alias("a"), high.alias("b")).distinct(),
        "edges",
    )
    labels = work.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = scratch.write(labels.withColumn("component", F.col("node")), "labels")
    while not work.isEmpty():
        hooks = _roots(work.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), scratch)
        ends = work
        for end in ("a", "b"):
            to = hooks.select(F.col("node").alias(end), F.col("root").alias("_root"))
            ends = ends.join(to, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
        work = scratch.write(
            ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
        )
        to = hooks.select(F.col("node").alias("component"), "root")
        labels = scratch.write(
            labels.join(to, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "labels"
        )
    scratch.drop("edges", "hooks")
    return labels


def _roots(hooks: DataFrame, scratch: Scratch) -> DataFrame:
    """Follow ``node`` -> ``root`` until no root hooks further."""
    hooks = scratch.write(hooks, "hooks")
    while True:
        further = hooks.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        if hooks.join(further, "root", "left_semi").isEmpty():
            return hooks
        hooks = scratch.write(
            hooks.join(further, "root", "left").select("node", F.coalesce("_next", "root").alias("root")), "hooks"
        )
