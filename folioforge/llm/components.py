"""Connected components of verified links, and cells that share out large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import stage


def components(edges: DataFrame) -> DataFrame:
    """One row (node, root) for every node of ``edges`` (a, b); equal roots are connected.

    Each round hangs every node below its neighbour of least hash and replaces the ends of
    the edges by their parents. Hashes put the nodes in random order, so the graph shrinks by
    a constant factor a round, also for long chains. The parents are a map-side minimum: a
    node with very many links costs one row a task. Null ends and loops are left out; the
    root is some node of the component, not its smallest.
    """
    edges = stage(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    order = lambda c: F.struct(F.xxhash64(F.lit("order"), c).alias("h"), c.alias("node"))
    labels = None
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stage(
            ends.groupBy(F.col("a").alias("node")).agg(F.min(order(F.col("b"))).alias("m"))
            .select("node", F.least("m", order(F.col("node")))["node"].alias("parent")), "parents")
        of = lambda end: parents.select(F.col("node").alias(end), F.col("parent").alias(f"p{end}"))  # noqa: E731,B023
        edges = stage(
            edges.join(of("a"), "a").join(of("b"), "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        step = parents.withColumnRenamed("parent", "root")
        if labels is None:
            labels = step
        else:
            up = parents.select(F.col("node").alias("root"), "parent")
            labels = stage(
                labels.join(up, "root", "left").select("node", F.coalesce("parent", "root").alias("root")),
                "labels")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def cells(rows: DataFrame, size: str, member: str, block: int) -> DataFrame:
    """Deal each group's rows to cells (lo, hi) so that any two members share a cell.

    ``size`` is the group's row count. A member goes to block ``part`` of about ``block``
    members, by hash, and is sent to the cells of that block with each other one; a cell
    holds at most about two blocks whatever the size of the group.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col(size) / F.lit(block)).cast("int"))
    return (
        rows.withColumn("_n", parts)
        .withColumn("part", F.pmod(F.xxhash64(F.lit("part"), F.col(member)), F.col("_n")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .withColumn("lo", F.least("part", "_other")).withColumn("hi", F.greatest("part", "_other"))
        .drop("_n", "_other")
    )
