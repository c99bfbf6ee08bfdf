"""Connected components of an undirected graph, as rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabgrad.sources.store import discard, materialize, scratch_path


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (``a``, ``b``: bigint); the least node names it.

    Each round draws new priorities, a seeded hash of the node; every component moves to its neighbour
    of the least priority, twice, and the edges between components are rewritten. Edges inside a
    component vanish. In a random order about a third of the nodes are least among their neighbours,
    whatever the shape of the graph, so chains as well as stars shrink by a constant factor a round.

    Every round is written to the shared folder, which cuts the lineage and survives lost executors;
    what it replaces is deleted. Aggregates combine map-side, and joins are plain ones that adaptive
    execution can split, so a node with any number of edges is not one task. The driver sees only
    whether edges are left.
    """
    spark = edges.sparkSession

    def write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, name)
        return materialize(df, path=path), path

    links, links_path = write(edges.filter("a <> b").select("a", "b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels, labels_path = write(nodes.withColumn("component", F.col("node")), "labels")
    step = 0
    while not links.isEmpty():

        def ranked(node: str):
            return F.struct(F.xxhash64(node, F.lit(step)).alias("priority"), F.col(node).alias("node"))

        both = links.union(links.select("b", "a"))
        best = both.groupBy("a").agg(F.min(ranked("b")).alias("best"))
        best = best.select(F.col("a").alias("component"), F.least(ranked("a"), "best")["node"].alias("to"))
        least, least_path = write(best, "least")
        onward = least.select(F.col("component").alias("to"), F.col("to").alias("further"))
        moves, moves_path = write(
            least.join(onward, "to", "left").select("component", F.coalesce("further", "to").alias("to")), "moves"
        )
        moved = labels.join(moves, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels, new_labels_path = write(moved, "labels")
        a = moves.select(F.col("component").alias("a"), F.col("to").alias("x"))
        b = moves.select(F.col("component").alias("b"), F.col("to").alias("y"))
        rest = links.join(a, "a").join(b, "b").filter("x <> y")
        rest = rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        links, new_links_path = write(rest, "links")
        for path in (least_path, moves_path, labels_path, links_path):
            discard(spark, path)
        labels_path, links_path = new_labels_path, new_links_path
        step += 1
    discard(spark, links_path)
    names = labels.groupBy("component").agg(F.min("node").alias("least"))
    return labels.join(names, "component").select("node", F.col("least").alias("component"))
