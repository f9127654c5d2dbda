"""Connected components of a graph given as rows of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerweave.sources.shared import write_through


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every linked node with the smallest node it can reach.

    Each round hooks every node to its smallest neighbour, follows two hooks and
    contracts the links, so a round at least halves the linked nodes of each part
    and the rounds grow with the logarithm of the longest path.  A hub with any
    number of neighbours is only ever aggregated or joined, never gathered.  Links
    with a null end and links to oneself are ignored; without links there are no rows.
    """
    def contracted(x, left, right):
        least, most = F.least(left, right), F.greatest(left, right)
        return x.select(least.alias("a"), most.alias("b")).where("a < b").distinct()

    edges = write_through(contracted(links, F.col(a), F.col(b)))
    nodes = None
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        second = hooks.select(F.col("node").alias("up"), F.col("up").alias("over"))
        hooks = write_through(hooks.join(second, "up", "left")
                              .select("node", F.coalesce("over", "up").alias("up")))
        if nodes is None:
            nodes = (edges.select(F.col("a").alias("node"))
                     .union(edges.select(F.col("b").alias("node"))).distinct()
                     .select("node", F.col("node").alias("component")))
        nodes = write_through(_moved(nodes, "component", hooks))
        edges = write_through(contracted(_moved(_moved(edges, "a", hooks), "b", hooks),
                                         F.col("a"), F.col("b")))
    if nodes is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes


def _moved(rows: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    named = hooks.select(F.col("node").alias(column), "up")
    return (rows.join(named, column, "left")
            .withColumn(column, F.coalesce("up", column)).select(rows.columns))
