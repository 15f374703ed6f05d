"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import materialize, scratch


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``); root: smallest node of its component.

    Each round moves every node to the smallest neighbour of its smallest neighbour and contracts the
    graph, so later rounds see only what is left: nodes should be hashes, whose order has no long runs.
    A hub's edges are many rows of one key in joins only, which adaptive execution splits; every grouping
    is summed before it is shuffled.  The rounds' small tables lie in the shared folder and are deleted.
    """
    spark = edges.sparkSession
    with scratch(spark):
        graph = materialize(_oriented(edges))
        layers: list[DataFrame] = []
        while not graph.isEmpty():
            if len(layers) == max_rounds:
                raise RuntimeError("components did not settle")
            ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("up")), F.struct(F.col("b").alias("node"), F.col("b").alias("up")))
            nearest = materialize(graph.select(F.explode(ends).alias("e")).select("e.*").groupBy("node").agg(F.min("up").alias("up")))
            above = nearest.select(F.col("node").alias("_up"), F.col("up").alias("root"))
            layer = materialize(nearest.join(above, F.col("up") == F.col("_up")).select("node", "root"))
            layers.append(layer)
            of_a = layer.select(F.col("node").alias("_a"), F.col("root").alias("to_a"))
            of_b = layer.select(F.col("node").alias("_b"), F.col("root").alias("to_b"))
            moved = graph.join(of_a, F.col("a") == F.col("_a")).join(of_b, F.col("b") == F.col("_b"))
            graph = materialize(_oriented(moved.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))))
        if not layers:
            return spark.createDataFrame([], "node long, root long")
        labels = layers.pop()
        while layers:
            last = labels.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
            labels = layers.pop().join(last, F.col("root") == F.col("_node"), "left").select("node", F.coalesce("_root", "root").alias("root"))
        return materialize(labels, outer=True)
