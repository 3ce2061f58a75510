"""Connected components of an undirected edge table, by contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for each end of an edge ``a, b`` (longs).

    In every round each node joins its smallest neighbour, chains of joins are
    shortened, and the edges are carried over to the joined nodes; the number of
    joined nodes at least halves.  All tables stay in the cluster; a round
    writes its joins and its edges to the shared folder.
    """
    edges = written(edges.select("a", "b").where("a != b").distinct())
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("comp"))
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        choice = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("b"))
        nxt = choice.select(F.col("a").alias("b"), F.col("b").alias("c"))  # a choice is never larger than its node, so chains end
        to = written(choice.join(nxt, "b").select(F.col("a").alias("old"), F.col("c").alias("new")))
        labels = labels.join(to, labels.comp == to.old, "left").select("node", F.coalesce("new", "comp").alias("comp"))
        moved = edges.join(to, edges.a == to.old).select(F.col("new").alias("a"), "b")
        moved = moved.join(to, moved.b == to.old).select("a", F.col("new").alias("b"))
        edges = written(moved.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return written(labels)
