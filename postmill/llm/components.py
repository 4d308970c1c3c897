"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    least = least.select("node", F.least("least", "node").alias("least"))
    larger = both.where("b > a")
    return larger.join(least, larger.a == least.node).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of these."""
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    joined = edges.join(least, edges.a == least.node).where("b != least")
    linked = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    return linked.unionByName(own).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has only that one and no larger neighbour."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
                F.struct(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")),
            )
        ).alias("end")
    ).select("end.*")
    sums = ends.groupBy("node").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
    return not sums.where("down > 1 or (down = 1 and up > 0)").agg(F.count("*")).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint) that has an edge to another;
    the component is its least node.

    Edges may repeat and point either way; nulls and edges of a node to itself are left out.
    Each round writes its edges to the shared folder; only a count reaches the driver. Rounds
    end when every node hangs directly on its least one, after some log(size) of them; edges
    that are such stars already take none. A hub's edges are never gathered: its least
    neighbour is a sum by key, and the join back is one that adaptive execution splits.
    """
    plain = edges.where("a != b").select(
        F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b")
    )
    now = staged(plain.distinct(), "edges")
    while not _settled(now):
        now = staged(_small_star(_large_star(now)), "edges")
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(roots.distinct())
