"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import materialize, small


def components(edges: DataFrame) -> DataFrame:
    """The smallest node each node can reach: ``node, root``.

    ``edges`` has ``a`` and ``b`` of one orderable type.  Nodes without an edge to
    another node are not returned.  Each step takes the least neighbour by a
    partial aggregate and joins it back, so a node with very many edges is
    spread over tasks; each round is written to the shared folder.  Ends when a
    round changes no edge: every node then hangs on its root.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1)))).first())

    # b is the smaller end
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "edges")
    before = state(edges)
    while before[0]:
        # large star: link the larger neighbours of a node to its least neighbour or itself
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = small(materialize(least, "least"))  # apart from the rows it is joined to, so that a hot node's can be split
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: link the smaller neighbours of a node, and itself, to the least of them
        large = materialize(large, "edges")
        least = small(materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least"))
        star = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialize(star.select("e.*").where("a <> b").distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
