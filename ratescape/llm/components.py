"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescape.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's larger (or smaller) neighbours move to its smallest one. Edges are (a, b) with a > b."""
    if large:
        both = edges.union(edges.select("b", "a"))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    # one row per node on the right, repeated per salt, so that a node with very many neighbours spreads
    salts = 8
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = both.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int"))
    joined = dealt.join(spread, (dealt["a"] == spread["node"]) & (dealt["salt"] == spread["salt"]))
    moved = joined.where("b > a" if large else "b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.union(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return moved.where("a > b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Rounds grow with the logarithm of the longest path; each is written to the
    shared folder, so lineage stays short. Loops and repeated edges do no harm;
    no edges give no rows.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), name)
    mark = None
    while True:
        # all nodes sit right below their component when no node has two smaller neighbours or is itself a centre
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == mark or not state[0]:
            break
        mark = tuple(state)
        current = stored(_star(_star(current, True), False), name)
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(current.select("b", "b").distinct()).distinct()
