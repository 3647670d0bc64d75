"""Connected components of an edge table, by alternating large and small stars.

Every round replaces the edges of each node by edges to the smallest node it knows. The smallest
is an aggregate with a map-side part and is joined back, so a node with a third of all edges is
never gathered. Each round is written to the shared folder, which ends its lineage there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordflow.llm.common import written
from recordflow.operators.joins import same_key


def _stars(both: DataFrame) -> DataFrame:
    """``u, v, m``: each edge with the smallest of its first node and that node's neighbours."""
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
    return both.join(least, same_key(both["u"], least["w"])).select("u", "v", "m")


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node point to the smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest one."""
    stars = _stars(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    return stars.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(stars.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: every node of `edges` (two columns) and the smallest node of its component."""
    edges = edges.toDF("u", "v").filter("u <> v").distinct()
    edges = written(edges, "edges")
    state = _state(edges)
    while state[0]:
        edges = written(_small(_large(edges)).filter("u <> v").distinct(), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
