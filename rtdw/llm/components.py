"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.common import stored


def _by_node(edges: DataFrame) -> DataFrame:
    """Edges once per (u, v), with ``m``, the least ``v`` of each ``u``: one exchange; the
    ordered window reads a node's neighbours as a sorted stream."""
    ordered = Window.partitionBy("u").orderBy("v")
    return edges.select("u", "v", F.first("v").over(ordered).alias("m"), F.lag("v").over(ordered).alias("last")).where(
        "last IS NULL OR last <> v")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
    return _by_node(both.select("e.u", "e.v")).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(down: DataFrame) -> DataFrame:
    """``down``: every edge leads from its greater to its lesser end."""
    return _by_node(down).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with an edge to another node; the
    component is its least node. Every round is a stored table."""
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    mark = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = None
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        after = mark(now)
        if not after[0] or after == before:
            break
        before = after
    # now every edge leads from a node to its component's least node
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
