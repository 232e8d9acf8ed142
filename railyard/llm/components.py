"""Connected components over written edge tables (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b`` long); the label
    is the smallest node of the component.

    Every round hangs all larger neighbours of a node on its smallest one, and
    then all smaller ones, until nothing moves; that takes about log(nodes)
    rounds. Each round is a written table; two numbers a round reach the
    driver. A hub's edges are joined, not gathered, so Spark can split them.
    """
    e = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(),
        "edges",
    )
    before = None
    while True:
        stat = e.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if stat == before or stat["n"] == 0:
            break
        before = stat
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        e = written(hung.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
