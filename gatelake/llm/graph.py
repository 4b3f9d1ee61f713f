"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelake.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every end of an edge of ``edges(a, b)``; ``root`` is the smallest node reachable.

    Each round points every node at the smallest neighbour seen so far and lets
    larger neighbours follow, so paths shrink by a constant factor. Rounds are
    written to the shared folder; the loop ends when a round changes nothing.
    Null ends and self-loops are ignored; an empty table has no components.
    """
    cur = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    cur, mark = _kept(cur)
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt, new = _kept(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        if new == mark:
            roots = nxt.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
            return nxt.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        cur, mark = nxt, new


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    table = materialize(edges, "edges")
    seen = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return table, tuple(seen)
