"""Connected components by alternating stars, with the edges kept in the shared folder between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shared_path

#: Edges that a file of a round holds about.
EDGES_A_FILE = 1_000_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Move each edge to the least neighbour: of larger neighbours (large star) or of smaller ones (small star).

    The least neighbour is an aggregate and comes back by a join, so the edges of a busy node are never one group's list.
    """
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    if large:
        both = edges.unionByName(back)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node of ``edges`` (u, v: long). Rounds grow with the logarithm of the longest chain.

    Each round's edges are a table in the shared folder; the round before it is deleted when the next one is there.
    """
    spark = edges.sparkSession

    def kept(now: DataFrame, most: int) -> tuple[DataFrame, str]:
        path = shared_path(spark, "edges")
        now.coalesce(1 + most // EDGES_A_FILE).write.parquet(path)
        return spark.read.schema("u long, v long").parquet(path), path

    count = edges.count()
    now, path = kept(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), count)
    mark = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.expr("sum(cast(xxhash64(u, v) AS decimal(38)))").alias("h")).first()
        if state == mark or not state["n"]:
            break
        mark, old = state, path
        now, path = kept(_star(_star(now, True), False).distinct(), state["n"])  # rounds never add edges
        discard(spark, [old])
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
