"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours of every node are linked to the smallest of them instead.

    The minimum is a partial aggregate, and a node with very many links meets it in
    an ordinary join, which adaptive execution can split.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, component): the smallest node reachable from each node that has a link.

    ``edges`` has the long columns u and v. Large-star and small-star steps take
    turns until nothing changes, which needs few rounds on a logarithmic scale;
    every node then is linked to the smallest of its component directly.
    """
    now = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    )
    before, state = None, _state(now)
    while state != before:
        now = stored(_star(_star(now, large=True), large=False))
        before, state = state, _state(now)
    members = now.select(F.col("u").alias("v"), F.col("v").alias("component"))
    roots = now.select("v").distinct().withColumn("component", F.col("v"))
    return members.unionByName(roots)
