"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekeel.llm.shared import stored


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the least of u and its neighbours; the minimum is combined before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down)
    return (
        linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(linked.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def _unfinished(edges: DataFrame) -> int:
    """Vertices that hang on two others or hang on one and hold one; without any, the edges are stars round their least."""
    ends = edges.select(F.col("u").alias("vertex"), F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    counted = ends.groupBy("vertex").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return counted.where("ups > 1 OR ups = 1 AND low = 0").agg(F.count("*")).first()[0]


def connected_components(spark: SparkSession, edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """``(vertex, component)`` for every vertex of the edges ``(u, v)``; a component is named by its least vertex.

    Loops and repeated edges are allowed; without edges the result is empty. The
    number of rounds grows with the logarithm of the largest component, and no
    round brings a vertex's neighbours together in memory. ``tasks`` bounds the
    files of an edge table where the caller knows that so many are enough.
    """

    def kept(frame: DataFrame) -> DataFrame:
        return stored(spark, frame.coalesce(tasks) if tasks else frame, "edges")

    edges = kept(edges.where("u <> v").distinct())
    while _unfinished(edges):
        edges = kept(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    )
