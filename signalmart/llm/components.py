"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join over the edge table. The minima are
reduced before their shuffle, and the join does not share their exchange
(``meet``): adaptive execution splits the edges of a hub (the root of a giant
component has one per member) over many tasks, and none holds a component. The
number of rounds grows with the logarithm of the component size. Every round's
edges are written to the shared folder, which cuts the lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmart.llm.common import stored


def meet(rows: DataFrame, summed: DataFrame, key: str) -> DataFrame:
    """Rows joined with what was summed up of them by the same key. A second
    key that follows from the first makes the join shuffle both sides anew, by
    both keys: on the aggregate's own exchange a hot key's rows would all have
    to stay in one task, and so they can be split."""
    second = F.xxhash64(key)
    return (rows.withColumn("_second", second).join(summed.withColumn("_second", second), ["_second", key])
            .drop("_second"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each neighbour larger than u to the least vertex around u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (meet(both.filter("v > u"), least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = meet(down, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each u has one edge, to a lesser v that is no u: then v is the
    root of its component, and both steps would give the same edges again."""
    up = F.when(F.col("u") > F.col("v"), 1).otherwise(2)
    ends = edges.select(F.col("u").alias("vertex"), up.alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("vertex"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("vertex").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.filter("up > 1 OR up = 1 AND down = 1").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of every vertex of an edge table (u, v); root is the
    least vertex of its component. Loops and repeated edges may occur; an
    empty edge table gives an empty result."""
    now = stored(edges.filter("u <> v").distinct(), "edges")
    while not _stars(now):
        now = stored(_small_star(_large_star(now)), "edges")
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("vertex"), F.col("v").alias("root")))
