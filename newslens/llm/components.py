"""Connected components of edge tables, by large and small stars; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm import arrays


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node among itself and its neighbours."""
    around = _both(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, path: str) -> DataFrame:
    """(node, root) for every node that has an edge (u, v); ``root`` is the smallest node of the component.

    Loops and repeated edges do no harm. A hub is reduced by partial aggregation before it moves; only two numbers a round come to the driver.
    """
    now = arrays.written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{path}/0")
    mark, turn = _mark(now), 0
    while mark[0]:
        turn += 1
        now = arrays.written(_small_star(_large_star(now)), f"{path}/{turn}")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    stars = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
