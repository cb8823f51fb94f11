"""Connected components of a link table, by alternating star contraction.

Each round points every node at the least node among its neighbours, first from the larger
side and then from the smaller one. Both steps take a minimum per node (combined before the
shuffle) and join it back, so a node with very many links is never gathered in one task: the
engine splits such join partitions. Every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _with_least(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    return links.join(least, "u")


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long), any direction, repeats and loops allowed -> (node, root):
    one row per node that has a link to another node, root the least node of its component
    (a root's own row included). No links give no rows."""
    stars = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                                 F.least("a", "b").alias("v")).distinct())
    before = None
    while before != (now := _mark(stars)):
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("least", "u").alias("v")).distinct())
        small = _with_least(large)
        stars = written(small.select("u", F.col("least").alias("v")).unionByName(
            small.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")))
            .distinct())
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
