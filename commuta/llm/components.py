"""Connected components by alternating stars, for graphs that fit no single machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commuta.operators.lineage import cut_lineage


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("least"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """The smallest node of each node's component: ``node``, ``root``, for every node that has a link to another.

    Links are held from the larger node u to the smaller node v. A round first links u to the smallest neighbour of v
    instead of v, then all of u's smaller neighbours to the smallest of them. The number of links never grows, and
    when a round changes nothing each component is a star around its smallest node. A hub meets its minimum, summed
    on the map side, in a join that adaptive execution can split. Rounds are checkpointed; only a count and a checksum
    come to the driver. Null nodes must not occur.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    before = None
    while True:
        links = cut_lineage(links)
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        around = _least(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        near = around.select(F.col("u").alias("v"), F.least("u", "least").alias("least"))
        large = links.join(near, "v").select("u", F.col("least").alias("v")).distinct()
        down = _least(large)
        across = large.join(down, "u").filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        links = across.unionByName(down.withColumnRenamed("least", "v")).distinct()
