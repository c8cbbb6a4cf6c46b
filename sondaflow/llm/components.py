"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sondaflow.llm.tables import written


def _checksum(links: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (u, v): v is the smallest node that u reaches; nodes that are their own root are left out.

    Links (u, v) are rewired to smaller nodes until nothing changes: every node
    hands its larger neighbours its smallest one, then its smaller ones. Each
    step is a minimum and a join, so a node with very many links never has them
    in one task, and each result is written, so a lost executor costs one step.
    No step makes more links than twice those before it, so its files are as many as they need.
    """
    links = links.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = written(links, "links")
    before, now = None, _checksum(links)
    while now[0] and now != before:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = (both.filter(F.col("v") > F.col("u")).join(lowest, "u")
                  .select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") > F.col("v")).distinct())
        larger = written(larger, "links", 2 * now[0])
        root = larger.groupBy("u").agg(F.min("v").alias("m"))
        links = written(
            larger.join(root, "u").filter(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(root.withColumnRenamed("m", "v")).distinct(), "links", 2 * now[0])
        before, now = now, _checksum(links)
    return links
