"""Connected components of a link table by alternating star contraction.

Each round writes its links to the shared scratch folder (no lineage grows,
nothing is collected); a node with very many links is only ever aggregated
(with partial sums) and joined, never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import scratch_path


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``links`` has ``u`` and ``v``; returns ``u, root`` for every node that
    is not its component's smallest node, ``root`` being that node."""
    spark = links.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        return spark.read.parquet(path)

    links = written(links.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _digest(links)
    while before[0]:
        # large star: larger neighbours move to the smallest neighbour
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")) \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large)
        # small star: smaller neighbours and the node move to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter(F.col("v") != F.col("m")) \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _digest(links)
        if after == before:
            break
        before = after
    return links.select("u", F.col("v").alias("root"))
