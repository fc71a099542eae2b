"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planweave.storage import discard, store


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b) but the roots; the root is the smallest node that can be reached.

    Nodes are of any type that has an order, structs too. Alternates the large-star and small-star steps of Kiveris et
    al. (2014): every step is a grouped minimum and a join, so no node's neighbours are gathered, and the number of
    rounds grows with the logarithm of the longest path. Each round is written to the shared folder, which cuts the
    lineage, and the round before it is removed. Links of a node to itself and null nodes are ignored.
    """
    own, last = store(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"), None
    while True:
        size = own.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if size == last or not size[0]:
            return own.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = size
        both = own.unionAll(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionAll(least.select("u", F.col("m").alias("v")))
        before, own = own, store(small.distinct(), "links")
        discard(before)
