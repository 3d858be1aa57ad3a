"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of ``links`` (a, b) the smallest node it is connected with.

    Every round hangs each node's larger neighbours, then its smaller ones, on
    its smallest neighbour; rounds repeat until the links are stars. Links stay
    in tables in the shared folder; the driver sees one checksum a round.
    """
    links = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while True:
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("hub"), F.lit(0).alias("leaf")).union(links.select("b", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.max("hub").alias("hub"), F.sum("leaf").alias("leaf")).filter("hub + leaf > 1").isEmpty():
            break  # stars: every node hangs on one hub, which hangs on none
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")  # larger neighbours to the least
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        links = written(small.union(least.select(F.col("m").alias("a"), "b")).filter("a <> b").distinct(), "links")
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        links.select("a", "a").distinct())
