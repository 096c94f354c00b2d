"""Connected components of links, kept in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``links`` (``a``, ``b``).

    Each round links every neighbour of a node to the smallest node that it knows, first
    from the larger side, then from the smaller one. Nodes drop out of the middle, so long
    chains fold up in a number of rounds that grows with the logarithm of their length. A
    group's hub gathers its members through partial minima, never as one list.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = materialise(pairs, "links")
    for _ in range(most_rounds):
        both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # larger neighbours point to the least node known here
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # smaller neighbours point to the least of them
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        folded = small.unionAll(down.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        folded = materialise(folded, "links")
        # a forest of stars: each node has one link, and no hub has one itself
        once = folded.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        open_nodes = once.filter("n > 1").limit(1).count() or folded.join(
            once.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        pairs = folded
        if not open_nodes:
            break
    else:
        raise RuntimeError(f"links did not fold up in {most_rounds} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
