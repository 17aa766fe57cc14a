"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelkit.session import store


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of ``links`` (a long, b long).

    Each round takes the smallest root among a node's neighbours and then the root of that root, so
    the number of rounds grows with the logarithm of the longest chain. Rounds are kept as written
    tables; sums and minima are taken before the shuffles.
    """
    both = links.union(links.select("b", "a")).toDF("node", "other")
    roots = store(both.groupBy("node").agg(F.min("other").alias("root")).select("node", F.least("node", "root").alias("root")), "roots")
    both = store(both.filter("node != other").distinct(), "links")
    while True:
        near = both.join(roots.toDF("other", "far"), "other").groupBy("node").agg(F.min("far").alias("far"))
        step = roots.join(near, "node", "left").select("node", F.least("root", "far").alias("next"), "root")
        jump = roots.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        after = store(step.join(jump, "next", "left").select("node", F.least("next", "beyond").alias("root"), "root").toDF("node", "root", "before"), "roots")
        if after.filter("root != before").isEmpty():
            return after.select("node", "root")
        roots = after.select("node", "root")
