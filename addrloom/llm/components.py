"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links`` (``a, b``).

    Large-star and small-star steps in turn until no link changes; each halves the paths, so the number
    of rounds grows with the logarithm of the longest path. Links are kept in the shared folder
    between rounds. Links of a node with itself and repeated links change nothing; nodes without
    links are not in the result.
    """
    edges = materialise(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    state = None
    while True:
        new = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if new == state:
            break
        state = new
        # Large star: neighbours above a node move to the smallest of its neighbours and itself.
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = materialise(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
            "lowest",
        )
        up = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("w"))
            .join(lowest, "u")
            .select(F.col("w").alias("u"), F.col("m").alias("v"))
        )
        edges = materialise(up.where("u <> v").distinct(), "links")
        # Small star: a node and its smaller neighbours move to the smallest of these.
        lowest = materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        joined = edges.join(lowest, "u")
        down = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            lowest.select("u", F.col("m").alias("v"))
        )
        edges = materialise(down.where("u <> v").distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
