"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node that can be reached) for all ends of ``links`` (src, dst).

    Each round, every node joins the neighbour (or itself) with the smallest
    seeded hash, and links between different nodes go on.  Random hashes take a
    constant share of the nodes each round, also on long chains; a star with any
    number of leaves is gone after two.  Only a count reaches the driver.
    """
    links = links.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    current = written(
        links.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .where("src <> dst")
        .distinct(),
        "links",
    )
    loops = links.where("src = dst").select(F.col("src").alias("node"))
    labels = None
    step = 0
    while not current.isEmpty():
        step += 1
        ends = current.select("src", "dst").union(current.select("dst", "src"))
        near = ends.groupBy("src").agg(F.min(F.struct(F.xxhash64(F.lit(step), "dst").alias("h"), "dst")).alias("near"))
        own = F.struct(F.xxhash64(F.lit(step), "src").alias("h"), F.col("src").alias("dst"))
        joined = written(near.select("src", F.least("near", own)["dst"].alias("to")), "contraction")
        if labels is None:
            labels = joined.select(F.col("src").alias("node"), F.col("to").alias("root"))
        else:
            step_to = joined.select(F.col("src").alias("root"), "to")
            labels = labels.join(step_to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            labels = written(labels, "labels")
        current = written(
            current.join(joined.withColumnRenamed("to", "a"), "src")
            .join(joined.select(F.col("src").alias("dst"), F.col("to").alias("b")), "dst")
            .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
            .where("src <> dst")
            .distinct(),
            "links",
        )
    if labels is None:
        return loops.distinct().select("node", F.col("node").alias("component"))
    smallest = written(labels.groupBy("root").agg(F.min("node").alias("component")), "smallest")
    found = labels.join(smallest, "root").select("node", "component")
    lone = loops.distinct().join(found, "node", "left_anti")
    return found.unionByName(lone.select("node", F.col("node").alias("component")))
