"""Connected components of an edge table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) for every id of the long columns ``a, b``.

    Each round hands the smallest label over the edges and then jumps to the label's own label, so long
    chains take a logarithmic number of rounds.  Labels live in stored tables; nothing is collected but a count.
    """
    both = store(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct(),
        "edges",
    )
    labels = store(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        )
        step = labels.join(near, "id").select("id", F.least("component", "m").alias("to"), F.col("component").alias("was"))
        own = labels.select(F.col("id").alias("to"), F.col("component").alias("further"))
        new = store(step.join(own, "to").select("id", F.least("to", "further").alias("component"), "was"), "labels")
        labels = new.select("id", "component")
        if new.filter("component != was").isEmpty():
            return labels
