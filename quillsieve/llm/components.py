"""Connected components of a link table, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillsieve.runtime import materialize


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """``id, component`` for every id in stored ``links``; component is the smallest id that can be reached.

    Each round takes the smallest label among neighbours, then the label of that
    label, so a path of n links takes about log n rounds. Labels are stored after
    every round.
    """
    pairs = links.select(F.col(first).alias("id"), F.col(second).alias("other"))
    both = pairs.unionByName(pairs.select(F.col("other").alias("id"), F.col("id").alias("other")))
    labels = materialize(
        both.groupBy("id").agg(F.least("id", F.min("other")).alias("component")), "labels"
    )
    while True:
        offered = both.join(labels, "id").groupBy(F.col("other").alias("id")).agg(F.min("component").alias("offer"))
        lower = labels.join(offered, "id").select(
            "id", F.col("component").alias("before"), F.least("component", "offer").alias("component")
        )
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("next"))
        after = materialize(
            lower.join(jump, "component").select("id", "before", F.least("component", "next").alias("component")),
            "labels",
        )
        labels = after.select("id", "component")
        if after.where("before <> component").isEmpty():
            return labels
