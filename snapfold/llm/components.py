"""Connected components of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.staging import staged


def components(links: DataFrame) -> DataFrame:
    """(id, component): for every id in `links` (a, b) the smallest id it is connected with.

    Every round each id takes the smallest label among its neighbours', and then the label
    of its label, which halves the way to go.  Labels live in written tables.
    """
    both = staged(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "links",
    )
    labels = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "id"), "labels")
    while True:
        told = (
            both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("told"))
        )
        nearer = labels.join(told, F.col("id") == F.col("a")).select(
            "id", "component", F.least("component", "told").alias("near")
        )
        of = labels.select(F.col("id").alias("of"), F.col("component").alias("far"))
        after = staged(
            nearer.join(of, F.col("near") == F.col("of"), "left").select(
                "id", F.least("near", F.coalesce("far", "near")).alias("new"), "component"
            ), "labels",
        )
        changed = after.where("new <> component").limit(1).count()
        labels = after.select("id", F.col("new").alias("component"))
        if not changed:
            return labels
