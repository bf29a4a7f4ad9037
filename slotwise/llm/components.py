"""Connected components of links between keys, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b", scratch: list[str] | None = None) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) of every node that has a link.

    Labels spread to neighbours, and each node also takes its label's label, so the rounds grow with the logarithm of
    the longest chain. Every round is written to the shared folder; nothing but a count comes to the driver.
    """
    one, two = F.col(a), F.col(b)
    both = links.select(one.alias("node"), two.alias("other")).unionAll(links.select(two, one))
    edges = stored(both.filter("node != other").distinct(), "edges", scratch)
    labels = stored(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels", scratch)
    while True:
        near = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
            F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        new = stored(lower.join(jump, "label").select(
            "node", F.least("label", "beyond").alias("label"), "old"), "labels", scratch)
        if not new.filter("label != old").count():
            return new.select("node", "label")
        labels = new.select("node", "label")
