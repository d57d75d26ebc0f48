"""Connected components of an undirected graph held in two columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node of the links (a, b).

    Rounds of taking the smallest label among the neighbours and then the label's own
    label, until nothing changes. Labels move as rows; only the number of changes comes to
    the driver. A node with most of the links is one row per task in each round, as the
    minimum is taken before the shuffle. The links are counted first, so
    that rounds over few of them have few tasks; they should be stored."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "links", 2 * links.count())
    rows = both.count()
    labels = stored(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "labels", rows)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("least"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "least").alias("least"))
        jump = labels.select(F.col("node").alias("least"), F.col("label").alias("further"))
        new = stored(step.join(jump, "least").select("node", F.least("least", "further").alias("label"), (F.least("least", "further") != F.col("label")).alias("moved")), "labels", rows)
        labels = new.select("node", "label")
        if not new.filter("moved").limit(1).count():
            return labels
