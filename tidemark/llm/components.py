"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``links`` (a, b); the component is its least node.

    Each step gives a node the least label among its own and its neighbours' and then the label of
    that label, until nothing changes. Links and labels are stored tables, so a node with many
    links is a skewed key of a plain join, which adaptive execution splits. Only a count of
    changes reaches the driver. Links with a null end are left out.
    """
    links = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.distinct(), "links")
    labels = stored(
        edges.groupBy("a")
        .agg(F.min("b").alias("least"))
        .select(F.col("a").alias("node"), F.least("a", "least").alias("component")),
        "labels",
    )
    while True:
        heard = (
            edges.join(labels, edges.a == labels.node)
            .select(F.col("b").alias("node"), "component", F.lit(None).cast("bigint").alias("was"))
        )
        own = labels.select("node", "component", F.col("component").alias("was"))
        lower = stored(
            heard.unionByName(own)
            .groupBy("node")
            .agg(F.min("component").alias("component"), F.max("was").alias("was")),
            "labels",
        )
        target = lower.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        jumped = stored(
            lower.join(target, lower.component == target["_n"]).select(
                "node", F.least("component", "_c").alias("component"), "was"
            ),
            "labels",
        )
        changed = jumped.where("component <> was").limit(1).count()
        labels = jumped.select("node", "component")
        if not changed:
            return labels
