"""Connected components of a link table, in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.session import stage


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's smallest node.

    ``known`` is an earlier result (node, root) whose links are not in ``links``: each of its
    nodes stands linked to its root alone, so the links found before are not read again.

    Each round takes the smallest label among a node's neighbours and then the
    label's own label, so chains shorten by half. Labels are written after each
    round, which ends their lineage; rounds end when no label falls. The groupings
    combine before they shuffle, so a node with very many links is no hot spot.
    """
    links = links.select("a", "b")
    if known is not None:
        links = links.union(known.where("node != root").select("node", "root"))
    pairs = stage(links.union(links.select("b", "a")).distinct(), "components-links")
    labels = stage(
        pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).select(
            "node", F.least("node", "root").alias("root")
        ),
        "components-labels",
    )
    while True:
        heard = (
            pairs.join(labels.select(F.col("node").alias("b"), F.col("root").alias("_near")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("_near").alias("_near"))
        )
        step = labels.join(heard, "node").select(
            "node", F.col("root").alias("_was"), F.least("root", "_near").alias("_root")
        )
        ahead = labels.select(F.col("node").alias("_root"), F.col("root").alias("_next"))
        after = stage(
            step.join(ahead, "_root").select(
                "node", "_was", F.least("_root", "_next").alias("root")
            ),
            "components-labels",
        )
        labels = after.select("node", "root")
        if after.where("root < _was").isEmpty():
            return labels
