"""Connected components of a link table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import materialize


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of `links`; root is the smallest node of its component.

    Each round a node takes the smallest label among its own and its
    neighbours', then its label's label; rounds go on until no label changes.
    Labels live in written tables of the shared folder, one for each round."""
    edges = links.select(F.col(left).alias("node"), F.col(right).alias("peer"))
    edges = materialize(edges.unionAll(edges.select(F.col("peer").alias("node"), F.col("node").alias("peer")))
                        .where(F.col("node") != F.col("peer")).distinct(), "edges")
    labels = materialize(edges.groupBy("node").agg(F.min("peer").alias("least"))
                         .select("node", F.least("node", "least").alias("root")), "labels")
    while True:
        seen = (edges.join(labels.withColumnsRenamed({"node": "peer", "root": "peer_root"}), "peer")
                .groupBy("node").agg(F.min("peer_root").alias("near")))
        near = labels.join(seen, "node").select("node", F.least("root", "near").alias("near"), "root")
        jump = labels.select(F.col("node").alias("near"), F.col("root").alias("far"))
        nxt = materialize(near.join(jump, "near", "left").select(
            "node", F.coalesce(F.least("near", "far"), "near").alias("root"), F.col("root").alias("was")), "labels")
        changed = nxt.where(F.col("root") != F.col("was")).limit(1).count()
        labels = nxt.select("node", "root")
        if not changed:
            return labels
