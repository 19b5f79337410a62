"""Connected components of an edge table, by DataFrame joins.

Each round every node takes the least label among itself and its neighbours, and then its label's
label, so chains halve. Labels are written to the shared folder each round; no link leaves the
executors. Nodes with very many links, and labels of very many nodes, are attached without a hot
task (``plan.attach``). A component's label is its least node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .plan import attach, discard, staged


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, label) for every node that an edge names. No edges: no rows."""
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).filter("a is not null and b is not null").distinct(), "edges")
    first = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"), F.count("*").alias("links"))
    labels = staged(first, "labels")
    ends, nodes = (r[0] or 0 for r in (labels.agg(F.sum("links")).first(), labels.agg(F.count("*")).first()))
    while True:
        seen = attach(both, labels.select(F.col("node").alias("b"), F.col("label").alias("next"), "links"), "b", "links", F.xxhash64("a"), ends)
        least = seen.groupBy(F.col("a").alias("node")).agg(F.min("next").alias("least"))
        hooked = labels.join(least, "node").select("node", "links", F.col("label").alias("was"), F.least("label", "least").alias("to"))
        hooked = staged(hooked, "hooked")
        # A label is a node too: its own new label is at most as large.
        held = hooked.groupBy("to").agg(F.count("*").alias("held"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("far")).join(held, "to")
        moved = attach(hooked, jump, "to", "held", F.xxhash64("node"), nodes).select("node", "links", "was", F.least("to", "far").alias("label"))
        moved = staged(moved, "labels")
        discard(labels, hooked)
        changed = not moved.filter("label <> was").isEmpty()
        labels = moved
        if not changed:
            discard(both)
            return labels.select("node", "label")
