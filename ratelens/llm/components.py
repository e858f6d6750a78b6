"""Connected components by label spreading with hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(src, dst)``; root is the smallest node it reaches.

    Each round, a node takes the smallest label among its neighbours, hands it on to the node its old label
    names, and then jumps to its label's label. Labels only fall, and the number of rounds grows with the
    logarithm of the longest chain. A hot node's links are spread by joins that adaptive execution can split,
    and minima combine before they are shuffled. Each round's labels are a stored table, so nothing recomputes
    earlier rounds. Null ends are ignored; an empty table gives an empty result.
    """
    links = links.select("src", "dst").filter("src <> dst")
    both = store(links.union(links.select("dst", "src")).distinct(), "links")
    labels = store(both.groupBy(F.col("src").alias("node")).agg(F.least("node", F.min("dst")).alias("root")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "dst"), "dst")
            .groupBy(F.col("src").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        found = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("near"))
        proposed = found.select("node", "near").union(
            found.filter("near < root").select(F.col("root").alias("node"), "near")
        )
        hooked = store(proposed.groupBy("node").agg(F.min("near").alias("root")), "hooked")
        above = hooked.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = hooked.join(above, "root").select("node", F.least("root", "above").alias("root"))
        before = labels.select("node", F.col("root").alias("before"))
        labels = store(jumped.join(before, "node"), "labels")
        moved = labels.filter("root <> before").limit(1).count()
        labels = labels.select("node", "root")
        if not moved:
            return labels
