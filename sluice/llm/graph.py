"""Connected components of a link table by minimum labels and pointer jumping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.shared import written


def components(links: DataFrame, workdir: str, name: str) -> DataFrame:
    """``(node, root)`` of every node of ``links(u, v)``; ``root`` is the smallest node of its component.

    Each round gives a node the least label among itself and its neighbours, then that label's own label
    (pointer jumping), so the number of rounds is logarithmic for chains. Every round is a written table in
    the shared folder; only the count of changed labels reaches the driver.
    """
    both = written(links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
                   workdir, f"{name}-edges")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("root")),
                     workdir, f"{name}-0")
    step = 0
    while True:
        step += 1
        of = labels.select(F.col("node").alias("v"), F.col("root").alias("near"))
        least = (both.join(of, "v").groupBy(F.col("u").alias("node")).agg(F.min("near").alias("near"))
                 .join(labels, "node").select("node", F.col("root").alias("was"), F.least("near", "root").alias("mid")))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        after = written(least.join(jump, "mid", "left")
                        .select("node", "was", F.least("mid", F.coalesce("far", "mid")).alias("root")), workdir, f"{name}-{step}")
        moved = after.filter(F.col("was") != F.col("root")).limit(1).count()
        labels = after.select("node", "root")
        if not moved:
            return labels
