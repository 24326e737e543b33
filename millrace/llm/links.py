"""Connected components over tables of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``links`` (a, b): comp is the smallest node reachable.

    Labels spread to neighbours and are then replaced by their own label, so long chains shorten
    by half in a round; minima are taken on the map side, so a hub is no hot spot.  Every round
    is a written table.
    """
    both = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("near"))
        spread = labels.join(near, F.col("a") == F.col("node")).select("node", "comp", F.least("comp", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("comp").alias("far"))
        moved = materialise(
            spread.join(jump, "mid", "left").select("node", F.col("comp").alias("old"), F.least("mid", "far").alias("comp")), "labels"
        )
        labels = moved.select("node", "comp")
        if not moved.filter("old <> comp").limit(1).count():
            return labels
