"""Connected components of a graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest id of its component.

    Each round points every label at the smallest neighbouring one, follows these pointers to their ends (the length doubles
    with each step) and repoints the edges at the labels found, until no edge joins two labels.
    """
    left, right = F.col(a), F.col(b)
    links = cut(
        edges.select(F.least(left, right).alias("u"), F.greatest(left, right).alias("v")).where("u < v").distinct()
    )
    labels = cut(
        links.select(F.col("u").alias("node")).union(links.select("v")).distinct().select("node", F.col("node").alias("root"))
    )
    while not links.isEmpty():
        # Every current root points to its smallest neighbour, if that is smaller; chains are shortened to their ends.
        up = cut(links.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("to")))
        while True:
            far = up.select(F.col("node").alias("to"), F.col("to").alias("further"))
            shorter = cut(up.join(far, "to", "left").select("node", F.coalesce("further", "to").alias("to"), "further"))
            up = shorter.drop("further")
            if shorter.where("further IS NOT NULL").isEmpty():
                break
        step = up.withColumnRenamed("node", "root")
        labels = cut(labels.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        links = cut(
            links.join(up.select(F.col("node").alias("u"), F.col("to").alias("_u")), "u", "left")
            .join(up.select(F.col("node").alias("v"), F.col("to").alias("_v")), "v", "left")
            .select(F.coalesce("_u", "u").alias("u"), F.coalesce("_v", "v").alias("v"))
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
            .where("u < v")
            .distinct()
        )
    return labels
