"""Connected components of a graph that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.working import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each node of ``edges`` (two bigint columns) with the smallest node of its component.

    Rounds of contraction: every node points to its smallest neighbour, pointers are
    followed once more, and the edges between different targets are the next, smaller
    graph. Edges and pointers are written in every round; nothing comes to the driver but
    whether edges are left. Null ends and loops are ignored. Returns ``node``, ``label``.
    """
    left = stored(
        edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .filter("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            left.select(F.col("b"), F.col("a"))
        )
        nearest = stored(
            both.groupBy("node").agg(F.least("node", F.min("other")).alias("next")), "nearest"
        )
        onward = nearest.select(F.col("node").alias("next"), F.col("next").alias("label"))
        pointers = stored(nearest.join(onward, "next").select("node", "label"), "pointers")
        rounds.append(pointers)
        for end in ("a", "b"):
            renamed = pointers.select(F.col("node").alias(end), F.col("label").alias("to"))
            left = left.join(renamed, end).drop(end).withColumnRenamed("to", end)
        left = stored(
            left.filter("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct(),
            "edges",
        )
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = rounds[0]
    for later in rounds[1:]:
        onward = later.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = labels.join(onward, "label", "left").select(
            "node", F.coalesce("further", "label").alias("label")
        )
    return stored(labels, "labels")
