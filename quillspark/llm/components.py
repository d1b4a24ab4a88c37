"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import written


def components(edges: DataFrame, *, jumps: int = 3) -> DataFrame:
    """(v, root): the smallest vertex reachable, for every vertex of (a, b).

    Rounds of contraction: every vertex points to its smallest neighbour, pointers
    are followed ``jumps`` times, and edges move to where their ends point. An
    edge set without edges ends it. Minima are combined before the shuffle, so a
    vertex of any degree is one row per task.
    """
    edges = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while True:
        ends = edges.union(edges.select(F.col("b"), F.col("a")))
        to = ends.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("to"))
        to = written(to, "pointers")
        for _ in range(jumps):
            after = to.select(F.col("v").alias("w"), F.col("to").alias("next"))
            to = to.join(after, F.col("to") == F.col("w")).select("v", F.col("next").alias("to"))
        to = written(to, "pointers")
        labels = to.select("v", F.col("to").alias("root")) if labels is None else (
            labels.join(to.withColumnRenamed("v", "w"), F.col("root") == F.col("w"), "left")
            .select("v", F.coalesce("to", "root").alias("root")))
        labels = written(labels, "labels")
        a, b = (to.select(F.col("v").alias(n), F.col("to").alias(f"{n}2")) for n in ("a", "b"))
        edges = edges.join(a, "a").join(b, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        edges = written(edges.filter("a <> b").distinct(), "edges")
        if edges.isEmpty():
            return labels
