"""Seen-set state: an append-only table of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.sources.tables import read_if_there


def load_seen(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """Distinct ids seen so far; a missing path is an empty set, a wrong key an error."""
    seen = read_if_there(spark, path)
    if seen is None:
        return spark.createDataFrame([], f"{key} string")
    return seen.select(F.col(key).cast("string").alias(key)).distinct()


def save_seen(ids: DataFrame, path: str, key: str = "id", reset: bool = False) -> None:
    """Append ids; ``reset`` starts a new set."""
    ids.select(F.col(key).cast("string").alias(key)).distinct().write.mode(
        "overwrite" if reset else "append"
    ).parquet(path)


def resume_page(completed: DataFrame, page: str = "page") -> DataFrame:
    """One row: the page after the last completed one."""
    return completed.agg((F.coalesce(F.max(page), F.lit(0)) + 1).alias("page"))


def open_ranges(completed: DataFrame, last: int, page: str = "page", first: int = 1, block: int = 1 << 16) -> DataFrame:
    """(first, last) of every stretch of pages from ``first`` to ``last`` that is not completed.

    Unlike ``resume_page`` it also names what was left out when pages were done out
    of order. Repeated, null and outside pages do not count. Islands are found in
    blocks of page numbers; only the ends of blocks are ordered as a whole.
    """
    done = completed.select(F.col(page).cast("long").alias("p")).where(F.col("p").between(first, last)).distinct()
    # Two pages outside close the first and the last stretch.
    ends = completed.sparkSession.createDataFrame([(first - 1,), (last + 1,)], "p long")
    pages = done.union(ends).withColumn("b", F.floor(F.col("p") / block))
    inside = Window.partitionBy("b").orderBy("p")
    gaps = pages.select(F.lag("p").over(inside).alias("before"), "p")
    edges = pages.groupBy("b").agg(F.min("p").alias("p"), F.max("p").alias("most"))
    between = edges.select(F.lag("most").over(Window.orderBy("b")).alias("before"), "p")
    return gaps.union(between).where(F.col("p") > F.col("before") + 1).select(
        (F.col("before") + 1).alias("first"), (F.col("p") - 1).alias("last"))
