"""Progress lines of a log: parsing, latest state and rises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a progress bar line, e.g. "42%|####      | 420/1000".
PROGRESS = r"(?d)(\d+)%\|.*?\|\s*(\d+)/(\d+)"


def progress_of(line: Column) -> Column:
    """struct(percent, current_step, total_steps, completed), null for other lines."""
    def part(k: int) -> Column:
        return F.regexp_extract(line, PROGRESS, k).try_cast("bigint")

    return F.when(
        part(1).isNotNull(),
        F.struct(
            part(1).alias("percent"),
            part(2).alias("current_step"),
            part(3).alias("total_steps"),
            (part(1) >= 100).alias("completed"),
        ),
    )


def parse_progress(lines: DataFrame, line: str = "value") -> DataFrame:
    """Progress lines with their parsed fields; other lines are dropped."""
    keep = [c for c in lines.columns if c != line]
    return (
        lines.select(*keep, progress_of(F.col(line)).alias("_p"))
        .where(F.col("_p").isNotNull())
        .select(*keep, "_p.*")
    )


def tail_lines(lines: DataFrame, n: int = 20, by: list[str] | None = None) -> DataFrame:
    """Last ``n`` lines, of the whole log or per group."""
    if not by:
        return lines.orderBy(F.desc("line_no")).limit(n)
    # Spark prunes each task to its own top n before the shuffle.
    last = Window.partitionBy(*by).orderBy(F.desc("line_no"))
    return lines.withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= n).drop("_r")


def latest_progress(progress: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The last progress row, of the whole log or per group."""
    fields = ["percent", "current_step", "total_steps", "completed"]
    return progress.groupBy(*(by or [])).agg(
        F.max("line_no").alias("line_no"),
        *(F.max_by(f, "line_no").alias(f) for f in fields),
    )


def first_of_percent(progress: DataFrame, by: list[str]) -> DataFrame:
    """First row of every percent value.

    Only such a row can raise the maximum: at a repeat, an earlier row already
    reached the same value. Copies are combined before the shuffle, so a log that
    holds most of the lines sends a few rows.
    """
    fields = ["current_step", "total_steps", "completed"]
    return progress.groupBy(*by, "percent").agg(
        F.min("line_no").alias("line_no"),
        *(F.min_by(f, "line_no").alias(f) for f in fields),
    )


def progress_increases(
    progress: DataFrame, by: list[str] | None = None, until_complete: bool = True
) -> DataFrame:
    """Rows whose percent exceeds everything before; nothing after completion."""
    by = by or []
    so_far = (
        Window.partitionBy(*by).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.max("percent").over(so_far), F.lit(0))
    risen = first_of_percent(progress, by).withColumn("_before", before)
    rises = risen.where(F.col("percent") > F.col("_before"))
    if until_complete:
        rises = rises.where(F.col("_before") < 100)
    return rises.drop("_before")
