"""Orders over whole datasets without a one-task window."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.runtime import cut_lineage

_IN_PARTITION = (1 << 33) - 1


def number_and_count(df: DataFrame, order: list, name: str = "n") -> tuple[DataFrame, int]:
    """``number_rows`` and the number of rows.

    Only the partition sizes reach the driver: one number per partition.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright(F.col("_slot"), 33).cast("int")
    sizes = dict(placed.groupBy(part.alias("_part")).count().collect())
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    offsets = F.from_json(F.lit(json.dumps(before)), "array<bigint>")
    number = F.get(offsets, part) + F.col("_slot").bitwiseAND(F.lit(_IN_PARTITION)) + 1
    return placed.withColumn(name, number).drop("_slot"), total


def number_rows(df: DataFrame, order: list, name: str = "n") -> DataFrame:
    """Number rows 1, 2, … in the total order ``order``.

    Rows are range-partitioned and sorted inside partitions; the result is written
    once, so that numbers and partition sizes come from the same copy. ``order``
    should end with a unique column, which also splits long runs of equal keys.
    """
    return number_and_count(df, order, name)[0]


def number_by(df: DataFrame, order: list[str], tie: str, name: str = "n") -> DataFrame:
    """``number_rows`` for rows with large columns: only ``order`` and ``tie`` are sorted.

    ``tie`` is unique, nulls included, and brings the numbers back to the rows. They
    are sent to all tasks where they are small, and the large columns then stay where they are.
    """
    keys = dict.fromkeys([*order, tie])
    numbered = number_rows(df.select(*keys), [*order, tie], name)
    numbers = numbered.select(F.col(tie).alias("_tie"), name)
    return df.join(numbers, F.col(tie).eqNullSafe(F.col("_tie"))).drop("_tie")


def running_max(
    df: DataFrame,
    value: Column,
    order: str,
    by: list[str],
    name: str,
    block_rows: int = 1 << 20,
) -> DataFrame:
    """Maximum of ``value`` over this and all earlier rows of the same ``by`` group.

    ``order`` is a distinct integer per row. Each group is cut into blocks of at
    most ``block_rows`` positions: block maxima are aggregated first, then carried
    forward, so no group is sorted in one task.
    """
    cut = df.withColumn("_value", value).withColumn(
        "_block", F.floor(F.col(order) / F.lit(block_rows))
    )
    ahead = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*by, "_block")
        .agg(F.max("_value").alias("_max"))
        .select(*by, "_block", F.max("_max").over(ahead).alias("_carry"))
    )
    inside = (
        Window.partitionBy(*by, "_block")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        cut.join(carried, [*by, "_block"])
        .withColumn(name, F.greatest("_carry", F.max("_value").over(inside)))
        .drop("_value", "_block", "_carry")
    )


def limit_first(df: DataFrame, n: int | None, *order) -> DataFrame:
    """First ``n`` rows in a total order; all rows when ``n`` is None."""
    return df if n is None else df.orderBy(*order).limit(n)


def write_in_order(df: DataFrame, line: str, order: list, path: str, sep: str = "\n") -> None:
    """Write one text column so that the part files, read by name, are in order."""
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(line)
        .write.mode("overwrite")
        .option("lineSep", sep)
        .text(path)
    )
