"""First-wins results kept as a table that grows by increments.

An increment is written to a folder of its own as changes: ``op`` is ``add`` for a
row that wins its key and ``retract`` for the row it takes the place of. Winners
are minima, so they can be merged in any order, and an increment only compares its
own winners with the keys and orders of the earlier ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.firstwins import dedup_first
from quillspark.sources.tables import read_if_there

ADD, RETRACT = "add", "retract"


def _part(path: str, kind: str, number: int) -> str:
    return f"{path.rstrip('/')}/{kind}/{number}"


def _winning(spark: SparkSession, path: str, keys: list[str], order: list[str], before: int, base: int = -1) -> DataFrame | None:
    """The winner of every key after the increments up to ``before``, from ``base`` on if one is given."""
    parts = [read_if_there(spark, _part(path, "base", base))] if base >= 0 else []
    parts += [read_if_there(spark, _part(path, "increment", k)) for k in range(base + 1, before)]
    parts = [p for p in parts if p is not None]
    if not parts:
        return None
    rows = parts[0].where(F.col("op") == ADD)
    for p in parts[1:]:
        rows = rows.unionByName(p.where(F.col("op") == ADD))
    return dedup_first(rows.drop("op"), keys, order)


def add_increment(
    path: str, new: DataFrame, keys: list[str], order: list[str], number: int, base: int = -1
) -> DataFrame:
    """Take in increment ``number`` (0, 1, …) and return its changes: the columns of ``new`` and ``op``.

    ``order`` must be unique within a key and not null; the least row of a key wins,
    whichever increment brings it. A row that is known already changes nothing. Null
    keys are keys like others. The same number again, as after a lost job, replaces
    its own folder and reads only the increments before it. ``base`` is the number
    that ``compact`` was last run for. A column named ``op`` in ``new`` is an error.
    """
    if "op" in new.columns:
        raise ValueError("a column named op would clash with the kind of a change")
    spark = new.sparkSession
    mine = dedup_first(new, keys, order)
    held = _winning(spark, path, keys, order, number, base)
    columns = new.columns
    if held is None:
        changes = mine.withColumn("op", F.lit(ADD))
    else:
        # Keys and orders decide; of the rows that hold a key now, only those that lose it are needed.
        old = held.select(F.struct(*columns).alias("_old"))
        same = None
        for k in keys:
            equal = F.col(k).eqNullSafe(F.col(f"_old.{k}"))
            same = equal if same is None else same & equal
        met = mine.join(old, same, "left")
        wins = F.col("_old").isNull() | (F.struct(*order) < F.struct(*(F.col(f"_old.{o}") for o in order)))
        added = F.struct(*columns, F.lit(ADD).alias("op"))
        lost = F.struct(*(F.col(f"_old.{c}").alias(c) for c in columns), F.lit(RETRACT).alias("op"))
        both = F.when(F.col("_old").isNull(), F.array(added)).otherwise(F.array(added, lost))
        changes = met.where(wins).select(F.explode(both).alias("c")).select("c.*")
    target = _part(path, "increment", number)
    changes.write.mode("overwrite").parquet(target)
    return spark.read.schema(changes.schema).parquet(target)


def winners(
    spark: SparkSession, path: str, keys: list[str], order: list[str], increments: int, base: int = -1
) -> DataFrame | None:
    """The winner of every key after ``increments`` increments; None before the first."""
    return _winning(spark, path, keys, order, increments, base)


def compact(spark: SparkSession, path: str, keys: list[str], order: list[str], through: int, base: int = -1) -> int:
    """Write the winners after increment ``through`` as one table; its number is the new ``base``.

    The increments stay where they are, so that a reader of the old base goes on.
    """
    rows = _winning(spark, path, keys, order, through + 1, base)
    if rows is None:
        return -1
    rows.withColumn("op", F.lit(ADD)).write.mode("overwrite").parquet(_part(path, "base", through))
    return through


def net_counts(changes: DataFrame, by: str) -> DataFrame:
    """(by, n): winners gained less winners lost; sums over increments are the counts of a full run."""
    gained = F.when(F.col("op") == ADD, F.lit(1)).otherwise(F.lit(-1))
    return changes.groupBy(by).agg(F.sum(gained).alias("n"))
