"""First-wins deduplication, seen-set filters and the counts reported with them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import ratio_text


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key in ``order``, which must be unique within a key.

    An aggregate rather than a window: copies are combined before the shuffle, so
    a key that holds a large share of the rows sends one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    if not rest:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``dedup_first`` for rows with large columns: the winners' keys and orders pick them.

    The aggregate sees ``keys`` and ``order`` only; the rows are read a second time and
    meet the winners in a semi-join, sent to all tasks where they are small. A hot key
    is spread by its orders. ``order`` must be unique within a key, nulls included.
    """
    if not set(df.columns) - {*keys, *order}:
        return dedup_first(df, keys, order)
    winners = dedup_first(df.select(*dict.fromkeys([*keys, *order])), keys, order)
    return _matching(df, winners)


def unseen_rows(
    new: DataFrame, seen: DataFrame, key: str, order: list[str]
) -> DataFrame:
    """``unseen`` with ``order``, for rows with large columns: only keys and orders are aggregated."""
    narrow = new.select(*dict.fromkeys([key, *order]))
    return _matching(new, unseen(narrow, seen, key, order))


def _matching(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of ``df`` that agree with a row of ``chosen`` in all its columns, null being a value."""
    names = {c: f"_chosen_{i}" for i, c in enumerate(chosen.columns)}
    right = chosen.withColumnsRenamed(names)
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return df.join(right, reduce(and_, same), "left_semi")


def unseen(
    new: DataFrame, seen: DataFrame, key: str = "id", order: list[str] | None = None
) -> DataFrame:
    """Rows whose key is not in the seen set.

    With ``order``, repeats inside the batch are dropped first (first wins), so the
    join sees one row per key. The join key is carried as a value of that
    aggregate: on the grouping key itself the join would be moved below it.
    """
    candidates = new
    if order:
        candidates = dedup_first(new.withColumn("_k", F.col(key)), ["_k"], order).drop("_k")
    return candidates.join(seen.select(key).distinct(), key, "left_anti").select(*new.columns)


def seen_only(new: DataFrame, seen: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is in the seen set."""
    return new.join(seen.select(key).distinct(), key, "left_semi")


def first_by_query(
    results: DataFrame, key: str = "id", query: str = "query",
    order: tuple[str, ...] = ("query_pos", "page", "rank"),
) -> DataFrame:
    """One row per item, attributed to the first query that returned it."""
    return dedup_first(results, [key], list(order))


def query_stats(
    results: DataFrame, key: str = "id", query: str = "query",
    order: tuple[str, ...] = ("query_pos", "page", "rank"),
) -> DataFrame:
    """Per query: rows found, and items that no earlier result had."""
    narrow = results.select(key, query, *order)
    winners = first_by_query(narrow, key, query, order)
    found = narrow.groupBy(query).agg(F.count(F.lit(1)).alias("total_found"))
    new = winners.groupBy(query).agg(F.count(F.lit(1)).alias("new_repos"))
    return found.join(new, query, "left").select(
        query, "total_found", F.coalesce("new_repos", F.lit(0)).alias("new_repos")
    )


def search_stats(
    per_query: DataFrame, query: str = "query", timestamp: str | None = None
) -> DataFrame:
    """One row: the per-query counts as a map, totals and the deduplication ratio.

    Works on ``query_stats`` output, so it never sees more rows than queries.
    """
    entry = F.struct(F.col(query), F.struct("total_found", "new_repos"))
    stamp = F.lit(timestamp) if timestamp else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"
    )
    totals = per_query.agg(
        F.map_from_entries(F.collect_list(entry)).alias("queries"),
        F.coalesce(F.sum("total_found"), F.lit(0)).alias("total_found"),
        F.coalesce(F.sum("new_repos"), F.lit(0)).alias("unique_repos"),
    )
    return totals.select(
        stamp.alias("timestamp"),
        "queries",
        "total_found",
        "unique_repos",
        ratio_text(F.col("unique_repos"), F.col("total_found")).alias("deduplication_ratio"),
    )


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rows with one)."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def dead_letters(failed: DataFrame, key: str = "id", timestamp: str | None = None) -> DataFrame:
    """Error rows as (ts, id, error) and the log line form."""
    stamp = F.lit(timestamp) if timestamp else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"
    )
    ident = F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit("unknown"))
    return failed.select(stamp.alias("ts"), ident.alias("id"), F.col("error")).withColumn(
        "line", F.concat_ws(" | ", "ts", "id", "error")
    )
