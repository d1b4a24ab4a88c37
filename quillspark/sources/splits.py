"""Records of large text files that reach over lines and over splits.

A split is scanned on its own, once for every state it may begin in. A prefix over
the small table of splits then gives each its true state and the record it begins
inside, and a second scan cuts the text. Only the pieces at the borders of splits
are brought together; no other text is shuffled, sorted or written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.runtime import scratch_path

# (whether it is the file's first line, the line, the state before it) to (whether a record starts, the state after it).
Step = Callable[[bool, str, int], tuple[bool, int]]

_SUMMARY = "file string, begin long, after0 int, last0 long, after1 int, last1 long"
_PIECES = "file string, begin long, line long, part long, whole boolean, text string"


PORTION_BYTES = 1 << 20


def _portions(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of about a megabyte of text, at least a row each.

    Spark's batches have a fixed number of rows, so their bytes grow with the length of
    records; only a slice is turned into Python strings at a time.
    """
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    start = done = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, done + PORTION_BYTES, side="right")))
        yield batch.slice(start, end - start)
        start, done = end, int(ends[end - 1])


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    return spark.read.option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("begin"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


def _summaries(lines: DataFrame, step: Step) -> DataFrame:
    """A row per split: for each state it may begin in, the state after it and its last start."""
    def scan(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, rows = None, []
        for batch in (part for whole in stream for part in _portions(whole, 2)):
            for file, begin, value in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if (file, begin) != split:
                    split, n = (file, begin), 0
                    states, last = [0, 1], [None, None]
                    rows.append((split, states, last))
                first = begin == 0 and n == 0
                for k in (0, 1):
                    starts, states[k] = step(first, value, states[k])
                    if starts:
                        last[k] = n
                n += 1
        yield pa.RecordBatch.from_pylist(
            [
                {"file": f, "begin": b, "after0": s[0], "last0": l[0], "after1": s[1], "last1": l[1]}
                for (f, b), s, l in rows
            ],
            pa.schema([("file", pa.string()), ("begin", pa.int64()), ("after0", pa.int32()), ("last0", pa.int64()),
                       ("after1", pa.int32()), ("last1", pa.int64())]),
        )

    return lines.select("file", "begin", "value").mapInArrow(scan, _SUMMARY)


def _carried(summaries: DataFrame) -> DataFrame:
    """(file, begin, state, owner): how each split begins, by a prefix over the splits of a file."""
    earlier = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    settles = F.col("after0") == F.col("after1")  # the split ends alike however it began
    swaps = (F.col("after0") > F.col("after1")).cast("int")
    known = summaries.withColumn("swaps", F.coalesce(F.sum(swaps).over(earlier), F.lit(0))).withColumn(
        "settled", F.last(F.when(settles, F.struct("after0", "swaps")), ignorenulls=True).over(earlier))
    since = F.col("swaps") - F.coalesce("settled.swaps", F.lit(0))
    state = F.pmod(F.coalesce("settled.after0", F.lit(0)) + since, F.lit(2)).cast("int")
    last = F.when(F.col("state") == 0, F.col("last0")).otherwise(F.col("last1"))
    start = F.when(last.isNotNull(), F.struct("begin", last.alias("line")))
    return known.withColumn("state", state).select(
        "file", "begin", "state", F.last(start, ignorenulls=True).over(earlier).alias("owner"))


def read_records(
    spark: SparkSession, path: str, step: Step, sep: str = "\n", most_broadcast: int = 200_000
) -> DataFrame:
    """(file, begin, line, text): the records of text files, each with the place it starts at.

    ``step(first, line, state)`` says whether a line starts a record, and the state
    (0 or 1) after it; ``first`` marks the first line of a file, which begins in state
    0. Lines of a record are joined by ``sep``; lines before a file's first record are
    left out. ``begin`` is the split's offset, ``line`` the number within the split.

    A task holds one batch of lines and, as Python strings, about a megabyte of it and one record; a record over many splits comes together as
    one row, since it is one. Up to ``most_broadcast`` splits, the row per split goes
    to every task; beyond, lines are joined with it by split. A file that changes
    between the two scans ends the job.
    """
    lines, carried = _lines(spark, path, sep), scratch_path(spark, "splits")
    _carried(_summaries(lines, step)).write.parquet(carried)
    splits = spark.read.parquet(carried)
    small = splits.count() <= most_broadcast
    joined = lines.join(F.broadcast(splits) if small else splits, ["file", "begin"], "left")
    if not small:  # a shuffled join loses the order of lines
        joined = joined.sortWithinPartitions("id")
    # A split that the first scan has not seen has no state.
    checked = F.coalesce("state", F.raise_error(F.lit("a file changed while it was read")).cast("int"))
    joined = joined.select(
        "file", "begin", "value", checked.alias("state"),
        F.col("owner.begin").alias("owner_begin"), F.col("owner.line").alias("owner_line"))

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = record = None
        held: list[str] = []

        def piece(whole: bool) -> list[tuple]:
            # Whole records start and end in this split; others wait for their neighbours.
            if not held or record[0] is None:
                return []
            return [(split[0], *record, split[1], whole, sep.join(held))]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "begin", "line", "part", "whole", "text"])

        for batch in (part for whole in stream for part in _portions(whole, 2)):
            out = []
            for file, begin, value, given, *owner in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, begin) != split:
                    out += piece(False)
                    split, n, state, record, held = (file, begin), 0, given, tuple(owner), []
                starts, state = step(begin == 0 and n == 0, value, state)
                if starts:
                    out += piece(record is not None and record[0] == split[1])
                    record, held = (begin, n), []
                held.append(value)
                n += 1
            yield table(out)
        yield table(piece(False))

    pieces = joined.mapInArrow(cut, _PIECES)
    parts = F.array_sort(F.collect_list(F.struct("part", "text")))
    at_borders = pieces.where(~F.col("whole")).groupBy("file", "begin", "line").agg(parts.alias("parts")).select(
        "file", "begin", "line", F.array_join(F.transform("parts", lambda p: p["text"]), sep).alias("text"))
    return pieces.where("whole").select("file", "begin", "line", "text").unionByName(at_borders)
