"""Text documents that hold many records, and logs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.operators.corpus import HEADER_LINE, RULE, format_entry
from quillspark.operators.ordering import write_in_order
from quillspark.runtime import cut_lineage
from quillspark.sources.splits import read_records


def positioned_text(spark: SparkSession, path: str, sep: str = "\n") -> DataFrame:
    """(file, line_no, value): records of text files with their 0-based position.

    Files are split and read in parallel. A split counts its own records; one small
    table of splits carries the counts forward within each file. The read is
    written once so that both sides see the same splits.
    """
    read = spark.read.option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    placed = cut_lineage(read)
    splits = placed.groupBy("file", "_start").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    earlier = (
        Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = splits.select(
        "file",
        "_start",
        (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return placed.join(offsets, ["file", "_start"]).select(
        "file", (F.col("_id") + F.col("_shift")).alias("line_no"), "value"
    )


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of a log."""
    return positioned_text(spark, path)


def read_separated(spark: SparkSession, path: str, sep: str = RULE) -> DataFrame:
    """One row per block between separators, read in parallel splits."""
    return spark.read.option("lineSep", sep).text(path).select(F.col("value").alias("block"))


def read_corpus_text(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, line, entry) of a text corpus, however large the file is.

    The text is read in pieces that start with ``[`` at a line start. A piece with
    a full header line starts an entry; the others belong to the entry before.
    Text before the first header names no file and is left out. ``begin`` and
    ``line`` give the order of a file's entries.
    """
    header = re.compile(HEADER_LINE.removeprefix("(?d)"))

    def step(first: bool, piece: str, state: int) -> tuple[bool, int]:
        return bool(header.match(f"{piece}\n" if first else f"[{piece}\n")), 0

    entries = read_records(spark, path, step, sep="\n[")
    opened = (F.col("begin") == 0) & (F.col("line") == 0)  # the only piece whose bracket is in it
    whole = F.when(opened, F.col("text")).otherwise(F.concat(F.lit("["), F.col("text")))
    return entries.select("file", "begin", "line", whole.alias("entry"))


def write_corpus_text(entries: DataFrame, path: str) -> None:
    """Header line, body and blank line per entry; one pass, no ordering."""
    entries.select(format_entry(F.col("repo"), F.col("path"), F.col("content"))).write.mode(
        "overwrite"
    ).text(path)


def write_transcripts(rendered: DataFrame, path: str) -> None:
    """(n, text) rows as one ordered document."""
    write_in_order(rendered, "text", ["n"], path)
