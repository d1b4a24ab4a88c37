"""File trees and delimited files."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.sources.splits import read_records

TREE_SUFFIXES = (".md", ".txt", ".csv", ".json", ".yaml", ".yml")
FILE_SCHEMA = "repo string, path string, length long, content binary"


def _any_case(suffix: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def _glob(suffixes) -> str:
    return "*{" + ",".join(_any_case(s) for s in suffixes) + "}"


def decode_text(content: Column) -> Column:
    """Bytes as UTF-8 text: broken bytes dropped, line ends unified."""
    text = F.make_valid_utf8(content.cast("string"))
    # A replacement character that the file itself spells out is kept.
    marked = F.when(
        F.is_valid_utf8(content.cast("string")), content.cast("string")
    ).otherwise(F.replace(text, F.lit("�")))
    return F.regexp_replace(marked, r"\r\n?", "\n")


def read_file_tree(
    spark: SparkSession, root: str, suffixes: Sequence[str] | None = TREE_SUFFIXES
) -> DataFrame:
    """(repo, path, length, content) of the files below ``root``.

    The first folder is the repository. ``suffixes`` prunes by name before a file
    is opened; None reads every file, so that skipped ones can be counted. Spark's
    own listing leaves out names that start with ``_`` or ``.``; those files are
    listed and read by tasks of their own.
    """
    root = re.sub(r"^file:/+", "file:///", root)  # Hadoop also writes one slash
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffixes:
        reader = reader.option("pathGlobFilter", _glob(suffixes))
    # file_path is URL-encoded, but for the plus sign.
    full = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    mark = "/" + root.split("://")[-1].strip("/") + "/"
    seen = (
        reader.load(root)
        .withColumn("_rel", F.substr(full, F.instr(full, mark) + len(mark)))
        .where(F.contains("_rel", F.lit("/")))
        .select(
            F.substring_index("_rel", "/", 1).alias("repo"),
            F.regexp_replace("_rel", "^[^/]*/", "").alias("path"),
            "length",
            "content",
        )
    )
    return seen.unionByName(_read_left_out(spark, root, suffixes))


def _left_out(name: str) -> bool:
    """Whether Spark's file listing drops a file or folder of this name."""
    if name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (
        name.startswith("_") and "=" not in name
    )


def _read_left_out(spark: SparkSession, root: str, suffixes: Sequence[str] | None) -> DataFrame:
    """The files that ``binaryFile`` does not list.

    The driver sees only the names of the repositories. Tasks list one repository
    each; the found paths are then spread evenly, whichever repository they are in.
    """
    wanted = tuple(suffixes) if suffixes else None
    # Hadoop's names of a store; the listing library knows it by one.
    uri = re.sub(r"^s3[an]://", "s3://", root) if "://" in root else f"file://{root}"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    system, base = fs.FileSystem.from_uri(uri)
    repos = [
        (f.base_name,)
        for f in system.get_file_info(fs.FileSelector(base))
        if f.type == fs.FileType.Directory
    ]

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, top = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for repo in batch["repo"]:
                below = f"{top.rstrip('/')}/{repo}/"
                rows = [
                    (repo, f.path[len(below):], f.size)
                    for f in files.get_file_info(fs.FileSelector(below, recursive=True))
                    if f.type == fs.FileType.File
                    and (wanted is None or f.path.lower().endswith(wanted))
                    and any(map(_left_out, [repo, *f.path[len(below):].split("/")]))
                ]
                yield pd.DataFrame(rows, columns=["repo", "path", "length"])

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, top = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for row in batch.itertuples(index=False):
                with files.open_input_stream(f"{top.rstrip('/')}/{row.repo}/{row.path}") as f:
                    yield pd.DataFrame([(*row, f.read())], columns=[*batch.columns, "content"])

    names = spark.createDataFrame(repos, "repo string")
    # Explicit counts: rows as small as names would be merged into one task.
    paths = names.repartition(tasks, "repo").mapInPandas(found, "repo string, path string, length long")
    return paths.repartition(tasks, "repo", "path").mapInPandas(opened, FILE_SCHEMA)


def read_text_files(
    spark: SparkSession, root: str, suffixes: Sequence[str] | None = TREE_SUFFIXES
) -> DataFrame:
    """(repo, path, content) with decoded text."""
    return read_file_tree(spark, root, suffixes).select(
        "repo", "path", decode_text(F.col("content")).alias("content")
    )


def quoted_lines(escape: str = "\\", sep: str = ","):
    """The step of delimited text: a line starts a record unless a quoted field is open.

    A quote opens a field only at the field's start; what follows a closing quote
    belongs to the field up to the separator.
    """
    inner = r'(?:[^"]|"")' if escape == '"' else rf'(?:[^"{re.escape(escape)}]|{re.escape(escape)}(?:.|$))'
    closing = re.compile(rf'{inner}*+"[^{re.escape(sep)}]*', re.S)

    def step(first: bool, line: str, state: int) -> tuple[bool, int]:
        starts = state == 0
        if '"' not in line:
            return starts, state
        at, is_open = 0, state == 1
        while True:
            if not is_open:
                if not line.startswith('"', at):
                    at = line.find(sep + '"', at) + 1
                    if not at:
                        return starts, 0
                at, is_open = at + 1, True
            closed = closing.match(line, at)
            if closed is None:
                return starts, 1
            at, is_open = closed.end() + 1, False
            if at > len(line):
                return starts, 0

    return step


def _column_names(header: str, escape: str) -> list[str]:
    double = escape == '"'
    cells = next(csv.reader(
        io.StringIO(header, newline=""), doublequote=double, escapechar=None if double else escape), [])
    lowered = [c.lower() for c in cells]
    return [
        f"_c{i}" if not c else f"{c}{i}" if lowered.count(c.lower()) > 1 else c
        for i, c in enumerate(cells)
    ]


def read_csv(spark: SparkSession, path: str, escape: str = "\\") -> DataFrame:
    """Large delimited files with a header row, read in splits; quoted line breaks allowed.

    All columns are strings. ``escape`` stands before a quote inside a quoted field:
    a backslash, as Spark writes it, or a second quote. Every file's first record is
    its header, the names are those of one of them. Blank lines are no rows, missing
    cells are null, surplus ones are left out; an unquoted empty cell is null, a quoted one empty.
    """
    records = read_records(spark, path, quoted_lines(escape))
    is_header = (F.col("begin") == 0) & (F.col("line") == 0)
    header = records.where(is_header).first()
    names = _column_names(header["text"].removesuffix("\r"), escape) if header else []
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    if not names:
        return spark.createDataFrame([], schema="struct<>")
    # With a character of no text for null, a quoted empty cell stays apart from a missing one.
    options = {"escape": escape, "multiLine": "true", "maxCharsPerColumn": "-1", "nullValue": "\ufffe"}
    text = F.regexp_replace("text", "\r$", "")
    rows = records.where(~is_header).select(text.alias("text")).where(F.col("text") != "")
    cells = rows.select(F.from_csv("text", F.lit(schema), options).alias("c"))
    return cells.select(*(F.col(f"c.c{i}").alias(n) for i, n in enumerate(names)))
