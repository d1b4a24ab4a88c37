"""Helpers shared by the operators of this package."""

from __future__ import annotations

import zlib

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.runtime import scratch_path

# The white space that separates words, and ASCII letters.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lowered and nothing else."""
    return F.translate(text, UPPER, LOWER)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written copy.

    The copy survives lost executors and cuts the lineage, so what is read
    twice is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % modulus


def crc_of(doc_id: object) -> int:
    """The driver-side twin of ``crc_remainder``, before the modulus."""
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_bytes(spark: SparkSession, data: bytes, most: int, what: str):
    """Broadcast a model or dictionary whose size is checked."""
    if len(data) > most:
        raise ValueError(f"{what}: {len(data)} bytes, over the bound of {most}")
    return spark.sparkContext.broadcast(data)



_BUILT: dict[tuple, object] = {}


def per_process(kind: str, data: bytes, build):
    """What ``build`` makes of a model, kept in a Python worker between its tasks.

    One object is kept, the last in use: a worker that goes on to the next operator
    gives up what it held for the one before.
    """
    key = (kind, zlib.crc32(data), len(data))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = build(data)
    return _BUILT[key]


def portions(batch, column: int, rows: int = 1024, size: int = 8 << 20):
    """Slices of an Arrow batch of at most ``rows`` rows and about ``size`` bytes of ``column``.

    Work on many texts at once pays; a row longer than ``size`` is a slice by itself.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and (held + n > size or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield batch.slice(start)
