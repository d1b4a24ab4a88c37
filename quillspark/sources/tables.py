"""Record, page and training-set readers and writers."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_records(
    spark: SparkSession, path: str, schema: str | StructType, stream: bool = False
) -> DataFrame:
    """JSON-lines records with a given schema; broken lines become null rows."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).option("mode", "PERMISSIVE").json(path)


def write_records(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON-lines records with every key present, non-ASCII text kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_if_there(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None if there is no such path; any other error is raised."""
    try:
        return spark.read.format(kind).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages: (page_id, url, html)."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def write_training(examples: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Training JSON lines; only the text leaves, provenance stays behind."""
    examples.select("text").write.mode(mode).json(path)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose named strings are all non-empty."""
    for c in columns:
        df = df.where(F.length(c) > 0)
    return df


def preview(records: DataFrame, n: int = 3, *order: str) -> DataFrame:
    """A few records as titled lines, the first by ``order``; without it, any."""
    first = records.orderBy(*order) if order else records
    return first.limit(n).select(
        F.format_string(
            "%s (%s)",
            F.coalesce("title", F.lit("No title")),
            F.coalesce("date", F.lit("No date")),
        ).alias("line")
    )
