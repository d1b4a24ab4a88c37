"""Landed API responses: documents nested in pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_api_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Response pages, one JSON document per line, read with a given schema."""
    return spark.read.schema(schema).json(path)


def explode_docs(
    pages: DataFrame,
    docs: str = "response.docs",
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    order: Sequence | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document with its ``rank`` in the page.

    ``columns`` prunes the document to the fields a caller asks for, ``where``
    filters on them, ``order`` sorts the result, ``keep`` carries page columns.
    """
    rows = pages.select(*keep, F.posexplode(docs).alias("rank", "_doc"))
    fields = columns or rows.schema["_doc"].dataType.names
    out = rows.select(*keep, "rank", *(F.col(f"_doc.{c}").alias(c) for c in fields))
    if where is not None:
        out = out.where(where)
    return out.orderBy(*order) if order else out
