"""Landed pages or files to training JSON lines, without state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quillspark.plans.training import pages_to_training


def stream_training(pages: DataFrame, max_length: int = 1500) -> DataFrame:
    """The batch plan applies unchanged: it has no aggregate and no join."""
    return pages_to_training(pages, max_length)


def start_training(
    pages: DataFrame, out: str, checkpoint: str, max_length: int = 1500
) -> StreamingQuery:
    return (
        stream_training(pages, max_length)
        .writeStream.format("json")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
