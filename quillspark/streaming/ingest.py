"""Resumable ingestion: unseen rows only, failed rows retried."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.operators.firstwins import dedup_first, split_errors, unseen
from quillspark.sources.tables import read_if_there


def stream_unseen(
    stream: DataFrame, key: str = "id", event_time: str | None = None, watermark: str | None = None
) -> DataFrame:
    """First arrival of every key.

    Without a watermark the state keeps every key, as a seen set does. With one,
    state is dropped once an event time is past the delay.
    """
    if watermark is None:
        return stream.dropDuplicates([key])
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([key])


def first_of_visits(
    stream: DataFrame, key: str, event_time: str, gap: str, delay: str, carry: list[str] | None = None,
) -> DataFrame:
    """The first row of every visit of a key: (key, first_at, last_at, n, carry…).

    A visit ends when the key has no row for ``gap`` of event time; after that its
    state is dropped and the key is new again. Rows may be up to ``delay`` late;
    a visit is given out when the watermark, the greatest event time less ``delay``,
    has passed its end, and rows older than that are left out (the query's progress
    counts them as ``numRowsDroppedByWatermark``). State holds the open visits only,
    so it is bounded by the keys of the last ``gap`` and ``delay``, not by the
    stream. Visits are merged in the tasks before the shuffle, which also thins a
    hot key. Rows without key are a key of their own; rows without event time are
    left out. ``carry`` columns come from the earliest row, the smallest on ties.
    """
    carry = carry or []
    timed = stream.select(key, F.col(event_time).cast("timestamp").alias("_at"), *carry).where("_at IS NOT NULL")
    first = F.min(F.struct("_at", *carry)).alias("_first")
    visits = (
        timed.withWatermark("_at", delay)
        .groupBy(key, F.session_window("_at", gap).alias("_visit"))
        .agg(first, F.max("_at").alias("last_at"), F.count(F.lit(1)).alias("n"))
    )
    return visits.select(
        key, F.col("_first._at").alias("first_at"), "last_at", "n", *[F.col(f"_first.{c}").alias(c) for c in carry])


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of a checkpoint's run, made on first use and stored beside its offsets.

    Batch numbers restart with every new checkpoint; the run sets their folders apart.
    """
    path = f"{checkpoint.rstrip('/')}/run"
    stored = read_if_there(spark, path, "text")
    if stored is None:
        spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.text(path)
        stored = spark.read.text(path)
    return stored.first()["value"]


def _batches(spark: SparkSession, path: str, run: str, before: int) -> DataFrame | None:
    """Rows of all other runs and of earlier batches; a replayed batch does not see itself."""
    done = read_if_there(spark, path)
    if done is None:
        return None
    return done.where((F.col("run") != run) | (F.col("batch_id") < before))


def _write_batch(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    """A batch owns its folder, so a replay overwrites instead of appending twice."""
    df.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")


def ingest_batch(
    extract: Callable[[DataFrame], DataFrame],
    out: str,
    key: str = "id",
    order: list[str] | None = None,
    run: str = "single",
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body: good rows to ``records``, failed rows to ``errors``.

    ``extract`` adds a nullable ``error`` column. The records are themselves the
    seen set, so record and mark commit together. Failed rows are not marked; they
    are tried again whenever they arrive again.
    """
    records, errors = f"{out}/records", f"{out}/errors"

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = _batches(spark, records, run, batch_id)
        if done is not None:
            fresh = unseen(batch, done, key, order)
        else:
            fresh = dedup_first(batch, [key], order) if order else batch
        if not order:
            fresh = fresh.dropDuplicates([key])
        result = extract(fresh).persist()
        try:
            ok, failed = split_errors(result)
            _write_batch(ok, records, run, batch_id)
            _write_batch(failed, errors, run, batch_id)
        finally:
            result.unpersist()

    return body


def start_ingest(
    stream: DataFrame,
    extract: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    key: str = "id",
    order: list[str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Ingest what is available now, or go on at the pace of ``every`` (as "10 seconds").

    Source offsets and batches resume from the checkpoint. A run with a new
    checkpoint adds to the same output: the records of all runs are the seen set.
    """
    run = run_id(stream.sparkSession, checkpoint)
    pace = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        stream.writeStream.foreachBatch(ingest_batch(extract, out, key, order, run))
        .option("checkpointLocation", checkpoint)
        .trigger(**pace)
        .start()
    )


def pending_retries(spark: SparkSession, out: str, key: str = "id") -> DataFrame | None:
    """Failed rows that no batch of any run has recorded."""
    failed = read_if_there(spark, f"{out}/errors")
    done = read_if_there(spark, f"{out}/records")
    if failed is None or done is None:
        return failed
    return failed.join(done.select(key).distinct(), key, "left_anti")


def retry_failed(
    spark: SparkSession,
    extract: Callable[[DataFrame], DataFrame],
    out: str,
    key: str = "id",
    order: list[str] | None = None,
) -> None:
    """Extract the pending failed rows again, as a run of their own.

    A source that has committed its offsets never delivers them again. The rows
    are those that ``extract`` gave back, without its error.
    """
    pending = pending_retries(spark, out, key)
    if pending is not None:
        again = pending.drop("error", "run", "batch_id")
        ingest_batch(extract, out, key, order, f"retry-{uuid.uuid4().hex}")(again, 0)


def _newest(spark: SparkSession, out: str) -> int:
    known = read_if_there(spark, f"{out.rstrip('/')}/generations")
    return 0 if known is None else known.agg(F.max("generation")).first()[0]


def generation_folders(spark: SparkSession, out: str) -> tuple[str, str]:
    """(output, checkpoint) folders of the newest generation under ``out``; 0 before any reset."""
    at = f"{out.rstrip('/')}/generation={_newest(spark, out)}"
    return f"{at}/data", f"{at}/checkpoint"


def reset_ingest(spark: SparkSession, out: str) -> tuple[str, str]:
    """Forget all progress under ``out``: the folders of a new, empty generation.

    Records, errors, seen keys and offsets all start anew, since they live in those
    folders. Every reader that asks ``generation_folders`` follows; the older
    generations stay to be read or deleted by hand. One caller may reset at a time.
    """
    number = _newest(spark, out) + 1
    spark.range(number, number + 1, numPartitions=1).toDF("generation").write.mode("append").parquet(
        f"{out.rstrip('/')}/generations")
    return generation_folders(spark, out)
