"""Progress monitor over a stream of log lines, on keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillspark.operators.progress import parse_progress
from quillspark.streaming.ingest import _write_batch, run_id

_FIELDS = "percent long, line_no long, current_step long, total_steps long"
_STEPS = ("percent", "line_no", "current_step", "total_steps")
COMPLETE = 100


def _first_of_percent(by: str):
    """Per Arrow batch the first line of every job and percent: no other line can be a rise."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.sort_values("line_no", kind="stable").drop_duplicates([by, "percent"])

    return run


def _rises(by: str, silence_ms: int | None):
    """Rises of one job; the state is the last rise: percent, line and steps."""
    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        reached = state.get if state.exists else (0, None, None, None)
        out = []
        if state.hasTimedOut:
            out.append((*reached, "silent"))
            state.update(reached)  # without a timer, until the job has a line again
        else:
            # There are many jobs with few lines each: arrays cost a fraction of a data frame's sort.
            held = [[part[c].to_numpy() for c in _STEPS] for part in parts]
            columns = [np.concatenate(c) for c in zip(*held)]
            order = np.argsort(columns[1], kind="stable")
            for row in zip(*(c[order].tolist() for c in columns)):
                if row[0] > reached[0] and reached[0] < COMPLETE:
                    reached = tuple(int(x) for x in row)
                    out.append((*reached, "completed" if reached[0] >= COMPLETE else "progress"))
            state.update(reached)
            if silence_ms is not None and reached[0] < COMPLETE:
                state.setTimeoutDuration(silence_ms)
        if out:
            columns = dict(zip((*_STEPS, "event"), map(list, zip(*out))))
            yield pd.DataFrame({by: [key[0]] * len(out), **columns, "completed": [e == "completed" for e in columns["event"]]})

    return run


def progress_events(lines: DataFrame, *, by: str = "job", silence_ms: int | None = None) -> DataFrame:
    """Rises of the (job, line_no, value) lines of a stream, and what became of the job.

    A row per line whose percent exceeds all before it, in this and every earlier
    micro-batch, until a job has reached 100: ``event`` is ``progress`` or, at 100
    and above, ``completed``. With ``silence_ms`` an unfinished job without a
    progress line for so long gives one row ``silent``, with its last rise (null
    steps and percent 0 if it had none). State is one row per job; it is all that
    a batch reads of the past. A batch's lines are reduced to the first per job
    and percent before they are shuffled, so a job that writes most of the log
    sends a few. Lines that are no progress are passed over; a null job is a job
    of its own.
    """
    kind = lines.schema[by].dataType.simpleString()
    parsed = parse_progress(lines.select(by, "line_no", "value"))
    first = parsed.mapInPandas(_first_of_percent(by), parsed.schema)
    timeout = GroupStateTimeout.NoTimeout if silence_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return first.groupBy(by).applyInPandasWithState(
        _rises(by, silence_ms), f"`{by}` {kind}, {_FIELDS}, event string, completed boolean", _FIELDS, "append", timeout)


def start_progress(
    lines: DataFrame, out: str, checkpoint: str, by: str = "job", *, every: str | None = None,
    silence_ms: int | None = None,
) -> StreamingQuery:
    """Write ``progress_events`` of a stream below ``out``, a folder per micro-batch.

    The greatest percent per job lives in the state store under ``checkpoint``, so
    a query that is started again goes on where it ended, and no earlier output is
    read. A replayed batch overwrites its own folder. Without ``every`` the query
    ends when it has read what is there; with it (a processing-time interval such
    as ``30 seconds``) it goes on, which timers need. The rows have no ``event``
    column unless ``silence_ms`` is given.
    """
    run = run_id(lines.sparkSession, checkpoint)
    events = progress_events(lines, by=by, silence_ms=silence_ms)
    if silence_ms is None:
        events = events.drop("event")
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        events.writeStream.foreachBatch(lambda batch, batch_id: _write_batch(batch, out, run, batch_id))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
