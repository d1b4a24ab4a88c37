"""Sample packing by a histogram of lengths.

Only lengths decide which rows share a sample, and there are at most ``capacity``
different ones. The plan is made over their counts: best fit, longest first, with
equal samples kept as one pattern and a number of times. A row finds its place by
its rank among the rows of its length, so ids may be anything.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.ordering import number_rows

# (n_tokens, first rank, rank after the last, first sample, rows in a sample, start in the sample)
PLAN = "n_tokens long, a long, b long, base long, k long, at long"


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """The segments of ranks of each length from 1 to ``capacity``, and the number of samples.

    Steps go over lengths and patterns, not rows: a step places as many rows of one
    length as there are equal samples with the least room that fits them.
    """
    # Open patterns by the room left: (times, ((length, rows, first rank), ...)).
    by_room: dict[int, list[tuple[int, list]]] = {}
    rooms: list[int] = []

    def put(room: int, times: int, pattern: list) -> None:
        if room not in by_room:
            by_room[room] = []
            heapq.heappush(rooms, room)
        by_room[room].append((times, pattern))

    done: list[tuple[int, list]] = []
    for length in sorted((n for n in counts if 1 <= n <= capacity), reverse=True):
        left, rank, tight = counts[length], 0, []
        while left and rooms:
            room = rooms[0]
            if not by_room[room]:
                del by_room[heapq.heappop(rooms)]
                continue
            if room < length:  # for shorter rows
                tight.append(heapq.heappop(rooms))
                continue
            times, pattern = by_room[room].pop()
            rows = min(room // length, left)
            now = min(times, left // rows)
            if now < times:  # the other samples have the later ranks
                by_room[room].append((times - now, [(n, k, first + now * k) for n, k, first in pattern]))
            put(room - rows * length, now, [*pattern, (length, rows, rank)])
            left, rank = left - now * rows, rank + now * rows
        for room in tight:
            heapq.heappush(rooms, room)
        rows = capacity // length
        if left >= rows:
            put(capacity - rows * length, left // rows, [(length, rows, rank)])
            rank, left = rank + left // rows * rows, left % rows
        if left:
            put(capacity - left * length, 1, [(length, left, rank)])
    for room in sorted(by_room):
        done += by_room[room]
    segments, base = [], 0
    for times, pattern in done:
        at = 0
        for length, rows, rank in pattern:
            segments.append((length, rank, rank + times * rows, base, rows, at))
            at += rows * length
        base += times
    return segments, base


def pack_by_length(lengths: DataFrame, capacity: int = 2048, *, id: str = "id", n_tokens: str = "n_tokens") -> DataFrame:
    """(sample, id, n_tokens, start): every row's sample of ``capacity`` tokens and place in it.

    Samples are numbered from 0. A row above the capacity has a sample of its own,
    after the others; rows without tokens (null or below one) take no room and have
    a null sample. Repeated ids are rows each; other columns are ignored; texts are
    joined back by id. The driver gets one count per length up to the capacity.
    Rows of a length are ranked over range partitions, so a length that most rows
    have is spread over all tasks.
    """
    spark = lengths.sparkSession
    rows = lengths.select(F.col(id).alias("id"), F.col(n_tokens).cast("long").alias("n_tokens"))
    kind = F.when(F.col("n_tokens") > capacity, F.lit(capacity + 1)).otherwise(F.coalesce("n_tokens", F.lit(0)))
    kind = F.greatest(kind, F.lit(0)).cast("long")
    numbered = number_rows(
        rows.withColumn("kind", kind).withColumn("copy", F.monotonically_increasing_id()), ["kind", "id", "copy"])
    counts = {r["kind"]: r["count"] for r in numbered.groupBy("kind").count().collect()}
    segments, samples = plan(counts, capacity)
    if over := counts.get(capacity + 1, 0):
        segments.append((capacity + 1, 0, over, samples, 1, 0))
    before, total = [], 0
    for n in sorted(counts):
        before.append((n, total))
        total += counts[n]
    # Both tables have a few rows per length at most.
    firsts = F.broadcast(spark.createDataFrame(before, "kind long, before long"))
    places = F.broadcast(spark.createDataFrame(segments, PLAN).withColumnRenamed("n_tokens", "of"))
    ranked = numbered.join(firsts, "kind").withColumn("rank", F.col("n") - 1 - F.col("before"))
    found = ranked.join(
        places, (F.col("kind") == F.col("of")) & (F.col("rank") >= F.col("a")) & (F.col("rank") < F.col("b")), "left")
    nth = F.col("rank") - F.col("a")
    return found.select(
        (F.col("base") + F.floor(nth / F.col("k"))).alias("sample"), F.col("id").alias(id),
        F.col("n_tokens").alias(n_tokens), (F.col("at") + F.pmod(nth, F.col("k")) * F.col("kind")).alias("start"))


def sample_fill(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """Per sample: rows, tokens and the padding up to the capacity."""
    return packed.where("sample IS NOT NULL").groupBy("sample").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_tokens").alias("fill"),
    ).withColumn("padding", F.greatest(F.lit(capacity) - F.col("fill"), F.lit(0)))
