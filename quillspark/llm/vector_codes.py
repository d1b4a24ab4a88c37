"""Vector codes: product quantisation with Orchard's nearest-neighbour search.

A vector is cut into parts and each part becomes the index of its codebook's
nearest entry. Orchard search keeps, for every entry, a list of all entries
sorted by their distance to it. A query starts at some entry and walks that
entry's list; a better entry's own list is walked next, entries seen before are
skipped, and the walk ends at the first neighbour further than twice the current
distance away, since no entry from there on can be nearer.

Codebooks are refitted in rounds: tasks add up the parts of each entry, so a
task sends one row per component of the codebooks however many vectors it has.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import written

BATCH = 4096  # vectors searched at once


class Orchard:
    """Exact nearest entries, ties to the smallest index, of integer vectors."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.asarray(entries, np.int64)
        self.apart = ((self.entries[:, None] - self.entries[None]) ** 2).sum(2)
        self.lists = np.argsort(self.apart, axis=1, kind="stable")
        self.by_first = np.argsort(self.entries[:, 0], kind="stable")

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) for each row of ``points``.

        All points walk together: a step looks at the next listed neighbour of
        every point whose walk has not ended.
        """
        n, k = len(points), len(self.entries)
        at = np.searchsorted(self.entries[self.by_first, 0], points[:, 0])
        best = self.by_first[np.minimum(at, k - 1)]
        apart = ((points - self.entries[best]) ** 2).sum(1)
        seen = np.zeros((n, k), bool)
        seen[np.arange(n), best] = True
        step, walking = np.zeros(n, np.int64), np.arange(n)
        while len(walking):
            here = best[walking]
            there = self.lists[here, step[walking]]
            # Distances are squared: twice the distance is four times as much.
            within = self.apart[here, there] <= 4 * apart[walking]
            walking, there = walking[within], there[within]
            step[walking] += 1
            new = ~seen[walking, there]
            who, entry = walking[new], there[new]
            seen[who, entry] = True
            d = ((points[who] - self.entries[entry]) ** 2).sum(1)
            jump = (d < apart[who]) | ((d == apart[who]) & (entry < best[who]))
            who, entry = who[jump], entry[jump]
            best[who], apart[who], step[who] = entry, d[jump], 0
            walking = walking[step[walking] < k]
        return best, apart


def component_bound(dims: int) -> int:
    """The largest component for which a vector's squared distances fit in 64 bits."""
    return 1 << ((62 - math.ceil(math.log2(max(dims, 1)))) // 2 - 1)


def _integers(column: pa.Array, dims: int, parts: int, scale: int) -> np.ndarray:
    """(n, parts, width) integers: floor(scale * x), padded with zeros to whole parts."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    most = component_bound(dims)
    whole = np.clip(np.floor(values * scale), -most, most).astype(np.int64)
    width = -(-dims // parts)
    return np.pad(whole, ((0, 0), (0, width * parts - dims))).reshape(-1, parts, width)


def usable(docs: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there, not empty, and without null or non-finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return docs.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, odd))


class Codebooks:
    """``entries`` (parts, k, width) for vectors of ``dims`` components."""

    def __init__(self, entries: np.ndarray, dims: int, scale: int):
        self.entries, self.dims, self.scale = entries, dims, scale

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def parts_of(self, stream: Iterator[pa.RecordBatch], column: int):
        """(batch, integers, indexes, squared distances) in bounded batches."""
        parts = len(self.entries)
        searches = [Orchard(e) for e in self.entries]
        for batch in stream:
            for start in range(0, batch.num_rows, BATCH):
                rows = batch.slice(start, BATCH)
                points = _integers(rows.column(column), self.dims, parts, self.scale)
                found = [s.nearest(points[:, p]) for p, s in enumerate(searches)]
                yield rows, points, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _refit(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry becomes the floor of its parts' mean; unused entries stay."""
    parts, k, width = books.entries.shape

    def sums(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for _, points, index, _ in books.parts_of(stream, 0):
            for p in range(parts):
                np.add.at(total[p], index[:, p], points[:, p])
                count[p] += np.bincount(index[:, p], minlength=k)
        p, e = np.nonzero(count)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p * k + e), pa.array(count[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
                ["entry", "n", "total"])

    added = vectors.mapInArrow(sums, "entry long, n long, total array<bigint>")
    # At most one row per entry, whatever the number of vectors.
    rows = added.groupBy("entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(width)]).collect()
    entries = books.entries.copy()
    for r in rows:
        entries[r.entry // k, r.entry % k] = [r[f"t{i}"] // r.n for i in range(width)]
    return Codebooks(entries, books.dims, books.scale)


def fit(
    docs: DataFrame, *, id: str = "vec_id", vector: str = "embedding", parts: int = 16, entries: int = 64,
    rounds: int = 2, scale: int = 256,
) -> Codebooks | None:
    """Codebooks that start as the vectors of the ``entries`` smallest ids and are refitted over all rows.

    Null ids come last and equal ids are ordered by their vectors. The first of
    these vectors sets the number of components; rows of another length are left
    out. If it is no multiple of ``parts``, vectors are padded with zeros. With
    fewer rows there are fewer entries; without any, no codebooks.
    """
    rows = usable(docs, vector).select(F.col(id).alias("id"), F.col(vector).alias("v"))
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return None
    dims = len(first[0].v)
    fitting = rows.filter(F.size("v") == dims)
    start = fitting.orderBy(*order).limit(entries).collect()  # a codebook's worth of rows
    points = _integers(pa.array([r.v for r in start]), dims, parts, scale)
    books = Codebooks(np.ascontiguousarray(points.transpose(1, 0, 2)), dims, scale)
    for _ in range(rounds):
        books = _refit(fitting.select("v"), books)
    return books


def encode(
    docs: DataFrame, books: Codebooks | None, *, id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(id, label, code, error) of every usable row of the codebooks' length.

    ``code`` has two hex digits per part, ``error`` is the squared distance to the
    coded vector. Components beyond ``component_bound`` (millions) count as that
    bound, so that errors fit in a long. Repeated rows and ids are coded each;
    other columns are ignored. Without codebooks there are no rows.
    """
    kinds = [docs.schema[c].dataType.simpleString() for c in (id, label)]
    rows = usable(docs, vector).select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    rows = rows.filter(F.size("v") == books.dims) if books else rows.limit(0)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, index, apart in books.parts_of(stream, 2):
            codes = [r.tobytes().hex() for r in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(apart.sum(1))],
                ["id", "label", "code", "error"])

    if books is None:
        out = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        if books.entries.shape[1] > 256:
            raise ValueError("a code has one byte per part: at most 256 entries")
        out = rows.mapInArrow(run, f"id {kinds[0]}, label {kinds[1]}, code string, error long")
    return out.select(F.col("id").alias(id), F.col("label").alias(label), "code", "error")


def with_label_error(codes: DataFrame, *, label: str = "label") -> DataFrame:
    """Add ``label_error``, the sum of errors over rows of an equal label, nulls together.

    Sums are combined before the shuffle and written, so the join with them can
    send a small table to all tasks or split a label that holds most rows. A sum
    that no long can hold is null.
    """
    codes = written(codes, "vector-codes")
    total = F.sum(F.col("error").cast("decimal(19,0)"))
    sums = written(codes.groupBy(F.col(label).alias("__label")).agg(
        F.try_to_number(total.cast("string"), F.lit("9" * 38)).try_cast("long").alias("label_error")), "label-errors")
    return codes.join(sums, F.col(label).eqNullSafe(F.col("__label")), "left").drop("__label")
