"""SimHash near-duplicates by pivot distance tables.

Every distinct fingerprint carries its Hamming distances to a set of reference
fingerprints (the pivots). The triangle inequality discards a pair when any
coordinate differs by more than the threshold; survivors are verified by the
true distance. The pivots' filter needs pairs to look at, and looking at all is
out of the question, so a second family of references, the one-bit fingerprints,
gives the keys: distances to those inside a block of bits determine the block.
Two fingerprints within four bits agree on at least three of seven blocks, so
each of the 35 choices of three is a table of keys.

Inside a key only neighbours in order, and each member with the smallest one, are
compared; that links most of a large group at a cost that grows with its size.
Then the pairs that may still matter, those of different components under one
key, are compared in full, so no link between two components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import LOWER, UPPER, written
from quillspark.llm.components import components

BITS = 64
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())


# --- fingerprints -------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, as an unsigned number."""
    import xxhash

    words = (text or "").encode().translate(_LOWERED).split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(whole, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(whole[a:b], 42)
            for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
        ]
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 100_000):
        part = np.array(hashes[k:k + 100_000], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, *, id: str, text: str, shingle: int = 4) -> DataFrame:
    """(id, th, fp): the row's id, a hash of its text and its fingerprint as a signed long."""
    kind = docs.schema[id].dataType.simpleString()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["id", "th", "fp"])

    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, th long, fp long")


# --- pivots -------------------------------------------------------------------

def pivots(n: int = 8) -> list[int]:
    """Reference fingerprints by a fixed rule: multiples of an odd constant, as signed longs."""
    return [((i * 0x9E3779B97F4A7C15 + 0x7F4A7C15) ^ (i << 61)) % (1 << 64) - (1 << 63) for i in range(1, n + 1)]


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pivot_table(fp: Column) -> Column:
    """Distances to eight pivots, seven bits each, in one long."""
    parts = [
        F.shiftleft(distance(fp, F.lit(p)).cast("long"), 7 * i) for i, p in enumerate(pivots())
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def coordinates_near(a: Column, b: Column, radius: int) -> Column:
    """Whether no pivot coordinate differs by more than ``radius``."""
    at = lambda x, i: F.shiftright(x, 7 * i).bitwiseAND(F.lit(127))
    return reduce(lambda x, y: x & y, [F.abs(at(a, i) - at(b, i)) <= radius for i in range(8)])


def near(a: str, b: str, radius: int) -> Column:
    """The pivot filter, then the true distance, of two (fp, near) structs."""
    return coordinates_near(F.col(f"{a}.near"), F.col(f"{b}.near"), radius) & (
        distance(F.col(f"{a}.fp"), F.col(f"{b}.fp")) <= radius)


def block_masks(radius: int, blocks: int) -> list[int]:
    """A mask per choice of ``blocks - radius`` blocks, as signed longs."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    single = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    out = []
    for chosen in combinations(single, blocks - radius):
        mask = sum(chosen)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


# --- links --------------------------------------------------------------------

def fingerprint_components(fps: DataFrame, *, radius: int = 4, blocks: int = 7) -> DataFrame:
    """(fp, root) for the distinct fingerprints that have a link; the others stand alone."""
    masks = block_masks(radius, blocks)
    keyed = fps.select(F.struct("fp", pivot_table(F.col("fp")).alias("near")).alias("x")).select(
        F.explode(F.array(*[
            F.struct(F.lit(t).alias("t"), F.col("x.fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)
        ])).alias("k"), "x",
    ).select("k.t", "k.key", "x")
    order = Window.partitionBy("t", "key").orderBy("x.fp")
    # All members of a key but its first, each with the first and the one before.
    shared = keyed.withColumn("before", F.lag("x").over(order)).withColumn(
        "first", F.first("x").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).filter("before IS NOT NULL")
    shared = written(shared, "shared-keys")
    pairs = shared.select("x", F.explode(F.array("before", "first")).alias("y"))
    links = pairs.filter(near("x", "y", radius)).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    labels = components(links)

    # Pairs of different components under one key.
    members = shared.select("t", "key", "x").union(
        shared.groupBy("t", "key").agg(F.first("first").alias("x")).select("t", "key", "x"))
    members = members.withColumn("fp", F.col("x.fp")).join(labels.withColumnRenamed("v", "fp"), "fp", "left").select(
        "t", "key", "x", F.coalesce("root", "fp").alias("root"))
    members = written(members, "members")
    largest = (
        members.groupBy("t", "key", "root").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("t", "key").agg(F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
        .filter("roots > 1").select("t", "key", F.col("most.root").alias("most"))
    )
    mixed = written(members.join(largest, ["t", "key"]), "mixed-keys")
    one = mixed.filter("root <> most").select("t", "key", F.col("x").alias("a"), F.col("root").alias("ra"))
    other = mixed.select("t", "key", F.col("x").alias("b"), F.col("root").alias("rb"))
    crossing = one.join(other, ["t", "key"]).filter((F.col("ra") != F.col("rb")) & near("a", "b", radius))
    more = written(crossing.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "crossing-links")
    joined = components(more).select(F.col("v").alias("root"), F.col("root").alias("top"))
    return labels.join(joined, "root", "left").select(
        F.col("v").alias("fp"), F.coalesce("top", "root").alias("root"),
    ).union(
        # Fingerprints whose only links were crossing ones.
        joined.join(labels.select("v"), F.col("root") == F.col("v"), "left_anti").select(F.col("root").alias("fp"), "top")
    )


def _grouped(docs: DataFrame, id: str, text: str, shingle: int, radius: int, blocks: int) -> DataFrame:
    """(id, th, fp, root) of every row."""
    rows = written(with_fingerprints(docs, id=id, text=text, shingle=shingle), "fingerprints")
    fps = written(rows.select("fp").distinct(), "distinct-fingerprints")
    roots = fingerprint_components(fps, radius=radius, blocks=blocks)
    return rows.join(roots, "fp", "left").select("id", "th", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, blocks: int = 7,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest id reachable over links of at most ``radius``
    differing bits, the row's own included; null ids are never the smallest, and
    a component of null ids only has a null one. Null and empty texts have
    fingerprint zero and link like any other. Repeated rows get the same result
    each; other columns are ignored, and an empty table gives no rows.
    """
    rows = written(_grouped(docs, id, text, shingle, radius, blocks), "fingerprint-groups")
    # Written, so that the join shuffles both sides and a large component can be split.
    first = written(rows.groupBy("root").agg(F.min("id").alias("component_id")), "component-ids")
    return rows.join(first, "root").select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, blocks: int = 7,
) -> DataFrame:
    """``docs`` with one row of each component: its smallest id, then its smallest text hash.

    All columns stay. A null id stays only if its component has no other.
    """
    rows = _grouped(docs, id, text, shingle, radius, blocks)
    best = F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("id"), F.col("th").alias("th")))
    kept = rows.groupBy("root").agg(best.alias("k")).select(
        F.col("k.id").alias("__keep_id"), F.col("k.th").alias("__keep_th")).distinct()
    out = docs.withColumn("__th", F.xxhash64(text)).join(
        kept, F.col(id).eqNullSafe(F.col("__keep_id")) & (F.col("__th") == F.col("__keep_th")), "left_semi")
    return out.dropDuplicates([id, "__th"]).drop("__th")
