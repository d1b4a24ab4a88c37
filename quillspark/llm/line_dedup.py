"""Line dedup over levelled sorted runs of line hashes.

The state is a set of *runs*: bucketed tables of (h1, h2, docs), sorted inside
each bucket. A batch counts in how many of its documents a line occurs,
merge-anti-joins the run of lines that are known to be frequent, and adds the
rest as a run of level 0. When a level holds ``fanout`` runs they are compacted
into one run of the next level; lines whose counts reach the threshold move to
the frequent run. All joins with runs read their buckets in place, without a
shuffle or sort of the run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import SPACE, ascii_lower, shuffle_partitions, written

KEYS = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z lowered."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def text_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(key: Column) -> Column:
    """128 bits: two XXH64, the second seeded by the hash of a constant."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def line_hashes(text: Column, min_chars: int) -> Column:
    """Per line (pos, h1, h2), without lines whose key is shorter than ``min_chars``."""
    keyed = F.transform(
        text_lines(text),
        lambda line, i: F.struct(i.alias("pos"), line_key(line).alias("key")),
    )
    long = F.filter(keyed, lambda x: F.char_length(x["key"]) >= min_chars)
    return F.transform(long, lambda x: F.struct(x["pos"], _hash(x["key"]).alias("h")))


class LineRuns:
    """The runs of one corpus; ``close`` drops their tables."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or shuffle_partitions(spark)
        self.levels: list[list[str]] = [[]]
        self.frequent: list[str] = []
        self.made: list[str] = []

    def _run(self, counts: DataFrame) -> str:
        """Store sorted counts; one file per bucket keeps the order readable."""
        name = f"line_run_{uuid.uuid4().hex}"
        self.made.append(name)
        (
            counts.select(*KEYS, "docs")
            .repartition(self.buckets, *KEYS)
            .write.bucketBy(self.buckets, *KEYS).sortBy(*KEYS)
            .format("parquet").saveAsTable(name)
        )
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        """The counts of several runs, added up inside their buckets."""
        runs = self.spark.table(names[0])
        for name in names[1:]:
            runs = (
                runs.alias("a").join(self.spark.table(name).alias("b"), KEYS, "full")
                .select(*KEYS, (F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))).alias("docs"))
            )
        return runs

    def add(self, counts: DataFrame) -> None:
        """Add a batch: (h1, h2, docs), one row per line hash."""
        for name in self.frequent:
            counts = counts.join(self.spark.table(name).hint("merge"), KEYS, "left_anti")
        self.levels[0].append(self._run(counts))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        merged = self._merged(self.levels[level])
        self.levels[level] = []
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.frequent.append(self._run(merged.filter(F.col("docs") >= self.min_docs)))
        self.levels[level + 1].append(self._run(merged.filter(F.col("docs") < self.min_docs)))

    def frequent_keys(self) -> DataFrame:
        """The hashes of all lines that reach the threshold over everything added."""
        rest = [name for level in self.levels for name in level]
        found = [self.spark.table(name).select(*KEYS) for name in self.frequent]
        if rest:
            found.append(self._merged(rest).filter(F.col("docs") >= self.min_docs).select(*KEYS))
        out = found[0]
        for more in found[1:]:
            out = out.union(more)
        return written(out, "frequent-lines")

    def close(self) -> None:
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def frequent_lines(
    docs: DataFrame, *, text: str = "text", min_docs: int = 10, min_chars: int = 1,
    batches: int = 4, fanout: int = 2,
) -> DataFrame:
    """Hashes (h1, h2) of the lines found in at least ``min_docs`` documents.

    A document counts once for a line however often it repeats there, and each
    row is a document, also a repeated one. The table is scanned once; rows are
    dealt into ``batches`` by a hash of the text, and each batch's counts,
    combined before the shuffle, go through the runs.
    """
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64(F.lit("batch"), F.col(text)), F.lit(batches)).cast("int")
    hashes = F.array_distinct(F.transform(line_hashes(F.col(text), min_chars), lambda x: x["h"]))
    counts = (
        docs.select(batch.alias("batch"), F.explode(hashes).alias("h"))
        .groupBy("batch", F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"))
        .agg(F.count(F.lit(1)).alias("docs"))
    )
    counts = written(counts, "line-counts")
    runs = LineRuns(spark, min_docs, fanout)
    try:
        for b in range(batches):
            runs.add(counts.filter(F.col("batch") == b).select(*KEYS, "docs"))
        return runs.frequent_keys()
    finally:
        runs.close()


def _first_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, id, text hash) of the smallest id, then text hash, per key; null ids last."""
    first = F.min(F.struct(F.col("__ld_id").isNull().alias("n"), "__ld_id", "__ld_text")).alias("k")
    return rows.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("n")).select(*keys, "k.__ld_id", "k.__ld_text", "n")


def _without_first(own: DataFrame, found: DataFrame, id: str, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """``found`` without a line's first document, and without the first of each group of whole copies."""
    found = written(found, "found-lines")
    same = lambda a, b: F.col(f"{a}.__ld_id").eqNullSafe(F.col(f"{b}.__ld_id")) & (
        F.col(f"{a}.__ld_text") == F.col(f"{b}.__ld_text"))
    lines = F.transform(line_hashes(F.col(text), min_chars), lambda x: x["h"])
    whole = own.select(
        F.col(id).alias("__ld_id"), F.xxhash64(F.col(text)).alias("__ld_text"),
        F.xxhash64(lines).alias("w1"), F.xxhash64(F.lit("whole"), lines).alias("w2"))
    copies = written(_first_of(whole, ["w1", "w2"]).filter(F.col("n") >= min_docs), "first-copies")
    first = written(_first_of(found, KEYS), "first-lines")
    return found.alias("f").join(
        first.alias("k"), same("f", "k") & (F.col("f.h1") == F.col("k.h1")) & (F.col("f.h2") == F.col("k.h2")), "left_anti",
    ).alias("f").join(copies.alias("c"), same("f", "c"), "left_anti")


def dedup_lines(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_docs: int = 10,
    min_chars: int = 1, batches: int = 4, keep_first: bool = False,
) -> DataFrame:
    """Drop the lines found in many documents from every document.

    With ``keep_first``, a frequent line stays in the first document that holds it,
    so every line is somewhere in the result; and of documents whose lines are the
    same throughout, if there are ``min_docs`` of them, the first keeps them all.
    The first has the smallest id, then the smallest text hash; null ids come last.

    Returns all columns of ``docs`` but with ``text`` replaced by the kept lines
    joined by newlines, plus ``n_lines`` (before) and ``n_dropped``; columns of
    ``docs`` with those two names are replaced. Null and empty texts are one
    empty line, which is never dropped, and come out empty. Null ids, repeated
    rows and an empty table are fine: repeated rows get the same result each.
    """
    frequent = frequent_lines(docs, text=text, min_docs=min_docs, min_chars=min_chars, batches=batches)
    own = docs.drop("n_lines", "n_dropped")
    narrow = own.select(
        F.col(id).alias("__ld_id"), F.xxhash64(F.col(text)).alias("__ld_text"),
        F.explode(line_hashes(F.col(text), min_chars)).alias("__ld_x"),
    ).select("__ld_id", "__ld_text", "__ld_x.pos", "__ld_x.h.h1", "__ld_x.h.h2")
    # Positions of frequent lines; repeated rows name the same positions.
    found = narrow.join(frequent, KEYS, "left_semi")
    if keep_first:
        found = _without_first(own, found, id, text, min_docs, min_chars)
    dropped = found.groupBy("__ld_id", "__ld_text").agg(F.sort_array(F.collect_set("pos")).alias("__ld_drop"))
    joined = own.join(
        dropped,
        F.col(id).eqNullSafe(F.col("__ld_id")) & (F.xxhash64(F.col(text)) == F.col("__ld_text")),
        "left",
    )
    lines = text_lines(F.col(text))
    drop = F.coalesce(F.col("__ld_drop"), F.array().cast("array<int>"))
    bounds = F.concat(F.array(F.lit(-1)), F.col("__ld_drop"), F.array(F.size("__ld_lines")))
    # The lines between two dropped positions, for each pair of neighbours.
    kept = F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("__ld_drop")),
        lambda j: F.slice(
            F.col("__ld_lines"), F.get("__ld_bounds", j) + 2, F.get("__ld_bounds", j + 1) - F.get("__ld_bounds", j) - 1
        ),
    ))
    return (
        joined.withColumn("__ld_lines", lines).withColumn("__ld_drop", drop).withColumn("__ld_bounds", bounds)
        .withColumn(text, F.array_join(kept, "\n"))
        .withColumn("n_lines", F.size("__ld_lines").cast("long"))
        .withColumn("n_dropped", F.size("__ld_drop").cast("long"))
        .select(*[c for c in own.columns], "n_lines", "n_dropped")
    )
