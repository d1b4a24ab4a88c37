"""Training examples: chunks, prompts, unions, splits and packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import chunk_text, let, word_count


def file_prompt(repo: Column, path: Column, part: Column, parts: Column) -> Column:
    """Prompt of a repository chunk; the part is named when there are several."""
    numbered = F.when(
        parts > 1,
        F.concat(
            F.lit(" (part "), part.cast("string"), F.lit(" of "), parts.cast("string"), F.lit(")")
        ),
    ).otherwise(F.lit(""))
    return F.concat(
        F.lit("The following is content from "), path, F.lit(" in the "), repo,
        F.lit(" repository"), numbered, F.lit(":\n\n"),
    )


def to_training(
    entries: DataFrame, max_length: int = 1500, shortest: int = 100
) -> DataFrame:
    """(repo, path, part, parts, text) from (repo, path, content); no shuffle.

    The length gate and the part count sit inside the exploded expression: a
    filter, given or inferred, would be pushed below and chunk the text again there.
    """
    def numbered(chunks: Column) -> Column:
        return F.transform(
            chunks,
            lambda x, i: F.struct(
                (i + 1).cast("int").alias("part"), F.size(chunks).alias("parts"), x.alias("chunk")
            ),
        )

    rows = let(
        F.col("content"),
        lambda c: F.when(F.length(c) >= shortest, let(chunk_text(c, max_length), numbered)),
    )
    prompt = file_prompt(F.col("repo"), F.col("path"), F.col("_r.part"), F.col("_r.parts"))
    return entries.select("repo", "path", F.explode(rows).alias("_r")).select(
        "repo", "path", "_r.part", "_r.parts", F.concat(prompt, F.col("_r.chunk")).alias("text")
    )


def episode_training(episodes: DataFrame, show: str) -> DataFrame:
    """(title, text) from parsed episodes; ``show`` describes the podcast."""
    return episodes.select(
        "title",
        F.concat(
            F.lit(f"The following is from {show} - "), F.col("title"), F.lit(":\n\n"),
            F.col("content"),
        ).alias("text"),
    )


def build_training_set(base: DataFrame, added: DataFrame, existing: bool = False) -> DataFrame:
    """Base set and added source with their stage; (stage, text).

    ``existing=True`` drops added rows whose text is already in the base set, so a
    repeated append adds nothing. Texts are matched by a 256-bit digest, and the
    base side is reduced to distinct digests before the join.
    """
    first = base.select(F.lit("base").alias("stage"), "text")
    second = added.select(F.lit("added").alias("stage"), "text")
    if existing:
        known = base.select(F.sha2("text", 256).alias("_d")).distinct()
        second = second.withColumn("_d", F.sha2("text", 256)).join(known, "_d", "left_anti")
        second = second.drop("_d")
    return first.unionByName(second)


def union_delta(combined: DataFrame) -> DataFrame:
    """One row: examples before, after, and added."""
    added = F.count_if(F.col("stage") == "added")
    return combined.agg(
        (F.count(F.lit(1)) - added).alias("before"),
        F.count(F.lit(1)).alias("after"),
        added.alias("added"),
    )


def conversion_stats(entries: DataFrame, max_length: int = 1500, shortest: int = 100) -> DataFrame:
    """One row: raw entries against produced examples, in one pass."""
    made = let(
        F.col("content"),
        lambda c: F.when(F.length(c) >= shortest, F.size(chunk_text(c, max_length))),
    )
    return entries.agg(
        F.count(F.lit(1)).alias("total_entries"),
        F.coalesce(F.sum(made), F.lit(0)).alias("processed_entries"),
    )


def train_val_split(df: DataFrame, key: str, share: float = 0.05) -> DataFrame:
    """Deterministic split on a digest of the key; the same row always lands on one side."""
    limit = f"{round(share * 65536):04x}"
    is_val = F.substring(F.md5(F.col(key).cast("string")), 1, 4) < limit
    return df.withColumn("split", F.when(is_val, "validation").otherwise("train"))


def token_count(text: Column) -> Column:
    """Token stand-in: white-space separated words."""
    return word_count(text)


def pack_sequences(lengths: DataFrame, capacity: int = 2048, per_shard: int = 4096) -> DataFrame:
    """Place (id, n_tokens) rows in samples of ``capacity`` tokens, next-fit in id order.

    A shard holds the ids of one stretch of ``per_shard`` numbers. Ids are unique, so a
    shard has at most that many rows whatever the data, and a row's shard depends on
    its id alone. Only ids and lengths take part; texts are joined back by id. A row
    above the capacity has a sample of its own.
    """
    rows = lengths.select(
        F.floor(F.col("id") / per_shard).alias("shard"),
        F.struct(
            F.col("id").cast("bigint").alias("id"), F.col("n_tokens").cast("bigint").alias("n_tokens")
        ).alias("x"),
    ).groupBy("shard").agg(F.sort_array(F.collect_list("x")).alias("xs"))

    # Where samples begin: the fold carries positions only, never rows.
    state = F.struct(
        F.array().cast("array<int>").alias("cuts"), F.lit(0).cast("bigint").alias("fill"), F.lit(0).alias("i")
    )

    def place(s: Column, x: Column) -> Column:
        full = (s["fill"] > 0) & (s["fill"] + x["n_tokens"] > capacity)
        return F.struct(
            F.when(full, F.array_append(s["cuts"], s["i"])).otherwise(s["cuts"]).alias("cuts"),
            F.when(full, x["n_tokens"]).otherwise(s["fill"] + x["n_tokens"]).alias("fill"),
            (s["i"] + 1).alias("i"),
        )

    cuts = F.aggregate("xs", state, place, lambda s: s["cuts"])
    bounded = rows.withColumn("bounds", F.concat(F.array(F.lit(0)), cuts, F.array(F.size("xs"))))
    bins = F.transform(
        F.sequence(F.lit(0), F.size("bounds") - 2),
        lambda k: F.slice("xs", F.get("bounds", k) + 1, F.get("bounds", k + 1) - F.get("bounds", k)),
    )
    placed = bounded.select("shard", F.posexplode(bins).alias("bin", "ys"))
    total = lambda ys: F.aggregate(ys, F.lit(0).cast("bigint"), lambda a, y: a + y["n_tokens"])
    started = F.transform("ys", lambda y, j: F.struct(y.alias("y"), total(F.slice("ys", 1, j)).alias("start")))
    return placed.select("shard", "bin", F.explode(started).alias("z")).select(
        "shard", "z.y.id", "z.y.n_tokens", F.col("bin").cast("bigint").alias("bin"), "z.start"
    )


def packing_summary(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """Per sample: rows, filled tokens and the padding up to the capacity."""
    return packed.groupBy("shard", "bin").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_tokens").alias("fill")
    ).withColumn("padding", F.greatest(F.lit(capacity) - F.col("fill"), F.lit(0)))
