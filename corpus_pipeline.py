"""The corpus pipeline: from documents to the piece ids of the texts that are worth keeping.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept. ``run`` writes every stage's rows as Parquet in the shared folder and reads
them again for the next, so a stage is computed once and a lost executor costs its
own tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontaminate, line_dedup, pieces, simhash, toxicity
from quillspark.llm.common import written

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the pattern grammar rejects go; it learns from the labels of the rows it is given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out())
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more stay in the first of them only, and whole in the first of ten copies or more."""
    out = line_dedup.dedup_lines(docs, keep_first=True)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (four-word fingerprints within four bits) the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, give or take a few edits, go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_ids, round_trip) of the texts that are left."""
    return pieces.encode_checked(docs, VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

# Learned scores, fingerprints and edit distances have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
