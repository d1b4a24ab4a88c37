"""Sources to training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import html
from quillspark.functions.text import RELEVANCE_KEYWORDS, clean_text
from quillspark.functions.urls import normalize_url
from quillspark.operators.corpus import parse_episodes
from quillspark.operators.files import corpus_files, extract_files
from quillspark.operators.training import build_training_set, episode_training, to_training
from quillspark.sources.text import read_separated
from quillspark.sources.trees import read_text_files


def page_entries(pages: DataFrame, *keep: str) -> DataFrame:
    """Pages as corpus entries: host and URL for provenance, all visible text."""
    body = html.page_text(F.col("html"))
    url = F.col("url")
    return pages.select(
        *keep,
        F.regexp_extract(url, r"^[^:]+://([^/?#]*)", 1).alias("repo"),
        normalize_url(url).alias("path"),
        clean_text(body).alias("content"),
    )


def pages_to_training(pages: DataFrame, max_length: int = 1500) -> DataFrame:
    """Pages to prompts and chunks, without a join or aggregate."""
    return to_training(page_entries(pages), max_length)


def files_to_training(
    spark: SparkSession, root: str, keywords: Sequence[str] = RELEVANCE_KEYWORDS
) -> DataFrame:
    """A folder of repositories to training rows, without the detour through text."""
    return to_training(corpus_files(extract_files(read_text_files(spark, root), keywords)))


def transcripts_to_training(
    spark: SparkSession, path: str, show: str, compat: bool = False
) -> DataFrame:
    """A consolidated transcript document to training rows."""
    return episode_training(parse_episodes(read_separated(spark, path), compat=compat), show)


def two_stage_training(base: DataFrame, added: DataFrame) -> DataFrame:
    """The first training set and its follow-up with the added source."""
    return build_training_set(base, added, existing=True)
