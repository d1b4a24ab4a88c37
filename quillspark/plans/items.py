"""Listing pages and item pages to records, resuming from the seen set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.firstwins import first_rows, unseen, unseen_rows
from quillspark.operators.links import item_links
from quillspark.operators.ordering import limit_first
from quillspark.operators.records import extract_item, extract_transcript


def new_item_links(
    listings: DataFrame, seen: DataFrame, pattern: str = r"/items/show/(\d+)",
    max_pages: int | None = None, max_items: int | None = None,
) -> DataFrame:
    """Item links of the listing pages that are not in the seen set, in listing order."""
    bounded = listings if max_pages is None else listings.where(F.col("page_id") <= max_pages)
    links = item_links(bounded, pattern)
    fresh = unseen(links, seen.withColumnRenamed("id", "url"), "url", ["page_id", "pos"])
    return limit_first(fresh, max_items, "page_id", "pos")


def items_from_pages(
    pages: DataFrame, seen: DataFrame, creator_phrase: str | None = None,
    title_suffix: str | None = None,
) -> DataFrame:
    """Records of unseen item pages; the filter runs before any parsing."""
    fresh = unseen_rows(pages, seen.withColumnRenamed("id", "url"), "url", ["page_id"])
    return extract_item(fresh, creator_phrase, title_suffix)


def transcripts_from_pages(
    pages: DataFrame, seen: DataFrame, scraped_at: str | None = None
) -> DataFrame:
    """Transcript records of unseen episode pages."""
    fresh = unseen_rows(pages, seen.withColumnRenamed("id", "url"), "url", ["page_id"])
    return extract_transcript(fresh, scraped_at=scraped_at)


def crawl_inputs(pages: DataFrame) -> DataFrame:
    """Each URL once, at its first landing."""
    return first_rows(pages, ["url"], ["page_id"])
