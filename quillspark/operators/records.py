"""Record extraction: archive items, transcripts, recordings and repositories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import html, markup
from quillspark.functions.text import (
    blank_to_null,
    concat_fields,
    first_date,
    let,
    venue_of,
    word_count,
)
from quillspark.operators.links import attachment_array
from quillspark.operators.ordering import number_rows, write_in_order

# Selector cascades of transcript pages.
TRANSCRIPT_SELECTORS = (
    ".field-name-field-transcript", ".field-name-body", ".field-content", ".content", "article",
)
TRANSCRIPT_BLOCKS = (
    ".transcript", ".episode-transcript", ".content-transcript",
    '[id*="transcript"]', '[class*="transcript"]',
)
MAIN_CONTENT = ".content, .main-content, .article-content, .field-content"
DATE_SELECTORS = (".date", ".published", ".episode-date", "time")
DATE_UNION = ".date, .published, time"


def empty_for_null(df: DataFrame) -> DataFrame:
    """Missing strings as '' and missing lists as [], the convention of record files."""
    out = []
    for field in df.schema:
        kind = field.dataType.simpleString()
        if kind == "string":
            out.append(F.coalesce(field.name, F.lit("")).alias(field.name))
        elif kind.startswith("array"):
            out.append(
                F.coalesce(field.name, F.expr(f"cast(array() as {kind})")).alias(field.name)
            )
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def extract_item(
    pages: DataFrame,
    creator_phrase: str | None = None,
    title_suffix: str | None = None,
    sep: str = "",
) -> DataFrame:
    """Archive item records: heading, embedded JSON, definition list, metadata blocks, text.

    Later sources override or fill earlier ones: the definition list beats the
    embedded JSON; metadata blocks, title and page text only fill gaps.
    ``creator_phrase`` names the creator assumed when the page mentions it.
    """
    h, v = F.col("html"), F.col("_v")
    base = pages.select("url", "html", html.visible(h).alias("_v")).select(
        "url",
        html.clean_title(html.visible_title(v, ""), title_suffix).alias("_heading"),
        html.json_ld(h).alias("_ld"),
        html.visible_pairs(v, sep).alias("_dl"),
        markup.nested_texts(h, "metadata", ["span", "div", "p"], sep).alias("_meta"),
        html.text_of(v, None).alias("_text"),
        attachment_array(v, F.col("url")).alias("attachments"),
    )

    def last(slot: str) -> Column:
        own = F.filter("_dl", lambda p: html.definition_slot(p["key"]) == slot)
        return F.try_element_at(own, F.lit(-1))["value"]

    def stated(slot: str) -> Column:
        return blank_to_null(F.coalesce(last(slot), F.col(f"_ld.{slot}")))

    title = F.coalesce(F.col("_ld.name"), F.col("_heading"))
    meta_date = F.try_element_at(
        F.filter(F.transform("_meta", first_date), lambda d: d.isNotNull()), F.lit(1)
    )
    creator = stated("creator")
    if creator_phrase:
        named = F.exists("_meta", lambda t: F.contains(t, F.lit(creator_phrase))) | F.contains(
            F.lower("_text"), F.lit(creator_phrase.lower())
        )
        creator = F.coalesce(creator, F.when(named, F.lit(creator_phrase)))
    listed = F.transform(
        F.filter("_dl", lambda p: html.definition_slot(p["key"]) == "tags"), lambda p: p["value"]
    )
    tags = F.concat(
        F.coalesce(F.col("_ld.keywords"), F.expr("cast(array() as array<string>)")), listed
    )
    venue = venue_of(title)
    return empty_for_null(
        base.select(
            "url",
            title.alias("title"),
            F.coalesce(last("description"), F.col("_ld.description")).alias("description"),
            creator.alias("creator"),
            F.coalesce(stated("date"), meta_date, first_date(title)).alias("date"),
            F.coalesce(last("type"), F.col("_ld.type")).alias("type"),
            F.when(
                venue.isNotNull(), F.array_append(tags, F.concat(F.lit("Venue: "), venue))
            ).otherwise(tags).alias("tags"),
            F.expr("cast(array() as array<string>)").alias("subjects"),
            "attachments",
        )
    )


def _stamp(timestamp: str | None) -> Column:
    return F.lit(timestamp) if timestamp else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"
    )


def extract_transcript(
    pages: DataFrame,
    link_title: Column | None = None,
    longer_than: int = 200,
    scraped_at: str | None = None,
    sep: str = "",
) -> DataFrame:
    """Transcript records; pages without a transcript above the gate are dropped."""
    h = F.col("html")
    fallback = F.lit("Unknown Title") if link_title is None else link_title
    picked = pages.select(
        "url",
        F.coalesce(html.element_text(h, "h1"), fallback).alias("title"),
        markup.select_texts(h, [*TRANSCRIPT_SELECTORS, DATE_UNION], sep).alias("_t"),
    )
    bodies = F.slice("_t", 1, len(TRANSCRIPT_SELECTORS))
    body = F.try_element_at(
        F.filter(bodies, lambda x: F.length(x) > longer_than), F.lit(1)
    )
    return (
        picked.select(
            "title",
            "url",
            F.coalesce(F.element_at("_t", -1), F.lit("")).alias("date"),
            body.alias("transcript"),
            _stamp(scraped_at).alias("scraped_at"),
        )
        .where(F.col("transcript").isNotNull())
        .withColumn("word_count", word_count(F.col("transcript")))
    )


def extract_transcript_blocks(
    pages: DataFrame, scraped_at: str | None = None, sep: str = ""
) -> DataFrame:
    """The earlier transcript record: first matching block, else the main content."""
    h = F.col("html")
    selectors = [*TRANSCRIPT_BLOCKS, MAIN_CONTENT, *DATE_SELECTORS]
    picked = pages.select(
        "url",
        html.page_title(h).alias("title"),
        markup.select_texts(h, selectors, sep).alias("_t"),
    )
    n = len(TRANSCRIPT_BLOCKS)
    block = F.coalesce(*(F.col("_t")[i] for i in range(n)))
    date = F.coalesce(*(F.col("_t")[n + 1 + i] for i in range(len(DATE_SELECTORS))))
    return picked.select(
        "title",
        "url",
        F.coalesce(date, F.lit("")).alias("date"),
        F.coalesce(blank_to_null(block), F.col("_t")[n], F.lit("")).alias("transcript"),
        _stamp(scraped_at).alias("scraped_at"),
    )


def variant_text(v: Column, path: str) -> Column:
    """A scalar field as text, a list as its JSON text; null when empty, zero or absent."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    text = F.when(
        kind.rlike("^(ARRAY|OBJECT)"), F.to_json(F.try_variant_get(v, path, "variant"))
    ).otherwise(F.try_variant_get(v, path, "string"))
    return let(text, lambda t: F.when(~t.isin("", "0", "0.0", "false", "[]", "{}"), t))


def variant_words(v: Column, path: str) -> Column:
    """A scalar field as text, a list joined by spaces; null when empty or absent."""
    return F.coalesce(
        blank_to_null(F.array_join(F.try_variant_get(v, path, "array<string>"), " ")),
        variant_text(v, path),
    )


def as_string_array(v: Column, path: str) -> Column:
    """A list as strings, one string as a list of one, anything else as []."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    empty = F.expr("cast(array() as array<string>)")
    return F.coalesce(
        F.when(
            F.startswith(kind, F.lit("ARRAY")), F.try_variant_get(v, path, "array<string>")
        ).when(kind == "STRING", F.array(F.try_variant_get(v, path, "string"))),
        empty,
    )


# Field cascades of recording metadata.
DATE_FIELDS = ("date", "performance_date", "year", "coverage")
VENUE_FIELDS = ("venue", "location", "coverage", "spatial")
SETLIST_FIELDS = ("setlist", "notes", "lineage", "track")
OLD_SETLIST_FIELDS = ("setlist", "tracklist", "lineage")
PASS_THROUGH = ("creator", "source", "taper", "transferer", "runtime")


def extract_recording(items: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Recording records from (identifier, metadata VARIANT)."""
    v = F.col(metadata)

    def cascade(fields: Sequence[str]) -> Column:
        return F.coalesce(*(variant_text(v, f"$.{f}") for f in fields))

    setlist = concat_fields(*(variant_words(v, f"$.{f}") for f in SETLIST_FIELDS))
    return empty_for_null(
        items.select(
            "identifier",
            variant_text(v, "$.title").alias("title"),
            cascade(DATE_FIELDS).alias("date"),
            cascade(VENUE_FIELDS).alias("venue"),
            html.html_text(setlist).alias("setlist"),
            html.html_text(variant_words(v, "$.description")).alias("description"),
            as_string_array(v, "$.subject").alias("subject"),
            *(variant_text(v, f"$.{f}").alias(f) for f in PASS_THROUGH),
        )
    )


def variant_list(v: Column, path: str) -> Column:
    """A list field as strings, a scalar as a list of one; null when empty or absent."""
    found = F.coalesce(
        F.try_variant_get(v, path, "array<string>"),
        F.array(variant_text(v, path)),
    )
    return F.when((F.size(found) > 0) & F.exists(found, lambda x: x.isNotNull()), found)


def extract_recording_old(
    items: DataFrame, metadata: str = "metadata", lists: bool = False
) -> DataFrame:
    """The earlier recording record: first setlist field, raw text, download counters.

    ``lists`` gives description and setlist as lists whose elements are cleaned one
    by one, a single text as a list of one, [] where there is none.
    """
    v = F.col(metadata)

    def number(field: str, kind: str) -> Column:
        return F.coalesce(F.try_variant_get(v, f"$.{field}", kind), F.lit(0).cast(kind))

    def cleaned(*fields: str) -> Column:
        if lists:
            found = F.coalesce(*(variant_list(v, f"$.{f}") for f in fields))
            return F.coalesce(html.html_texts(found, None), F.expr("cast(array() as array<string>)"))
        return html.html_text(F.coalesce(*(variant_words(v, f"$.{f}") for f in fields)), None)

    error = F.when(v.isNull(), F.lit("no metadata"))
    records = empty_for_null(
        items.select(
            "identifier",
            *(variant_text(v, f"$.{f}").alias(f) for f in ("title", "date", "venue")),
            cleaned("description").alias("description"),
            as_string_array(v, "$.subject").alias("subject"),
            cleaned(*OLD_SETLIST_FIELDS).alias("setlist"),
            variant_text(v, "$.creator").alias("creator"),
            as_string_array(v, "$.collection").alias("collection"),
            *(variant_text(v, f"$.{f}").alias(f) for f in ("mediatype", "year", "source", "uploader")),
            number("downloads", "bigint").alias("downloads"),
            number("avg_rating", "double").alias("avg_rating"),
            number("num_reviews", "bigint").alias("num_reviews"),
            error.alias("_error"),
        )
    )
    return records.withColumn("error", F.nullif("_error", F.lit(""))).drop("_error")


def repo_manifest(repos: DataFrame) -> DataFrame:
    """One manifest row per repository with the documented defaults."""
    def has(name: str) -> bool:
        return name in repos.columns

    def field(name: str, default, kind: str) -> Column:
        fill = F.lit(default).cast(kind)
        return F.coalesce(F.col(name).cast(kind), fill) if has(name) else fill

    topics = F.expr("cast(array() as array<string>)")
    return repos.select(
        F.col("full_name").alias("name"),
        field("description", "No description", "string").alias("description"),
        "clone_url",
        field("stargazers_count", 0, "bigint").alias("stars"),
        field("forks_count", 0, "bigint").alias("forks"),
        field("language", "Unknown", "string").alias("language"),
        field("created_at", "", "string").alias("created_at"),
        field("updated_at", "", "string").alias("updated_at"),
        field("size", 0, "bigint").alias("size"),
        (F.coalesce("topics", topics) if has("topics") else topics).alias("topics"),
        (
            F.coalesce(F.col("license")["name"], F.lit("No license"))
            if has("license") else F.lit("No license")
        ).alias("license"),
        field("archived", False, "boolean").alias("archived"),
        field("private", False, "boolean").alias("private"),
    )


def by_stars(manifest: DataFrame, tie: str = "name") -> DataFrame:
    """Most starred first, ties in a given order."""
    return manifest.orderBy(F.desc("stars"), F.asc(tie))


def write_manifest_document(
    manifest: DataFrame, path: str, timestamp: str, tie: str = "name"
) -> None:
    """One JSON document, spread over ordered text parts (read them by name).

    The document is a head line, one line per repository and a closing line, so no
    task ever holds the whole list.
    """
    numbered = number_rows(manifest, [F.desc("stars"), F.asc(tie)], "_n")
    total = numbered.count()
    record = F.to_json(F.struct(*manifest.columns), {"ignoreNullFields": "false"})
    body = numbered.select(
        F.lit(1).alias("section"),
        F.col("_n").alias("a"),
        F.when(F.col("_n") == 1, record).otherwise(F.concat(F.lit(","), record)).alias("line"),
    )
    head = f'{{"timestamp": "{timestamp}", "total_repos": {total}, "repositories": ['
    frame = manifest.sparkSession.createDataFrame(
        [(0, 0, head), (2, 0, "]}")], "section int, a long, line string"
    )
    write_in_order(frame.unionByName(body), "line", ["section", "a"], path)
