"""The text corpus format and the consolidated transcript format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import blank_to_null, let, strip, thousands
from quillspark.operators.ordering import number_by

# The entry header line and the episode rule.
HEADER_AHEAD = r"(?d)\n(?=\[.+?\] :: \[.+?\]\n)"
HEADER_LINE = r"(?d)^\[.+?\] :: \[.+?\]\n"
HEADER_PARTS = r"(?d)^\[(.+?)\] :: \[(.+?)\]"
RULE = "=" * 80


def format_entry(repo: Column, path: Column, content: Column) -> Column:
    """One corpus entry: header line and body, ending in a line break."""
    return F.format_string("[%s] :: [%s]\n%s\n", repo, path, content)


def split_entries(text: Column) -> Column:
    """Corpus text cut before every header line."""
    return F.split(text, HEADER_AHEAD)


def parse_header(line: Column) -> Column:
    """struct(repo, path) of a header line, null when it is none."""
    repo = F.regexp_extract(line, HEADER_PARTS, 1)
    return F.when(
        repo != "",
        F.struct(repo.alias("repo"), F.regexp_extract(line, HEADER_PARTS, 2).alias("path")),
    )


def parse_entries(entries: DataFrame, text: str = "entry", shortest: int = 100) -> DataFrame:
    """(repo, path, content) of raw entries with at least two lines and a long enough body."""
    whole = strip(F.col(text))
    keep = [c for c in entries.columns if c != text]
    parsed = entries.select(
        *keep,
        parse_header(F.substring_index(whole, "\n", 1)).alias("_h"),
        F.when(F.contains(whole, F.lit("\n")), F.regexp_replace(whole, r"^[^\n]*\n", "")).alias(
            "content"
        ),
    )
    return parsed.where(
        (F.length("content") >= shortest) & F.col("_h").isNotNull()
    ).select(*keep, "_h.repo", "_h.path", "content")


def number_episodes(transcripts: DataFrame, tie: str) -> DataFrame:
    """Episode numbers in title order, missing titles first; ``tie`` is the input position."""
    return number_by(
        transcripts.withColumn("title", F.coalesce("title", F.lit(""))), ["title"], tie, "episode"
    )


def episode_text(with_rule: bool = True) -> Column:
    """Rendering of one numbered transcript row."""
    body = F.concat(
        F.lit("EPISODE "), F.col("episode").cast("string"), F.lit(": "), F.col("title"),
        F.lit("\nURL: "), F.coalesce("url", F.lit("")),
        F.coalesce(F.concat(F.lit("\nDate: "), blank_to_null(F.col("date"))), F.lit("")),
        F.lit("\nWord Count: "), F.coalesce("word_count", F.lit(0)).cast("string"),
        F.lit("\n\n"), F.col("transcript"),
    )
    return F.concat(body, F.lit(f"\n\n{RULE}\n")) if with_rule else body


def render_transcripts(
    numbered: DataFrame, heading: str = "", source: str = "", description: str = "", date: str = ""
) -> DataFrame:
    """(n, text) rows of the consolidated document, the preamble as row 0."""
    preamble = (
        f"=== {heading} ===\n\nSource: {source}\nDescription: {description}\n"
        f"Scraped: {date}\n\n{RULE}\n"
    )
    first = numbered.sparkSession.createDataFrame([(0, preamble)], "n long, text string")
    return first.unionByName(
        numbered.select(F.col("episode").alias("n"), episode_text().alias("text"))
    )


def render_plain(transcripts: DataFrame, order: str) -> DataFrame:
    """(n, text) rows of the earlier text form, without episode numbers and word counts."""
    def shown(name: str) -> Column:
        return F.coalesce(name, F.lit(""))

    text = F.concat(
        F.lit("=== "), shown("title"), F.lit(" ===\nDate: "), shown("date"),
        F.lit("\nURL: "), shown("url"), F.lit("\n\n"), shown("transcript"),
        F.lit(f"\n\n{RULE}\n"),
    )
    return transcripts.select(F.col(order).alias("n"), text.alias("text"))


def parse_episode_block(block: Column, compat: bool = False) -> Column:
    """struct(title, url, word_count, content) of one rendered episode.

    The body starts after the first blank line and keeps every line. ``compat``
    starts at the seventh line and drops body lines that look like header lines.
    """
    def is_header(x: Column) -> Column:
        return (
            F.startswith(x, F.lit("EPISODE "))
            | F.startswith(x, F.lit("URL: "))
            | F.startswith(x, F.lit("Word Count: "))
        )

    def record(header: Column, body: Column) -> Column:
        def last(prefix: str) -> Column:
            return F.try_element_at(
                F.filter(header, lambda x: F.startswith(x, F.lit(prefix))), F.lit(-1)
            )

        words = F.replace(last("Word Count: "), F.lit("Word Count: "))
        return F.struct(
            strip(last("EPISODE ")).alias("title"),
            F.replace(last("URL: "), F.lit("URL: ")).alias("url"),
            words.try_cast("bigint").alias("word_count"),
            body.alias("content"),
        )

    def from_lines(lines: Column) -> Column:
        kept = F.filter(lines, lambda x, i: (i > 5) & ~is_header(x))
        return record(lines, F.when(F.size(kept) > 0, strip(F.array_join(kept, "\n"))))

    def from_text(text: Column) -> Column:
        # Without a blank line the whole block is header and the body is null.
        at = F.instr(text, "\n\n")
        head = F.substring_index(text, "\n\n", 1)
        body = F.when(at > 0, strip(F.substr(text, at + 2)))
        return let(F.split(head, "\n"), lambda header: record(header, body))

    if compat:
        return let(F.split(strip(block), "\n"), from_lines)
    return let(strip(block), from_text)


def parse_episodes(
    blocks: DataFrame, text: str = "block", shortest_block: int = 100,
    shortest_body: int = 200, compat: bool = False,
) -> DataFrame:
    """Parsed episodes behind the length gates; blocks without a title or body are dropped."""
    keep = [c for c in blocks.columns if c != text]
    parsed = blocks.where(F.length(strip(F.col(text))) >= shortest_block).select(
        *keep, parse_episode_block(F.col(text), compat).alias("_e")
    )
    return parsed.where(
        F.col("_e.title").isNotNull() & (F.length("_e.content") >= shortest_body)
    ).select(*keep, "_e.*")


def transcript_totals(transcripts: DataFrame) -> DataFrame:
    """One row: transcripts, words, and the words with thousands separators."""
    return transcripts.agg(
        F.count(F.lit(1)).alias("transcripts"),
        F.coalesce(F.sum(F.coalesce("word_count", F.lit(0))), F.lit(0)).alias("total_words"),
    ).withColumn("total_words_text", thousands(F.col("total_words")))
