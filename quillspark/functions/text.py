"""Text expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The code points Python's str.strip() and str.split() treat as white space.
WHITE_SPACE_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITE_SPACE = "".join(map(chr, WHITE_SPACE_CODES))
# The same set as a Java character class; needs the (?U) flag.
WS = r"[\s\x1c-\x1f]"

# Relevance keywords of the structured-file gate.
RELEVANCE_KEYWORDS = ("grateful", "dead", "setlist", "song", "show", "date", "venue")


PARAGRAPH = "\n\n"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Spark repeats a column expression at every use inside a lambda; a one-element
    array binds it to a variable instead.
    """
    return F.transform(F.array(value), body)[0]


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and projections will not repeat.

    Filters and projections are merged through a plain projection, with the
    expression copied into each; a one-element generator keeps it in place.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def strip(c: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def collapse_ws(c: Column) -> Column:
    """Every run of white space becomes one space; ends are stripped."""
    return F.trim(F.regexp_replace(c, rf"(?U){WS}+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column, markdown: bool | Column = False) -> Column:
    """Blank-line and space runs collapsed; badge lines and comments of Markdown dropped.

    ``markdown`` may be a boolean column, so that mixed files need one pass only.
    """
    paragraphs = F.regexp_replace(c, rf"(?U)\n{WS}*\n{WS}*\n+", "\n\n")
    spaced = F.regexp_replace(paragraphs, r"[ \t]+", " ")
    if isinstance(markdown, Column) or markdown:
        no_badges = F.regexp_replace(
            spaced, rf"(?Umd)^{WS}*\[!\[.*?\]\(.*?\)\]\(.*?\){WS}*$", ""
        )
        no_comments = F.regexp_replace(no_badges, r"(?s)<!--.*?-->", "")
        if isinstance(markdown, Column):
            spaced = F.when(markdown, no_comments).otherwise(spaced)
        else:
            spaced = no_comments
    return strip(spaced)


def word_count(c: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(c, F.lit(r"(?U)[^\s\x1c-\x1f]+")).cast("bigint")


def min_length(c: Column, n: int) -> Column:
    """Predicate: at least ``n`` characters (code points)."""
    return F.length(c) >= n


def keyword_relevant(
    c: Column, keywords: Sequence[str] = RELEVANCE_KEYWORDS, first_chars: int | None = None
) -> Column:
    """Predicate: any keyword occurs as a substring of the lower-cased text.

    ``first_chars`` bounds the scope, as the gate for delimited files does.
    """
    scope = F.lower(c if first_chars is None else F.substring(c, 1, first_chars))
    return reduce(lambda a, b: a | b, (F.contains(scope, F.lit(k)) for k in keywords))


def chunk_text(c: Column, max_length: int = 1500) -> Column:
    """Greedy paragraph packing into chunks of up to ``max_length`` characters.

    The fold runs over paragraph lengths and carries only cut positions, so no
    text is copied until the chunks are sliced out. A paragraph above the limit
    stays whole. Empty leading paragraphs of a chunk are replaced, not joined.
    """
    gap = len(PARAGRAPH)
    start = F.struct(
        F.expr("cast(array() as array<struct<a:int,b:int>>)").alias("cuts"),
        F.lit(1).alias("first"),
        F.lit(0).alias("at"),
        F.lit(0).alias("n"),
    )

    def step(acc: Column, p: Column) -> Column:
        here = acc["at"] + 1
        size = F.length(p)
        over = acc["n"] + size + gap > max_length
        fresh = over | (acc["n"] == 0)
        return F.struct(
            F.when(
                over & (acc["n"] > 0),
                F.array_append(
                    acc["cuts"], F.struct(acc["first"].alias("a"), acc["at"].alias("b"))
                ),
            ).otherwise(acc["cuts"]).alias("cuts"),
            F.when(fresh, here).otherwise(acc["first"]).alias("first"),
            here.alias("at"),
            F.when(fresh, size).otherwise(acc["n"] + gap + size).alias("n"),
        )

    def finish(acc: Column) -> Column:
        return F.array_append(
            acc["cuts"], F.struct(acc["first"].alias("a"), acc["at"].alias("b"))
        )

    def packed(paragraphs: Column) -> Column:
        return F.transform(
            F.aggregate(paragraphs, start, step, finish),
            lambda k: strip(
                F.array_join(F.slice(paragraphs, k["a"], k["b"] - k["a"] + 1), PARAGRAPH)
            ),
        )

    return F.filter(let(F.split(c, PARAGRAPH), packed), lambda x: x != "")


def first_date(c: Column) -> Column:
    """First ``YYYY-MM-DD`` in the text, null when there is none."""
    return blank_to_null(F.regexp_extract(c, r"\d{4}-\d{2}-\d{2}", 0))


def venue_of(c: Column) -> Column:
    """Venue named by a ``Live at <venue> on <date>`` title, null when there is none."""
    return blank_to_null(F.regexp_extract(c, r"(?d)Live at (.+?) on \d{4}-\d{2}-\d{2}", 1))


def result_total(c: Column) -> Column:
    """The total named by ``… of 1,234 results``, null when there is none."""
    digits = F.regexp_replace(F.regexp_extract(c, r"of ([\d,]+) results", 1), ",", "")
    return blank_to_null(digits).try_cast("bigint")


def page_count(c: Column, per_page: int = 25) -> Column:
    """Number of listing pages for the total named in the text."""
    return F.floor((result_total(c) + (per_page - 1)) / F.lit(per_page)).cast("bigint")


def safe_name(c: Column) -> Column:
    """A repository name usable as one folder name."""
    return F.translate(c, "/", "_")


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def first_non_empty(*cs: Column) -> Column:
    """First candidate that is neither null nor the empty string."""
    return F.coalesce(*(blank_to_null(c) for c in cs))


def concat_fields(*cs: Column, sep: str = " ") -> Column:
    """All non-empty candidates joined by ``sep``; '' when there is none."""
    return strip(F.concat_ws(sep, *(blank_to_null(c) for c in cs)))


def ratio_text(part: Column, whole: Column) -> Column:
    """``part/whole (p%)`` with one decimal, guarded for an empty whole."""
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return F.when(whole > 0, F.format_string("%d/%d (%.1f%%)", part, whole, share)).otherwise(
        F.lit("0/0 (0%)")
    )
