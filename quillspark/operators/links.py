"""Link tables: extraction, candidates, attachments and bracketed transcript links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import html, markup, urls
from quillspark.functions.text import let
from quillspark.operators.firstwins import dedup_first

# Generic link titles that name no episode.
STOP_TITLES = ("more", "read more", "listen")
# Downloadable file types.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".webp")
DOCUMENT_EXTENSIONS = (".pdf", ".doc", ".docx", ".txt", ".rtf", ".odt")


def extract_links(
    pages: DataFrame, base: Column | None = None, pattern: str | None = None
) -> DataFrame:
    """(page_id, pos, url, title, text) of every link, made absolute.

    ``pattern`` keeps links whose target matches it (item links, episode links).
    """
    base = F.col("url") if base is None else base
    links = pages.select(
        "page_id", base.alias("_base"), F.explode(html.links_of(F.col("html"))).alias("_l")
    )
    if pattern:
        links = links.where(F.col("_l.href").rlike(pattern))
    return links.select(
        "page_id",
        F.col("_l.pos").alias("pos"),
        urls.url_join(F.col("_base"), F.col("_l.href")).alias("url"),
        F.col("_l.title").alias("title"),
        F.col("_l.text").alias("text"),
    )


def distinct_links(links: DataFrame) -> DataFrame:
    """Each target once per page, at its first position."""
    return dedup_first(links, ["page_id", "url"], ["pos"])


def first_targets(links: Column, order: Sequence[str] = ("pos",)) -> Column:
    """The links of one page, each ``url`` once, the first in ``order``, which is unique in the array.

    Sorted inside the row and kept where the target changes, so nothing is shuffled
    and a page with very many links costs no square of them.
    """
    rest = ("pos", "title", "text")
    keyed = F.transform(links, lambda x: F.struct(
        x["url"].alias("url"), F.struct(*[x[o].alias(o) for o in order]).alias("at"),
        F.struct(*[x[r].alias(r) for r in rest]).alias("rest")))
    return let(F.array_sort(keyed), lambda s: F.filter(
        s, lambda x, i: (i == 0) | ~x["url"].eqNullSafe(F.get(s, i - 1)["url"])))


def _absolute(base: Column, link: Column, title: Column, *more: Column) -> Column:
    return F.struct(
        urls.url_join(base, link["href"]).alias("url"), link["pos"].alias("pos"), title.alias("title"),
        link["text"].alias("text"), *more)


def item_links(pages: DataFrame, pattern: str = r"/items/show/(\d+)", base: Column | None = None):
    """Distinct item links of listing pages; a page is one row, so no shuffle is needed.

    Null markup has no links. Rows that repeat a page repeat its links.
    """
    base = F.col("url") if base is None else base
    found = F.filter(html.links_of(F.col("html")), lambda x: x["href"].rlike(pattern))
    made = F.transform(found, lambda x: _absolute(F.col("_base"), x, x["title"]))
    return (
        pages.select("page_id", base.alias("_base"), "html")
        .select("page_id", F.explode(first_targets(made)).alias("_l"))
        .select("page_id", "_l.rest.pos", "_l.url", "_l.rest.title", "_l.rest.text")
    )


def episode_links(
    pages: DataFrame, contains: str, longer_than: int = 5, base: Column | None = None
) -> DataFrame:
    """Links whose raw target contains a string and whose text is a real title."""
    base = F.col("url") if base is None else base
    links = pages.select(
        "page_id", base.alias("_base"), F.explode(html.links_of(F.col("html"))).alias("_l")
    ).where(F.contains(F.col("_l.href"), F.lit(contains)) & (F.length("_l.text") > longer_than))
    return dedup_first(
        links.select(
            "page_id",
            F.col("_l.pos").alias("pos"),
            urls.url_join(F.col("_base"), F.col("_l.href")).alias("url"),
            F.col("_l.text").alias("title"),
        ),
        ["url"],
        ["page_id", "pos"],
    )


def link_candidates(
    pages: DataFrame,
    selectors: Sequence[str] | None = None,
    href_contains: Sequence[str] | None = None,
    container: str | None = None,
    stop_titles: Sequence[str] = STOP_TITLES,
    longer_than: int = 5,
    base: Column | None = None,
) -> DataFrame:
    """Links of several selectors, the earlier selector first; title attribute before text.

    ``href_contains`` stays in the JVM; ``selectors`` may look at the element tree.
    A target is listed once per page, after the title gate; a page is one row, so
    nothing is shuffled.
    """
    base = F.col("url") if base is None else base
    if selectors:
        found = markup.select_links(F.col("html"), selectors, container)
    else:
        tests = lambda x: F.coalesce(*[
            F.when(F.contains(x["href"], F.lit(part)), F.lit(i)) for i, part in enumerate(href_contains or [""])])
        found = F.transform(html.links_of(F.col("html")), lambda x: x.withField("sel", tests(x)))

    def made(x: Column) -> Column:
        title = F.coalesce(F.nullif(x["title"], F.lit("")), x["text"])
        return _absolute(F.col("_base"), x, title, x["sel"].alias("sel"))

    gated = F.filter(F.transform(found, made), lambda x: (
        x["sel"].isNotNull() & (F.length(x["title"]) > longer_than) & ~F.lower(x["title"]).isin(*stop_titles)))
    return (
        pages.select("page_id", base.alias("_base"), "html")
        .select("page_id", F.explode(first_targets(gated, ("sel", "pos"))).alias("_l"))
        .select("page_id", "_l.at.sel", "_l.rest.pos", "_l.url", "_l.rest.title", "_l.rest.text")
    )


def bracket_links(
    pages: DataFrame, word: str = "transcript", base: Column | None = None
) -> DataFrame:
    """Links whose text contains a bracketed text naming ``word``, one row per pair.

    Both sides come from the same page, so the containment test runs inside the
    row and nothing is shuffled.
    """
    base = F.col("url") if base is None else base
    links, names = html.links_of(F.col("html")), html.brackets_of(F.col("html"), word)
    pairs = F.transform(
        F.col("_names"),
        lambda n, i: F.transform(
            F.filter("_links", lambda x: F.contains(x["text"], n)),
            lambda x: F.struct(i.alias("bracket_pos"), n.alias("bracket"), x.alias("link")),
        ),
    )
    return (
        pages.select("page_id", base.alias("_base"), links.alias("_links"), names.alias("_names"))
        .where(F.size("_names") > 0)
        .select("page_id", "_base", F.explode(F.flatten(pairs)).alias("_p"))
        .select(
            "page_id",
            F.col("_p.bracket_pos").alias("bracket_pos"),
            F.col("_p.link.pos").alias("pos"),
            urls.url_join(F.col("_base"), F.col("_p.link.href")).alias("url"),
            F.concat(F.lit("Transcript: "), F.col("_p.bracket")).alias("title"),
            F.col("_p.link.text").alias("text"),
        )
    )


def attachment_array(
    markup_column: Column,
    base: Column,
    images: Sequence[str] = IMAGE_EXTENSIONS,
    documents: Sequence[str] = DOCUMENT_EXTENSIONS,
) -> Column:
    """array of (url, filename, extension, type) for links to downloadable files."""
    def described(link: Column) -> Column:
        def named(url: Column) -> Column:
            path = F.regexp_replace(urls.path_of(url), r";[^/]*$", "")
            return F.struct(
                url.alias("url"),
                urls.path_name(path).alias("filename"),
                urls.path_suffix(path).alias("extension"),
                F.when(urls.path_suffix(path).isin(*images), "image")
                .otherwise("document").alias("type"),
            )

        return let(urls.url_join(base, link["href"]), named)

    found = F.transform(
        F.filter(html.links_of(markup_column), lambda x: x["href"] != ""), described
    )
    return F.filter(found, lambda a: a["extension"].isin(*images, *documents))


def extract_attachments(pages: DataFrame, base: Column | None = None) -> DataFrame:
    """One row per attachment with its collision-free target path."""
    base = F.col("url") if base is None else base
    return (
        pages.select(
            "page_id",
            "url",
            F.posexplode(attachment_array(F.col("html"), base)).alias("pos", "_a"),
        )
        .select("page_id", "pos", F.col("url").alias("_page"), "_a.*")
        .withColumn(
            "local_path",
            urls.attachment_target(F.col("url"), F.col("filename"), urls.item_id(F.col("_page"))),
        )
        .drop("_page")
    )
