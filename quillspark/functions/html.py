"""Markup expressions: text, links, titles, embedded JSON and definition lists.

Fixed tags are read with regular expressions inside the JVM. Selectors that need
the element tree go through one Arrow-batched helper (see ``markup``).
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.text import blank_to_null, let, strip

# One opening, closing or declaration tag. A value quoted after '=' may hold '>'; other
# quotes, as in an unquoted value, are characters like any other. The loops are
# possessive, so that Java runs them without recursion.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
TAG = rf"<[a-zA-Z/!?]{_INSIDE}"
OPENING = _INSIDE
HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
LINK = rf"(?is)<a\b{OPENING}.*?(?:</a\s*>|(?=<a\b)|\z)"
MARK = "\x01"
BREAK = "\x02"
# White space and marks as one class: an alternation under '+' would recurse.
GAPS = rf"[\s\x1c-\x1f{MARK}]"
# The tags that end a paragraph of visible text.
BLOCKS = (
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li "
    "main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title "
    "tr ul"
).split()
BLOCK_TAG = rf"(?i)</?(?:{'|'.join(BLOCKS)})(?=[\s/>]){_INSIDE}"
# What numeric references 128 to 159 stand for; five stand for themselves.
WINDOWS_1252 = {
    n: char for n in range(128, 160) if (char := bytes([n]).decode("cp1252", "ignore"))
}

def _entity_map() -> Column:
    """Named entities as one folded map literal, the frequent ones first."""
    frequent = ["amp", "lt", "gt", "quot", "apos", "nbsp"]
    names = {n.rstrip(";"): v for n, v in html5.items()}
    ordered = {n: names.pop(n) for n in frequent} | names
    return F.from_json(F.lit(json.dumps(ordered)), "map<string,string>")


REFERENCE = r"^(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);?"


def unescape(c: Column) -> Column:
    """Decode named and numeric character references in one pass."""
    table = _entity_map()

    def numeric(name: Column) -> Column:
        code = F.when(
            name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10).try_cast("int")
        ).otherwise(F.substr(name, F.lit(2)).try_cast("int"))
        return let(
            code,
            lambda n: F.when(n.between(128, 159), F.coalesce(
                F.get(F.array(*(F.lit(WINDOWS_1252.get(k)) for k in range(128, 160))), n - 128),
                F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"),
            )).when(
                n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF),
                F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"),
            ),
        )

    def character(name: Column) -> Column:
        return F.when(F.startswith(name, F.lit("#")), numeric(name)).otherwise(
            F.try_element_at(table, name)
        )

    def piece(x: Column) -> Column:
        def replaced(whole: Column) -> Column:
            return let(
                let(F.rtrim(whole, F.lit(";")), character),
                lambda char: F.when(char.isNull(), F.concat(F.lit("&"), x)).otherwise(
                    F.concat(char, F.substr(x, F.length(whole) + 1))
                ),
            )

        return let(F.regexp_extract(x, REFERENCE, 0), replaced)

    def decoded(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, 2, F.size(parts)), piece)
        return F.concat(F.element_at(parts, 1), F.array_join(rest, ""))

    return let(
        c,
        lambda x: F.when(F.contains(x, F.lit("&")), let(F.split(x, "&"), decoded)).otherwise(x),
    )


def visible(c: Column) -> Column:
    """Markup without comments, scripts, styles and templates."""
    return F.regexp_replace(c, HIDDEN, MARK)


def _marked(markup: Column) -> Column:
    return F.regexp_replace(markup, TAG, MARK)


def _joined(marked: Column, sep: str | None) -> Column:
    """Decoded text pieces, still with marks between them, put together."""
    if sep is None:
        return strip(F.replace(marked, F.lit(MARK)))
    if sep == " ":
        # Any run of marks and white space ends up as one space.
        return F.trim(F.regexp_replace(marked, rf"(?U){GAPS}++", " "))
    # A run of white space is looked at from its start only.
    pieces = F.regexp_replace(
        marked, rf"(?U)(?<![\s\x1c-\x1f])[\s\x1c-\x1f]*+{MARK}{GAPS}*+", sep)
    return strip(pieces)


def text_of(markup: Column, sep: str | None) -> Column:
    """Text of markup whose hidden parts are already gone."""
    return _joined(unescape(_marked(markup)), sep)


def html_text(c: Column, sep: str | None = " ") -> Column:
    """Visible text of an HTML fragment.

    ``' '``: pieces stripped, joined by a space, white space collapsed.
    ``''``: stripped pieces glued together. ``None``: raw pieces, outer strip only.
    """
    return text_of(visible(F.replace(c, F.lit(MARK))), sep)


def html_texts(c: Column, sep: str | None = " ") -> Column:
    """``html_text`` of every element of a list; null elements stay, a null list is null."""
    return F.transform(c, lambda x: html_text(x, sep))


def _raw_attribute(tag: Column, name: str) -> Column:
    """The attribute's text, found by passing over the attributes before it one by one."""
    value = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
    others = rf"(?:[\s/]*+(?!{name}\s*+=)[^\s=/>]++(?:\s*+=\s*+{value})?+)*+"
    pattern = (
        rf"""(?is)^<[a-z][^\s/>]*+{others}[\s/]*+{name}\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))"""
    )
    value = F.concat(*(F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)))
    return F.when(tag.rlike(pattern), value)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag; null when the attribute is absent."""
    return unescape(_raw_attribute(tag, name))


def links_of(c: Column) -> Column:
    """Links with a target, in page order: array of (pos, href, title, text)."""
    return visible_links(visible(c))


def visible_links(v: Column) -> Column:
    found = F.regexp_extract_all(v, F.lit(LINK), F.lit(0))

    def link(m: Column, i: Column) -> Column:
        raw = let(
            F.regexp_extract(m, rf"(?is)^<a\b{OPENING}", 0),
            lambda tag: F.array(_raw_attribute(tag, "href"), _raw_attribute(tag, "title"), _marked(m)),
        )
        return let(
            F.transform(raw, unescape),
            lambda x: F.struct(
                i.cast("int").alias("pos"),
                x[0].alias("href"),
                F.coalesce(x[1], F.lit("")).alias("title"),
                _joined(x[2], "").alias("text"),
            ),
        )

    return F.filter(F.transform(found, link), lambda x: x["href"].isNotNull())


def element_text(c: Column, tag: str, sep: str = "") -> Column:
    """Text of the first ``tag`` element, null when there is none."""
    return let(visible(c), lambda v: visible_element(v, tag, sep))


def _raw_element(v: Column, tag: str) -> Column:
    return blank_to_null(F.regexp_extract(v, rf"(?is)<{tag}\b{OPENING}.*?(?:</{tag}\s*>|\z)", 0))


def visible_element(v: Column, tag: str, sep: str = "") -> Column:
    return text_of(_raw_element(v, tag), sep)


def page_text(c: Column) -> Column:
    """All visible text: block tags and line breaks part paragraphs, set apart by blank lines."""
    clean = F.translate(c, MARK + BREAK, "")
    broken = F.regexp_replace(visible(clean), BLOCK_TAG, BREAK)

    def joined(pieces: Column) -> Column:
        texts = F.transform(pieces, lambda x: F.trim(F.regexp_replace(x, rf"(?U){GAPS}++", " ")))
        return F.array_join(F.filter(texts, lambda x: x != ""), "\n\n")

    return let(F.split(unescape(_marked(broken)), BREAK), joined)


def page_title(c: Column, default: str = "Unknown Title") -> Column:
    """Text of the first heading, else of the title element, else the default."""
    return let(visible(c), lambda v: visible_title(v, default))


def visible_title(v: Column, default: str) -> Column:
    heading = F.coalesce(_raw_element(v, "h1"), _raw_element(v, "title"))
    return F.coalesce(text_of(heading, ""), F.lit(default))


def clean_title(c: Column, suffix: str | None = None) -> Column:
    """Title without the repeated site name."""
    return strip(F.replace(c, F.lit(suffix))) if suffix else strip(c)


def brackets_of(c: Column, word: str | None = None) -> Column:
    """All ``[bracketed]`` texts, optionally those naming ``word``."""
    found = F.regexp_extract_all(c, F.lit(r"\[([^\]]+)\]"), F.lit(1))
    if word is None:
        return found
    return F.filter(found, lambda x: F.contains(F.lower(x), F.lit(word.lower())))


def json_ld(c: Column) -> Column:
    """struct(name, description, creator, date, type, keywords) of the embedded JSON block.

    A field that the block does not have is null, so callers can fall through.
    """
    pattern = r"""(?is)<script\b[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script"""
    def fields(block: Column) -> Column:
        def field(path: str) -> Column:
            return F.try_variant_get(block, path, "string")

        def kind(path: str) -> Column:
            return F.schema_of_variant(F.try_variant_get(block, path, "variant"))

        creator = F.when(
            F.startswith(kind("$.creator"), F.lit("OBJECT")), field("$.creator.name")
        ).when(kind("$.creator") == "STRING", field("$.creator"))
        keywords = F.when(
            F.startswith(kind("$.keywords"), F.lit("ARRAY")),
            F.try_variant_get(block, "$.keywords", "array<string>"),
        ).when(field("$.keywords").isNotNull(), F.array(field("$.keywords")))
        return F.struct(
            field("$.name").alias("name"),
            field("$.description").alias("description"),
            creator.alias("creator"),
            F.coalesce(field("$.datePublished"), field("$.dateCreated")).alias("date"),
            field("$.genre").alias("type"),
            keywords.alias("keywords"),
        )

    return let(F.try_parse_json(blank_to_null(F.regexp_extract(c, pattern, 1))), fields)


CELL = r"(?is)<d[td]\b[^>]*>.*?(?:</d[td]\s*>|(?=<d[td]\b)|\z)"
LIST_END = r"(?i)</?dl\b[^>]*>"


def definition_pairs(c: Column, sep: str = "") -> Column:
    """(key, value) of every ``dt`` and the next ``dd`` of its list, in page order; keys lower-cased."""
    return visible_pairs(visible(c), sep)


def visible_pairs(v: Column, sep: str) -> Column:
    """A term without a ``dd`` before its list ends, or another list begins, has no pair."""
    def is_term(x: Column) -> Column:
        return x.rlike(r"(?i)^<dt\b")

    def pairs(cells: Column) -> Column:
        def pair(x: Column, i: Column) -> Column:
            later = F.filter(F.slice(cells, i + 2, F.size(cells)), lambda y: ~is_term(y))
            value = F.when(is_term(x), F.try_element_at(later, F.lit(1)))
            texts = F.transform(F.array(x, value), lambda y: text_of(y, sep))
            return let(
                texts,
                lambda t: F.when(
                    t[1].isNotNull(), F.struct(F.lower(t[0]).alias("key"), t[1].alias("value"))
                ),
            )

        return F.filter(F.transform(cells, pair), lambda p: p.isNotNull())

    def list_pairs(part: Column) -> Column:
        return let(F.regexp_extract_all(part, F.lit(CELL), F.lit(0)), pairs)

    return F.flatten(F.transform(F.split(v, LIST_END), list_pairs))


def definition_slot(key: Column) -> Column:
    """The record slot a definition key belongs to, null when it belongs to none."""
    def has(word: str) -> Column:
        return F.contains(key, F.lit(word))

    return (
        F.when(has("creator"), "creator")
        .when(has("date"), "date")
        .when(has("type") | has("format"), "type")
        .when(has("description"), "description")
        .when(has("tag") | has("subject"), "tags")
    )
