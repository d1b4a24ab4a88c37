"""The query registry and the SQL fragments shared by the checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its independent formulation."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


# --- SQL fragments -----------------------------------------------------------

STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_clean(x: str) -> str:
    """Blank-line and space runs collapsed, ends stripped."""
    lines = rf"regexp_replace({x}, '\n\s*\n\s*\n+', chr(10) || chr(10), 'g')"
    return sql_strip(rf"regexp_replace({lines}, '[ \t]+', ' ', 'g')")


def sql_visible(x: str) -> str:
    hidden = r"(?s)<!--.*?-->|<style[^>]*>.*?</style>|<script[^>]*>.*?</script>"
    return f"regexp_replace({x}, '{hidden}', chr(1), 'g')"


def sql_unescape(x: str) -> str:
    """The entities that occur in the tables; the ampersand last."""
    for name, char in (
        ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"),
    ):
        x = f"replace({x}, '{name}', '{char}')"
    return f"replace({x}, '&amp;', '&')"


def sql_text(x: str, sep: str | None = " ") -> str:
    """Text of markup without hidden parts."""
    marked = sql_unescape(f"regexp_replace({x}, '<[a-zA-Z/!][^>]*>', chr(1), 'g')")
    if sep is None:
        return sql_strip(f"replace({marked}, chr(1), '')")
    if sep == " ":
        return rf"trim(regexp_replace({marked}, '[\s\x01]+', ' ', 'g'))"
    return sql_strip(rf"regexp_replace({marked}, '\s*\x01[\s\x01]*', '{sep}', 'g')")


def sql_chunks(x: str, size: int = 1500) -> str:
    """Greedy paragraph packing as a fold over chunk lists."""
    return rf"""list_filter(list_transform(list_reduce(
        list_transform(string_split({x}, chr(10) || chr(10)), lambda p: [p]),
        lambda a, b: CASE
          WHEN a[len(a)] = '' THEN list_concat(a[1:len(a) - 1], b)
          WHEN length(a[len(a)]) + length(b[1]) + 2 > {size} THEN list_concat(a, b)
          ELSE list_concat(a[1:len(a) - 1], [a[len(a)] || chr(10) || chr(10) || b[1]]) END),
        lambda c: {sql_strip('c')}), lambda c: c <> '')"""


# Files derived from documents: one repository per source.
FILES_SQL = """
  SELECT doc_id, source AS repo,
    'f/' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.md' ELSE '.txt' END AS path,
    replace(text, chr(10), chr(10) || chr(10)) AS content
  FROM documents"""

# Internal links of pages: every target is root-relative.
AUTHORITY_SQL = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
NORMAL_SQL = "regexp_extract(url, '^([^?#]*)', 1)"
LINKS_SQL = rf"""
  SELECT page_id, url, unnest(hrefs) AS href, unnest(texts) AS text,
    unnest(range(len(hrefs))) AS pos
  FROM (SELECT page_id, url,
      regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 1) AS hrefs,
      regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 2) AS texts
    FROM pages)"""
EDGES_SQL = rf"""
  SELECT {NORMAL_SQL} AS source,
    regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || regexp_replace(href, ';[^/]*$', '') AS target,
    min(pos) AS pos
  FROM ({LINKS_SQL}) GROUP BY 1, 2"""
