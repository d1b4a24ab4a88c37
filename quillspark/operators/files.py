"""File trees: gates, per-type normalisation, cleaning and counts."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import RELEVANCE_KEYWORDS, clean_text, compute_once, let, min_length
from quillspark.functions.urls import path_name, path_suffix

try:
    import yaml
except ImportError:  # YAML files are then kept as plain text.
    yaml = None

# File types and names of the repository extraction.
ALLOWED_EXTENSIONS = (".md", ".txt", ".csv", ".json", ".yaml", ".yml")
IGNORED_NAMES = (
    "license", "license.txt", "license.md", ".gitignore", ".gitattributes",
    "package-lock.json", "yarn.lock", "requirements.txt",
)
IGNORED_EXTENSIONS = (
    ".png", ".jpg", ".jpeg", ".gif", ".bmp", ".tiff", ".webp",
    ".zip", ".tar", ".gz", ".rar", ".7z",
    ".mp4", ".avi", ".mov", ".wmv", ".flv", ".webm",
    ".wav", ".mp3", ".flac", ".ogg", ".m4a",
    ".exe", ".dll", ".so", ".dylib",
    ".class", ".jar", ".war",
)
STRUCTURED = (".json", ".csv", ".yaml", ".yml")


def allowed(path: Column, extensions: Sequence[str] = ALLOWED_EXTENSIONS) -> Column:
    """Predicate: the lower-cased last suffix is on the allow list."""
    return path_suffix(path).isin(*extensions)


def ignored(
    path: Column,
    names: Sequence[str] = IGNORED_NAMES,
    extensions: Sequence[str] = IGNORED_EXTENSIONS,
) -> Column:
    """Predicate: ignored by file name (any case) or by extension."""
    return F.lower(path_name(path)).isin(*names) | path_suffix(path).isin(*extensions)


def in_repository(repo: Column, path: Column, compat: bool = False) -> Column:
    """Predicate: not below a hidden top folder nor, unless ``compat``, a ``.git`` folder."""
    visible = ~F.startswith(repo, F.lit("."))
    return visible if compat else visible & ~path.rlike(r"(^|/)\.git/")


def filter_files(files: DataFrame, compat: bool = False) -> DataFrame:
    """Files that may enter the corpus: allowed type, not ignored, inside a repository."""
    path = F.col("path")
    return files.where(
        allowed(path) & ~ignored(path) & in_repository(F.col("repo"), path, compat)
    )


def _relevant(text: str, keywords: Sequence[str]) -> bool:
    lower = text.lower()
    return any(k in lower for k in keywords)


def _json_text(text: str, keywords: Sequence[str]) -> str | None:
    try:
        data = json.loads(text)
    except ValueError:
        return None
    probe = data[0] if isinstance(data, list) and data else data
    if isinstance(probe, dict) and _relevant(str(probe), keywords):
        return json.dumps(data, indent=2, ensure_ascii=False)
    return None


def _csv_text(text: str, keywords: Sequence[str]) -> str | None:
    if not _relevant(text[:1000], keywords):
        return None
    try:
        rows = list(csv.reader(io.StringIO(text)))
    except csv.Error:
        return text
    if len(rows) < 2:
        return None
    header = rows[0]
    fitting = (row for row in rows[1:] if len(row) == len(header))
    return "\n".join(json.dumps(dict(zip(header, r)), ensure_ascii=False) for r in fitting)


def _yaml_text(text: str, keywords: Sequence[str]) -> str | None:
    if yaml is None:
        return text if text.strip() else None
    try:
        data = yaml.safe_load(text)
    except (yaml.YAMLError, ValueError):
        return None
    if data and isinstance(data, (dict, list)) and _relevant(str(data), keywords):
        return yaml.dump(data, default_flow_style=False, allow_unicode=True)
    return None


_BY_TYPE = {".json": _json_text, ".csv": _csv_text, ".yaml": _yaml_text, ".yml": _yaml_text}


def normalise_structured(
    suffix: Column, text: Column, keywords: Sequence[str] = RELEVANCE_KEYWORDS
) -> Column:
    """struct(text, failed): JSON, CSV and YAML files re-printed when relevant, else null.

    A broken file is no failure, it is irrelevant; ``failed`` marks files that the
    parser gives up on, as on nesting deeper than its stack. (Arrow batches.)
    """
    words = tuple(keywords)

    def one(kind: str, text: str | None) -> tuple[str | None, bool]:
        if kind not in _BY_TYPE or text is None:
            return None, False
        try:
            return _BY_TYPE[kind](text, words), False
        except Exception:  # one file must not end the job
            return None, True

    @F.pandas_udf("text string, failed boolean")
    def printed(suffixes: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [one(s, t) for s, t in zip(suffixes, texts)]
        return pd.DataFrame(rows, columns=["text", "failed"])

    return printed(suffix, text)


def csv_rows_to_json(header: Column, row: Column) -> Column:
    """A split row as one JSON object keyed by the header; null when widths differ.

    Of repeated header names the last value wins, at the first name's place.
    """
    def quoted(x: Column) -> Column:
        return let(F.to_json(F.array(x)), lambda j: F.substr(j, F.lit(2), F.length(j) - 2))

    def members(names: Column, cells: Column) -> Column:
        def member(name: Column) -> Column:
            last = F.size(names) - F.array_position(F.reverse(names), name) + 1
            value = F.try_element_at(cells, last.cast("int"))
            return F.concat(quoted(name), F.lit(": "), quoted(value))

        listed = F.array_join(F.transform(F.array_distinct(names), member), ", ")
        whole = F.concat(F.lit("{"), listed, F.lit("}"))
        return F.when(F.size(names) == F.size(cells), whole)

    return let(header, lambda names: let(row, lambda cells: members(names, cells)))


def normalise_file(
    files: DataFrame, keywords: Sequence[str] = RELEVANCE_KEYWORDS, text: str = "content"
) -> DataFrame:
    """Route by type: prose stays in the JVM, only structured files reach Python.

    Adds ``_suffix`` and ``_failed``, which marks files that could not be processed.
    """
    suffix = path_suffix(F.col("path"))
    structured = suffix.isin(*STRUCTURED)
    sent = F.when(structured, F.col(text))
    return (
        files.withColumn("_suffix", suffix)
        .withColumn("_printed", normalise_structured(F.col("_suffix"), sent, keywords))
        .withColumn(text, F.when(structured, F.col("_printed.text")).otherwise(F.col(text)))
        .withColumn("_failed", structured & F.col("_printed.failed"))
        .drop("_printed")
    )


def extract_files(
    files: DataFrame,
    keywords: Sequence[str] = RELEVANCE_KEYWORDS,
    shortest: int = 50,
    compat: bool = False,
    structured: bool = True,
) -> DataFrame:
    """(repo, path, content, status) of every file; content is null unless 'ok'.

    ``structured=False`` plans prose files only, without the Python step.
    """
    path = F.col("path")
    entering = allowed(path) & ~ignored(path) & in_repository(F.col("repo"), path, compat)
    gated = files.withColumn("_enters", entering).withColumn(
        "content", F.when(F.col("_enters"), F.col("content"))
    )
    if structured:
        routed = normalise_file(gated, keywords)
    else:
        routed = gated.withColumn("_suffix", path_suffix(path)).withColumn("_failed", F.lit(False))
    cleaned = clean_text(F.col("content"), F.col("_suffix") == ".md")
    done = compute_once(routed, "_clean", cleaned)
    ok = F.coalesce(min_length(F.col("_clean"), shortest), F.lit(False))
    return done.select(
        "repo",
        "path",
        F.when(ok, F.col("_clean")).alias("content"),
        F.when(ok, "ok").when(F.col("_failed"), "error").otherwise("skipped").alias("status"),
    )


def corpus_files(extracted: DataFrame) -> DataFrame:
    return extracted.where(F.col("status") == "ok").select("repo", "path", "content")


def extraction_stats(extracted: DataFrame) -> DataFrame:
    """Counters per repository and, with a null repository, for all of them.

    Files are first counted per (repository, status), so the roll-up sees a few
    rows per repository however large it is.
    """
    small = extracted.groupBy("repo", "status").agg(F.count(F.lit(1)).alias("_n"))

    def total(status: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("_n"))), F.lit(0))

    return small.rollup("repo").agg(
        F.count_distinct("repo").alias("repos_processed"),
        total("ok").alias("files_processed"),
        (total("skipped") + total("error")).alias("files_skipped"),  # an error is skipped as well
        total("error").alias("errors"),
    )
