"""Quality rules: base limits and robust multivariate outliers.

Every text becomes a vector of transformed statistics. For each language and
source, location and scatter are estimated by the minimum covariance
determinant: from three starts, C-steps refit mean and covariance on the
``share`` of rows with the smallest distances, and the fit with the smallest
determinant is taken. A group's fit is drawn to that of its language, and a
language's to that of all rows, and that to fixed deviations, as if
``prior_rows`` rows of the parent were in it; groups of any size are so judged by
one rule, and no scatter is singular.
Rows whose robust Mahalanobis distance is above a cut are rejected. All sums run
over all rows and are combined before the shuffle, so a source that holds most
of the rows costs no more than the others; only one row of moments per group is
inverted in Python.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import let
from quillspark.llm.common import written

# The characters that count as symbols, and the window length.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
_SPACES = {ord(c): None for c in " \t\n\x0b\x0c\r"}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# The transformed statistics and what a clean text may deviate by where a group's
# texts do not differ; it stands in for a deviation under a tenth of it only.
FEATURES = {
    "word_length": 0.08, "symbols": 0.05, "upper": 0.06, "marks": 0.10,
    "variety": 0.05, "line_words": 0.60, "dup_lines": 0.20, "digits": 0.08,
}
NAMES = tuple(FEATURES)
_SPREAD = np.array(list(FEATURES.values())) ** 2
NO_SPREAD = 0.01  # a variance under this share of the constant's counts as none
PRIOR_WORDS = 30  # ratios of short texts are drawn to the middle by so many words


def repeat_words(words: list[bytes]) -> int:
    """Words inside windows of eight that occur twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, n)
    if len(ids) == n:
        return 0
    m = n - WINDOW + 1
    mixed = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + seq[k:k + m] + np.uint64(1)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(m, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    at = np.flatnonzero(hit)
    # Equal hashes are confirmed on the words themselves.
    rows = np.stack([seq[at + k] for k in range(WINDOW)], axis=1)
    _, where, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    at = at[counts[where.reshape(-1)] > 1]
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def text_statistics(text: str | None) -> tuple:
    """The base counts and the statistic vector of one whole text (null: an empty one)."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text.translate(_SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = dup_lines = 0
    for line in text.split("\n"):
        if line.translate(_SPACES):
            lines += 1
            if line in seen:
                dup_lines += 1
            seen.add(line)
    distinct = len(set(words))
    ascii_text = text.encode("ascii", "ignore")
    digits = len(ascii_text) - len(ascii_text.translate(None, b"0123456789"))
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    marks = sum(map(text.count, ".,;:!?"))
    drawn = n / (n + PRIOR_WORDS)
    vector = (
        drawn * math.log(chars / n / 5) if n else 0.0,
        math.sqrt(symbols / (chars + PRIOR_WORDS)),
        math.sqrt(upper / (chars + PRIOR_WORDS)),
        math.log1p(marks / (n + PRIOR_WORDS)) * 2,
        drawn * (1 - math.log(distinct) / math.log(n)) if n > 1 else 0.0,
        math.log((n + PRIOR_WORDS) / (lines + 1)),
        math.sqrt(dup_lines / (lines + 2)),
        math.sqrt(digits / (chars + PRIOR_WORDS)),
    )
    return (n, chars, symbols, dup_lines, repeat_words(words), *vector)


def statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, base counts and vector of every row; texts stay behind."""
    schema = ", ".join(
        [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
        + [f"{c} long" for c in BASE] + [f"x_{c} double" for c in NAMES]
    )
    kept = len(keep)
    types = [pa.int64()] * len(BASE) + [pa.float64()] * len(NAMES)
    names = [*keep, *BASE, *[f"x_{c}" for c in NAMES]]

    def measure(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            rows = [text_statistics(t.as_py()) for t in batch.column(kept)]
            cols = list(zip(*rows)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:kept] + [pa.array(c, t) for c, t in zip(cols, types)], names)

    return docs.select(*keep, text).mapInArrow(measure, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


# --- minimum covariance determinant ------------------------------------------

def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function, by the series of the lower incomplete gamma."""
    if x <= 0:
        return 0.0
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = 1
    while term > total * 1e-15:
        term *= half / (a + n)
        total += term
        n += 1
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 10.0 * k + 1000
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def consistency(share: float, k: int) -> float:
    """What makes the scatter of the central ``share`` of normal rows unbiased."""
    return share / chi2_cdf(chi2_quantile(share, k), k + 2)


PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]


def _distance() -> Column:
    """Squared Mahalanobis distance of the vector to ``centre`` under ``inverse``."""
    diff = [F.col(f"x_{c}") - F.get("centre", F.lit(i)) for i, c in enumerate(NAMES)]
    terms = [
        diff[i] * diff[j] * F.get("inverse", F.lit(k)) * (1.0 if i == j else 2.0)
        for k, (i, j) in enumerate(PAIRS)
    ]
    # Rounding may leave a row at the centre just below zero.
    return F.greatest(reduce(lambda a, b: a + b, terms), F.lit(0.0))


def drawn(own: tuple, parent: tuple, rows: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scatter of (n, mean, scatter), drawn to a parent's as if by so many of its rows."""
    n, mean, scatter = own
    w = n / (n + rows)
    return w * mean + (1 - w) * parent[0], w * scatter + (1 - w) * parent[1]


def _spread_out(scatter: np.ndarray) -> np.ndarray:
    """Where a statistic is constant, its variance is replaced; elsewhere the data rule."""
    none = np.diag(scatter) < NO_SPREAD * _SPREAD
    scatter = scatter.copy()
    scatter[none, :] = scatter[:, none] = 0.0
    scatter[none, none] = _SPREAD[none]
    return scatter


def _mean_scatter(n: float, sums: list, products: list, factor: float) -> tuple[float, np.ndarray, np.ndarray]:
    mean, scatter = np.array(sums) / n, np.zeros((len(NAMES),) * 2)
    for (i, j), v in zip(PAIRS, products):
        scatter[i, j] = scatter[j, i] = v / n - mean[i] * mean[j]
    return n, mean, _spread_out(scatter * factor)


def _fit(moments: DataFrame, factor: float, prior_rows: float) -> DataFrame:
    """(grp, parent, start, centre, inverse, logdet) from moments; one row per group and start."""
    names = ["n", *[f"s{i}" for i in range(len(NAMES))], *[f"q{k}" for k in range(len(PAIRS))]]
    added = [F.sum(c).alias(c) for c in names]
    packed = lambda name: F.array(*names).alias(name)
    above = moments.groupBy("parent", "start").agg(*added)
    top = above.groupBy("start").agg(*added)
    joined = (
        moments.select("grp", "parent", "start", packed("own"))
        .join(above.select("parent", "start", packed("up")), ["parent", "start"])
        .join(top.select("start", packed("top")), "start")
        .select("grp", "parent", "start", "own", "up", "top")
    )
    p = len(NAMES)

    def invert(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out = []
            for g, parent, start, *levels in zip(*(c.to_pylist() for c in batch.columns)):
                own, up, top = (_mean_scatter(m[0], m[1:p + 1], m[p + 1:], factor) for m in levels)
                whole = drawn(top, (top[1], np.diag(_SPREAD)), prior_rows)
                centre, scatter = drawn(own, drawn(up, whole, prior_rows), prior_rows)
                inverse = np.linalg.inv(scatter)
                out.append((g, parent, start, centre.tolist(), [float(inverse[i, j]) for i, j in PAIRS],
                            float(np.linalg.slogdet(scatter)[1])))
            cols = list(zip(*out)) or [()] * 6
            floats = pa.list_(pa.float64())
            types = [pa.string(), pa.string(), pa.int32(), floats, floats, pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], ["grp", "parent", "start", "centre", "inverse", "logdet"])

    return joined.mapInArrow(
        invert, "grp string, parent string, start int, centre array<double>, inverse array<double>, logdet double")


def _moments(rows: DataFrame) -> DataFrame:
    x = [F.col(f"x_{c}") for c in NAMES]
    return rows.groupBy("grp", "parent", "start").agg(
        F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(x)],
        *[F.sum(x[i] * x[j]).alias(f"q{k}") for k, (i, j) in enumerate(PAIRS)],
    )


def _starts(rows: DataFrame, factor: float, prior_rows: float) -> DataFrame:
    """Three first fits per group: scaled deviations without correlations, the moments of all
    rows, and those of the half with the smallest distances by the first."""
    at = lambda cols, f: F.array(*[F.percentile_approx(f(c), F.lit(0.5), F.lit(1000)) for c in cols])
    middle = rows.groupBy("grp").agg(at(NAMES, lambda c: F.col(f"x_{c}")).alias("centre"))
    middle = written(middle, "medians")
    index = {c: i for i, c in enumerate(NAMES)}
    spread = rows.join(middle, "grp").groupBy("grp").agg(
        F.first("parent").alias("parent"), F.first("centre").alias("centre"),
        at(NAMES, lambda c: F.abs(F.col(f"x_{c}") - F.get("centre", F.lit(index[c])))).alias("mad"),
    )
    floor = F.array(*[F.lit(float(v)) for v in _SPREAD])
    inverse = F.array(*[
        1 / let(F.pow(1.4826 * F.get("mad", F.lit(i)), 2), lambda v: F.when(
            v < NO_SPREAD * F.get(floor, F.lit(i)), F.get(floor, F.lit(i))).otherwise(v)) if i == j else F.lit(0.0)
        for i, j in PAIRS
    ])
    plain = written(spread.select("grp", "parent", F.lit(0).alias("start"), "centre", inverse.alias("inverse")), "mcd-start")
    near = rows.join(plain.select("grp", "centre", "inverse"), "grp").withColumn("d2", _distance())
    half = written(near.groupBy("grp").agg(F.percentile_approx("d2", F.lit(0.5), F.lit(2000)).alias("half")), "mcd-half")
    chosen = near.join(half, "grp").withColumn("start", F.explode(
        F.when(F.col("d2") <= F.col("half"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return plain.union(_fit(_moments(chosen), factor, prior_rows).drop("logdet").select(plain.columns))


def estimate(
    rows: DataFrame, *, share: float = 0.75, steps: int = 4, prior_rows: float = 40,
) -> DataFrame:
    """(grp, centre, inverse) by ``steps`` C-steps from each start over all rows of (grp, parent, x_…)."""
    factor = consistency(share, len(NAMES))
    fit = written(_starts(rows, factor, prior_rows), "mcd-starts")
    for _ in range(steps):
        near = rows.join(fit.select("grp", "start", "centre", "inverse"), "grp").withColumn("d2", _distance()).drop("centre", "inverse")
        limit = near.groupBy("grp", "start").agg(F.percentile_approx("d2", F.lit(share), F.lit(2000)).alias("limit"))
        limit = written(limit, "mcd-limit")
        fit = written(_fit(_moments(near.join(limit, ["grp", "start"]).filter("d2 <= limit")), factor, prior_rows), "mcd-fit")
    best = fit.groupBy("grp").agg(F.min(F.struct("logdet", "start", "centre", "inverse")).alias("b"))
    return written(best.select("grp", "b.centre", "b.inverse"), "mcd-best")


def quality(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang",
    source: str = "source", share: float = 0.75, steps: int = 4, tail: float = 1e-4,
    prior_rows: float = 40,
) -> DataFrame:
    """Base counts, base rule and the verdict on every row.

    Returns id, the base counts, ``base_failed``, ``distance`` (the squared
    robust distance; null for a row without words) and ``kept``. A group is a
    language and source, null being a value of its own; its estimate counts
    ``prior_rows`` rows of its language's besides its own, since a scatter cannot
    be had from a handful of rows. A row is rejected above the chi-square quantile
    that normal rows exceed with probability ``tail``. Null and empty texts count no words and fail.
    Repeated rows count as often as they occur; other columns are ignored, and
    an empty table gives no rows.
    """
    cut = chi2_quantile(1 - tail, len(NAMES))
    own = docs.select(
        F.col(id).alias("id"), F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"), F.col(text).alias("text"),
    )
    rows = written(statistics(own, "text", ["id", "lang", "source"]), "text-statistics")
    rows = rows.withColumn("grp", F.to_json(F.struct("lang", "source"))).withColumn("parent", F.to_json(F.struct("lang")))
    fit = estimate(rows.filter("n_words > 0"), share=share, steps=steps, prior_rows=prior_rows)
    judged = rows.join(fit, "grp", "left").withColumn(
        "distance", F.when(F.col("n_words") > 0, _distance()))
    return judged.select(
        F.col("id").alias(id), *BASE, base_failed().alias("base_failed"), "distance",
        (~base_failed() & F.coalesce(F.col("distance") <= cut, F.lit(False))).alias("kept"),
    )
