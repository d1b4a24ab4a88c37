"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A
word's probability is the sum over all its segmentations into pieces, found by
the forward algorithm; a text's is the product over its words. Piece
probabilities are learned by expectation-maximisation over the word counts of
labelled texts: forward-backward gives expected piece counts, Spark adds them up.

Pieces never cross a word start, so the forward pass over a text is the product
of the passes over its words. Tasks score each distinct word of a batch once, for
all languages together, a column of characters at a time.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import broadcast_bytes, crc_remainder, per_process, portions, written
from quillspark.llm.lattice import Lattice

START = "▁"  # the vocabulary's mark of a word start
WORDS = re.compile(r"[^\W\d_]+")
HAS_LETTER = re.compile(r"[^\W\d_]")
WINDOW = 256  # characters whose pieces are looked up at a time
CELLS = 240_000  # words times characters in such a lookup


def load_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece model that text can take, as plain strings."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return sorted({
        sp.id_to_piece(i) for i in range(sp.get_piece_size())
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
    })


def factors(lattice: Lattice, word: str) -> list[str]:
    """The marked word; a long one in factors that no piece crosses."""
    word = START + word
    return [word] if len(word) <= Lattice.LONGEST else lattice.factors(word)


class Scorer:
    """Log probabilities of words under every language; ``probs`` is pieces x languages."""

    def __init__(self, pieces: list[str], probs: np.ndarray, unknown: float, cache: int = 300_000):
        self.lattice, self.cache = Lattice(pieces), cache
        self.probs = np.vstack([probs, np.zeros((1, probs.shape[1]))])
        self.unknown = unknown  # the probability of a character no piece covers
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, probs.shape[1]))

    def forward(self, words: list[str]) -> np.ndarray:
        """Log probabilities of words, summed over all their segmentations.

        Shorter words are padded with a character that is in no piece, and read
        off at their own length.
        """
        sizes = np.array([len(w) for w in words])
        size, longest = int(sizes.max()), self.lattice.longest
        words = [w.ljust(size, "\0") for w in words]
        out = np.zeros((len(words), self.probs.shape[1]))
        logs = {0: out.copy()}
        for first in range(0, size, WINDOW):
            low = max(0, first + 1 - longest)
            arcs = self.lattice.arcs([w[low:first + WINDOW] for w in words])
            for end in range(first + 1, min(size, first + WINDOW) + 1):
                last = logs[end - 1]
                # A character may always be an unknown one, so no word is impossible.
                total = np.full(out.shape, self.unknown)
                for start in range(max(0, end - longest), end):
                    ids = arcs.get((start - low, end - low))
                    if ids is not None:
                        total += self.probs[ids] * np.exp(logs[start] - last)
                logs[end] = last + np.log(total)
                done = sizes == end
                out[done] = logs[end][done]
                logs.pop(end - longest, None)
        return out

    def score(self, words: list[str]) -> np.ndarray:
        """A row of log probabilities per word; distinct new words are scored together."""
        new = [w for w in words if w not in self.known]
        if new:
            if len(self.known) + len(new) > self.cache:
                self.known, self.table = {}, np.zeros((0, self.probs.shape[1]))
                new = words
            groups: dict[int, list[tuple[int, str]]] = {}
            for i, w in enumerate(new):
                for c in factors(self.lattice, w):
                    # Long factors share a group up to a power of two.
                    size = len(c) if len(c) <= Lattice.LONGEST else 1 << (len(c) - 1).bit_length()
                    groups.setdefault(size, []).append((i, c))
            rows = np.zeros((len(new), self.probs.shape[1]))
            for size, group in groups.items():
                step = min(20_000, CELLS // min(size, WINDOW + self.lattice.longest))
                for k in range(0, len(group), step):
                    part = group[k:k + step]
                    np.add.at(rows, [i for i, _ in part], self.forward([c for _, c in part]))
            first = len(self.known)
            self.known.update((w, first + i) for i, w in enumerate(new))
            self.table = np.vstack([self.table, rows])
        return self.table[[self.known[w] for w in words]]


# --- learning -----------------------------------------------------------------

def expected_counts(
    lattice: Lattice, words: list[str], weights: np.ndarray, probs: np.ndarray, unknown: float,
) -> np.ndarray:
    """Expected piece counts of equally long words under one language's ``probs``.

    Forward and backward sums are kept as logarithms, pieces of one window at a time.
    """
    size, longest, n = len(words[0]), lattice.longest, len(words)
    padded = np.append(probs, 0.0)
    fore, back = np.zeros((size + 1, n)), np.zeros((size + 1, n))
    arcs: dict = {}
    for first in range(0, size, WINDOW):
        low = max(0, first + 1 - longest)
        arcs = lattice.arcs([w[low:first + WINDOW] for w in words])
        for end in range(first + 1, min(size, first + WINDOW) + 1):
            total = np.full(n, unknown)
            for start in range(max(0, end - longest), end):
                if (ids := arcs.get((start - low, end - low))) is not None:
                    total += padded[ids] * np.exp(fore[start] - fore[end - 1])
            fore[end] = fore[end - 1] + np.log(total)
    out = np.zeros(len(padded))
    for first in reversed(range(0, size, WINDOW)):
        if size > WINDOW:
            arcs = lattice.arcs([w[first:first + WINDOW + longest] for w in words])
        for start in reversed(range(first, min(size, first + WINDOW))):
            total = np.full(n, unknown)
            for end in range(start + 1, min(size, start + longest) + 1):
                if (ids := arcs.get((start - first, end - first))) is not None:
                    total += padded[ids] * np.exp(back[end] - back[start + 1])
                    np.add.at(out, ids, weights * padded[ids] * np.exp(fore[start] + back[end] - fore[size]))
            back[start] = back[start + 1] + np.log(total)
    return out[:-1]


def word_counts(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", bound: int = 5_000,
) -> DataFrame:
    """(lang, word, n) over about ``bound`` texts of each language, chosen by a hash of the text."""
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("there")).select(
        "lang", F.least(F.lit(1.0), F.lit(float(bound)) / F.col("there")).alias("share"))
    # A written table has a known size: a row per language goes to every task, and no text moves.
    sizes = written(sizes, "language-sizes")
    chosen = rows.join(sizes, "lang").filter(
        F.pmod(F.xxhash64(F.lit("langid"), "text"), F.lit(1 << 20)) < F.col("share") * (1 << 20))

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            seen: Counter = Counter()
            for language, t in zip(*(c.to_pylist() for c in batch.columns)):
                seen.update((language, w) for w in WORDS.findall(t.lower()))
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([seen[k] for k in keys], pa.int64())], ["lang", "word", "n"])

    counted = chosen.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame, vocabulary: str, *, text: str = "text", lang: str = "lang", bound: int = 5_000,
    rounds: int = 3, smoothing: float = 0.5,
) -> dict:
    """Piece probabilities of every language in ``lang``.

    The sample is ``bound`` texts per language or so; the expected counts that
    reach the driver have a row per piece and language at most. Rows without a
    language or text teach nothing; without any there is no language, and all
    predictions are ``und``.
    """
    pieces = load_pieces(vocabulary)
    spark = docs.sparkSession
    counts = written(word_counts(docs, text=text, lang=lang, bound=bound), "word-counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    unknown = 1e-7
    # A piece of two characters is as likely as two pieces of one, at the start.
    start = np.array([0.02 ** len(p.replace(START, "")) if p != START else 0.02 for p in pieces])
    probs = np.repeat((start / start.sum())[:, None], max(len(langs), 1), axis=1)
    for _ in range(rounds if langs else 0):
        shared = broadcast_bytes(spark, pickle.dumps((pieces, langs, probs)), 256 << 20, "piece probabilities")

        def expect(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces, langs, probs = pickle.loads(shared.value)
            lattice = Lattice(pieces)
            total = np.zeros(probs.shape)
            for batch in stream:
                groups: dict = {}
                for language, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                    for c in factors(lattice, word):
                        groups.setdefault((language, len(c)), []).append((c, n))
                for (language, _), part in groups.items():
                    k = langs.index(language)
                    total[:, k] += expected_counts(
                        lattice, [c for c, _ in part], np.array([n for _, n in part], float), probs[:, k], unknown)
            at = np.argwhere(total > 1e-6)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()),
                 pa.array(total[at[:, 0], at[:, 1]], pa.float64())], ["piece", "k", "n"])

        found = counts.mapInArrow(expect, "piece int, k int, n double").groupBy("piece", "k").agg(
            F.sum("n").alias("n")).toArrow()
        fresh = np.full((len(pieces), len(langs)), smoothing * 0.01)
        np.add.at(fresh, (found["piece"].to_numpy(), found["k"].to_numpy()), found["n"].to_numpy())
        probs = fresh / fresh.sum(0)
        shared.unpersist()
    return {"pieces": pieces, "langs": langs, "probs": probs, "unknown": unknown}


# --- prediction ---------------------------------------------------------------

def predict(
    docs: DataFrame, model: dict, *, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(id, lang_pred, score) for every row, over whole texts.

    ``score`` is the posterior of the predicted language under equal priors, at
    a temperature that grows with the text's length, so it does not saturate. A
    null text or one without a letter is ``und`` with score 0. Ties go to the
    first language in order. Null ids, repeated rows and an empty table pass
    through; other columns are ignored.
    """
    data = pickle.dumps(model)
    shared = broadcast_bytes(docs.sparkSession, data, 256 << 20, "language model")
    kind = docs.schema[id].dataType.simpleString()

    def guess(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build(d: bytes):
            m = pickle.loads(d)
            return m["langs"], Scorer(m["pieces"], m["probs"], m["unknown"])

        langs, scorer = per_process("langid", shared.value, build)
        for whole in stream:
            for batch in portions(whole, 1):
                counts = [Counter(WORDS.findall((t.as_py() or "").lower())) for t in batch.column(1)]
                words = list(set().union(*counts)) if langs else []
                rows = scorer.score(words) if words else None
                place = {w: i for i, w in enumerate(words)}
                names, scores = [], []
                for c in counts:
                    if not c or not langs:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    z = np.array(list(c.values()), float) @ rows[[place[w] for w in c]]
                    best = int(np.argmax(z))
                    soft = np.exp((z - z[best]) / math.sqrt(sum(c.values())))
                    names.append(langs[best])
                    scores.append(float(1 / soft.sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["id", "lang_pred", "score"])

    return docs.select(id, text).mapInArrow(guess, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id)


def held_out(id: str | Column = "doc_id", modulus: int = 3) -> Column:
    """Rows whose language is never learned from."""
    return crc_remainder(F.col(id) if isinstance(id, str) else id, modulus) == 1
