"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, report, break, other)
through lexicons; a small fixed grammar of five transducers, composed into one
machine at the start, reads the symbols of a text and emits a match per clause
that holds an insult or threat, typed by what stands around it. The target
transducer also reads each text from its end, so that targets after a match count. A text's score is
a logistic function of its matched clauses, not of isolated words: the weights
of the clause types and the insult lexicon are learned from labels.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Hashable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import broadcast_bytes, crc_remainder, portions

# Closed word classes of the four languages.
TARGETS = (
    "you your yours yourself he she they them him her these those "
    "du dich dir ihr euch sie er tu te toi vous il elle ils elles usted ustedes vosotros ellos ellas"
).split()
NEGATIONS = (
    "not no never neither nor without isn't aren't wasn't don't doesn't didn't cannot can't won't "
    "nicht kein keine keinen niemals nie ne jamais aucun aucune nunca tampoco ningún ninguna"
).split()
REPORTS = (
    "said says say told called calls quoted quote according wrote reported claimed "
    "sagte sagt nannte laut schrieb dit disait selon écrit dijo dice según escribió"
).split()
THREATS = (
    "kill hurt destroy beat murder burn attack töten umbringen schlagen tuer frapper détruire "
    "matar golpear destruir"
).split()
# Insults known before any label is seen.
INSULTS = (
    "idiot moron stupid scum trash pathetic worthless loser clown disgusting dumb imbecile "
    "dummkopf abschaum crétin ordure basura idiota"
).split()

INSULT, THREAT, TARGET, NEGATION, REPORT, BREAK, OTHER = range(7)
# Clause matches, in the order of the model's weights.
MATCHES = ("insult", "targeted", "threat", "negated", "reported")
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;\n]")
STEM_LENGTHS = range(3, 8)
REACH = 6  # words within which target, negation and report act on a match


# --- the grammar --------------------------------------------------------------

@dataclass(frozen=True)
class Transducer:
    """A deterministic letter transducer: (state, symbol) -> (next state, symbol written)."""

    start: Hashable
    moves: dict[tuple[Hashable, Hashable], tuple[Hashable, Hashable]]

    def inputs(self) -> list[Hashable]:
        return list(dict.fromkeys(symbol for _, symbol in self.moves))

    def run(self, symbols: Iterable[Hashable]) -> list[Hashable]:
        state, out = self.start, []
        for symbol in symbols:
            state, written = self.moves[state, symbol]
            out.append(written)
        return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that gives ``second`` what ``first`` writes; reachable pairs of states only."""
    start = (first.start, second.start)
    moves, seen, left = {}, {start}, [start]
    while left:
        a, b = left.pop()
        for symbol in first.inputs():
            to_a, middle = first.moves[a, symbol]
            to_b, written = second.moves[b, middle]
            moves[(a, b), symbol] = (to_a, to_b), written
            if (to_a, to_b) not in seen:
                seen.add((to_a, to_b))
                left.append((to_a, to_b))
    return Transducer(start, moves)


# A symbol on the inner tapes is a word's symbol with the marks it has got so far.
TARGETED, NEGATED, REPORTED = 1, 2, 4
TAPE = [(word, marks) for word in range(7) for marks in (range(8) if word in (INSULT, THREAT) else [0])]


def marking(modifier: int, mark: int, reach: int = REACH) -> Transducer:
    """Marks the insults and threats within ``reach`` words after a ``modifier`` of the same clause."""
    moves = {}
    for left in range(reach + 1):
        for word, marks in TAPE:
            on = left > 0 and word in (INSULT, THREAT)
            following = 0 if word == BREAK else reach if word == modifier else max(0, left - 1)
            moves[left, (word, marks)] = following, (word, marks | mark if on else marks)
    return Transducer(0, moves)


def insults() -> Transducer:
    """Writes the type of every insult: a report goes before a negation, a negation before a target."""
    def typed(marks: int) -> str:
        if marks & REPORTED:
            return "reported"
        if marks & NEGATED:
            return "negated"
        return "targeted" if marks & TARGETED else "insult"

    return Transducer(0, {
        (0, (word, marks)): (0, typed(marks) if word == INSULT else (word, marks)) for word, marks in TAPE})


def threats() -> Transducer:
    """Writes the type of every threat that has a target; without one it is no match. Types pass."""
    def typed(marks: int) -> str | None:
        if not marks & TARGETED:
            return None
        return "reported" if marks & REPORTED else "negated" if marks & NEGATED else "threat"

    moves = {(0, s): (0, typed(s[1]) if s[0] == THREAT else None) for s in TAPE}
    return Transducer(0, moves | {(0, kind): (0, kind) for kind in MATCHES})


@dataclass(frozen=True)
class Machine:
    """The composed grammar as tables.

    ``ahead`` and ``typing`` hold (next state, written) per state and input. An
    input of ``ahead`` is a word's symbol; an input of ``typing`` is twice that,
    plus one if a target follows. ``typing`` writes 0 or k + 1 for ``MATCHES[k]``.
    """

    ahead: list[list[tuple[int, int]]]
    typing: list[list[tuple[int, int]]]


def grammar() -> Machine:
    """The five transducers composed, and the target transducer for the way back.

    A sequential machine cannot see what follows; so the target transducer first
    reads the text from its end, and the composition reads what it has marked.
    """
    target = marking(TARGET, TARGETED)
    whole = target
    for part in (marking(NEGATION, NEGATED), marking(REPORT, REPORTED), insults(), threats()):
        whole = compose(whole, part)
    at = {state: i for i, state in enumerate(dict.fromkeys(s for s, _ in whole.moves))}
    at = {whole.start: 0} | {s: i for i, s in enumerate((s for s in at if s != whole.start), 1)}
    typing: list[list] = [[(0, 0)] * 14 for _ in at]
    for (state, (word, marks)), (to, kind) in whole.moves.items():
        if marks <= TARGETED:  # the only mark of the way back
            typing[at[state]][2 * word + marks] = (at[to], 1 + MATCHES.index(kind) if kind else 0)
    ahead = [
        [(to, 2 * word + marks) for to, (word, marks) in (target.moves[left, (w, 0)] for w in range(7))]
        for left in range(REACH + 1)
    ]
    return Machine(ahead, typing)


class Lexicon:
    """Words to symbols and weights: whole words first, then the longest known stem.

    Answers for ``remembered`` words are kept, then looked up anew.
    """

    def __init__(self, insults: dict[str, float], stems: dict[str, float], remembered: int = 100_000):
        self.insults, self.stems, self.remembered = insults, stems, remembered
        closed = {BREAK: ".!?;\n", TARGET: TARGETS, NEGATION: NEGATIONS, REPORT: REPORTS, THREAT: THREATS}
        self.closed = {w: s for s, words in closed.items() for w in words}
        self.known: dict[str, tuple[int, float]] = {}

    def __call__(self, word: str) -> tuple[int, float]:
        got = self.known.get(word)
        if got is None:
            got = self._look(word)
            if len(self.known) >= self.remembered:
                self.known.clear()
            self.known[word] = got
        return got

    def _look(self, word: str) -> tuple[int, float]:
        if word in self.insults:
            return INSULT, self.insults[word]
        if word in self.closed:
            return self.closed[word], 0.0
        for n in reversed(STEM_LENGTHS):
            if len(word) >= n and (weight := self.stems.get(word[:n])):
                return INSULT, weight
        return OTHER, 0.0


def matches(text: str, lexicon: Lexicon, machine: Machine) -> list[tuple[str, float]]:
    """The typed clause matches of a text with the weights of their words."""
    tokens = TOKEN.findall(text.lower())
    symbols = list(map(lexicon, tokens))
    if not any(s in (INSULT, THREAT) for s, _ in set(symbols)):
        return []
    state, marked = 0, []
    for symbol, _ in reversed(symbols):
        state, written = machine.ahead[state][symbol]
        marked.append(written)
    state, out = 0, []
    for read, (_, weight) in zip(reversed(marked), symbols):
        state, emitted = machine.typing[state][read]
        if emitted:
            out.append((MATCHES[emitted - 1], weight or 1.0))
    return out


def clause_vector(found: list[tuple[str, float]]) -> list[float]:
    """Summed word weights per match type, each damped by its logarithm."""
    sums = dict.fromkeys(MATCHES, 0.0)
    for kind, weight in found:
        sums[kind] += weight
    return [math.log1p(sums[k]) for k in MATCHES]


# --- learning -----------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, id: str, text: str, bound: int) -> DataFrame:
    """About ``bound`` labelled rows at most, chosen by a hash of the id; of several labels of an id the largest counts."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(
        labels.groupBy(F.col(id).alias("label_id")).agg(F.max("toxic").alias("label")),
        F.col("id") == F.col("label_id"),
    ).filter("label IS NOT NULL AND text IS NOT NULL")
    there = labels.filter("toxic IS NOT NULL").count()
    share = min(1.0, bound / max(there, 1))
    pick = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    return rows.filter(pick)


def learn_insults(sample: DataFrame, *, z: float = 3.3, least: float = 0.5,
                  most: int = 20_000, stem_words: int = 3):
    """Words and stems that mark toxic texts, with weights.

    A word counts once per text and once for each different pair of neighbours, so
    that copies of a text do not vouch for its words. A stem stands for at least
    ``stem_words`` words of toxic texts. A form is taken if the lower Wilson bound (at
    ``z``) of its share in toxic texts is ``least`` or more; the strongest
    ``most`` are kept, which bounds the model.
    """
    words = F.expr("regexp_extract_all(lower(text), r\"\\p{L}+(?:['’]\\p{L}+)*\", 0)")
    around = F.transform(
        F.sequence(F.lit(1), F.size("w")),
        lambda i: F.struct(
            F.get("w", i - 1).alias("word"),
            F.xxhash64(F.get("w", i - 2), F.get("w", i - 1), F.get("w", i)).alias("context"),
        ),
    )
    # One occurrence per text and word, then one per neighbourhood.
    seen = (
        sample.select("label", F.xxhash64("text").alias("doc"), words.alias("w")).filter(F.size("w") > 0)
        .select("label", "doc", F.explode(around).alias("x"))
        .groupBy("label", "doc", "x.word").agg(F.min("x.context").alias("context"))
        .groupBy("label", "word", "context").agg(F.lit(1).alias("one"))
        .groupBy("word").agg(F.sum("label").alias("a"), F.count("label").alias("n"))
    )
    forms = F.array(
        F.struct(F.lit(0).alias("stem"), F.col("word").alias("form")),
        *[
            F.when(F.char_length("word") > n, F.struct(F.lit(n).alias("stem"), F.substring("word", 1, n).alias("form")))
            for n in STEM_LENGTHS
        ],
    )
    a, n = F.col("a"), F.col("n")
    share = a / n
    bound = (share + z * z / (2 * n) - z * F.sqrt((share * (1 - share) + z * z / (4 * n)) / n)) / (1 + z * z / n)
    rows = (
        seen.select("a", "n", F.explode(F.filter(forms, lambda x: x.isNotNull())).alias("f"))
        .groupBy("f.stem", "f.form").agg(
            F.sum("a").alias("a"), F.sum("n").alias("n"), F.count(F.when(F.col("a") > 0, 1)).alias("words"))
        .filter((F.col("stem") == 0) | (F.col("words") >= stem_words))
        .withColumn("bound", bound).filter(F.col("bound") >= least)
        .orderBy(F.desc("bound"), "form", "stem").limit(most).collect()
    )
    insults = {r["form"]: r["bound"] for r in rows if r["stem"] == 0}
    found = {r["form"]: r for r in rows if r["stem"] > 0}
    # A longer stem that explains most of a shorter one stands in for it.
    stems = {
        form: r["bound"] for form, r in found.items()
        if not any(t != form and t.startswith(form) and found[t]["a"] >= 0.8 * r["a"] for t in found)
    }
    return {w: 1.0 for w in INSULTS} | insults, stems


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * max(len(x), 1))
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", bound: int = 20_000,
) -> dict:
    """The model: lexicon and clause weights, from about ``bound`` labelled rows at most.

    Without labelled rows, or with one class only, the fixed insults and fixed
    weights remain.
    """
    sample = labelled_sample(docs, labels, id, text, bound)
    insults, stems = learn_insults(sample)
    model = {"insults": insults, "stems": stems, "weights": None}
    spark = docs.sparkSession
    shared = broadcast_bytes(spark, json.dumps(model).encode(), 8 << 20, "toxicity lexicon")

    def vectors(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = json.loads(shared.value)
        lexicon, machine = Lexicon(raw["insults"], raw["stems"]), grammar()
        for batch in stream:
            x = [clause_vector(matches(t.as_py(), lexicon, machine)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    counted = (
        sample.select(F.col("label").cast("int"), "text").mapInArrow(vectors, "label int, x array<double>")
        .groupBy("label", F.transform("x", lambda v: F.round(v, 2)).alias("x")).agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    weights = np.array([8.0, 8.0, 8.0, 2.0, 1.0, -4.0])
    if len({r["label"] for r in counted}) == 2:
        x = np.array([r["x"] for r in counted])
        y = np.array([r["label"] for r in counted], float)
        n = np.array([r["n"] for r in counted])
        weights = fit_logistic(np.repeat(x, n, axis=0), np.repeat(y, n))
        # A match never speaks for a text: more of it cannot lower the score.
        weights[:-1] = np.maximum(weights[:-1], 0.0)
    return model | {"weights": weights.tolist()}


# --- scoring ------------------------------------------------------------------

def probability(found: list[tuple[str, float]], weights: list[float]) -> float:
    """The score of a text with these clause matches."""
    z = weights[-1] + sum(w * v for w, v in zip(weights, clause_vector(found)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def score_texts(
    docs: DataFrame, model: dict, *, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(id, score, predicted, matches): a row per row of ``docs``, whole texts.

    ``matches`` counts the clause matches. Null and empty texts have none and get
    the score of a text without matches. Null ids, repeated rows and an empty
    table pass through; other columns are ignored.
    """
    shared = broadcast_bytes(docs.sparkSession, json.dumps(model).encode(), 8 << 20, "toxicity model")
    kind = docs.schema[id].dataType.simpleString()

    def score(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = json.loads(shared.value)
        lexicon, machine = Lexicon(raw["insults"], raw["stems"]), grammar()
        weights = raw["weights"]
        for batch in stream:
            scores, counts = [], []
            for t in batch.column(1):
                found = matches(t.as_py() or "", lexicon, machine)
                scores.append(probability(found, weights))
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())],
                ["id", "score", "matches"])

    scored = docs.select(id, text).mapInArrow(score, f"id {kind}, score double, matches long")
    return scored.select(
        F.col("id").alias(id), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "matches")


def drop_toxic(docs: DataFrame, model: dict, *, text: str = "text", at: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose whole text scores ``at`` or more; nothing is shuffled."""
    shared = broadcast_bytes(docs.sparkSession, json.dumps(model).encode(), 8 << 20, "toxicity model")
    place = docs.columns.index(text)

    def clean(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = json.loads(shared.value)
        lexicon, machine = Lexicon(raw["insults"], raw["stems"]), grammar()
        for whole in stream:
            for batch in portions(whole, place):
                keep = [
                    probability(matches(t.as_py() or "", lexicon, machine), raw["weights"]) < at
                    for t in batch.column(place)
                ]
                yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def held_out(id: str | Column = "doc_id", modulus: int = 5) -> Column:
    """Rows whose labels are never learned from."""
    return crc_remainder(F.col(id) if isinstance(id, str) else id, modulus) == 0
