"""Benchmark decontamination by pigeonhole edit matching.

A text that holds an item within k edits holds at least one of any k + 1 pieces of
the item unchanged. Pieces of all items go into one automaton; a task runs it over
each whole text, and every piece hit names an item and the place where it would
lie. There Myers' bit-parallel algorithm finds the least edit distance between
the item and any stretch of the text. It climbs: j neighbouring pieces of a match
that halves of pieces lead to hold at most j - 1 edits, so a hit is first verified
on two pieces, then on four, and only what passes meets the whole item.

Items are scanned in blocks of bounded size, so the benchmark may be of any size.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import broadcast_bytes, per_process

BLOCK_BYTES = 4 << 20  # text of the items of a block


def normal(text: str | None) -> str:
    """Lower case, white-space runs as one space, none at the ends."""
    return " ".join((text or "").lower().split())


def cuts_of(size: int, budget: int) -> list[int]:
    """Where ``budget + 1`` pieces of nearly equal length begin, and the end."""
    return [size * i // (budget + 1) for i in range(budget + 2)]


def climb(piece: int, pieces: int) -> list[tuple[int, int]]:
    """The ranges of pieces above one, smallest first, when all are halved again and again.

    If a range of j pieces has at most j - 1 edits, one of its halves has fewer
    edits than pieces too; so of every match some piece has all its ranges so.
    """
    low, high, out = 0, pieces, []
    while high - low > 1:
        out.append((low, high))
        middle = (low + high) // 2
        low, high = (low, middle) if piece < middle else (middle, high)
    return out[::-1]


def myers(pattern_bits: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """(least distance, end) of the pattern against any stretch of ``text``; the first best end."""
    mask, high = (1 << size) - 1, 1 << (size - 1)
    up, down, score = mask, 0, size
    best, end = size, 0
    get = pattern_bits.get
    for i, c in enumerate(text, 1):
        eq = get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus = down | ~(diagonal | up)
        minus = up & diagonal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
            if score < best:
                best, end = score, i
        plus <<= 1  # a match may start anywhere: the top row stays zero
        up = ((minus << 1) | ~(diagonal | plus)) & mask
        down = plus & diagonal & mask
    return best, end


def _apart(text: str, at: int) -> bool:
    """Whether no word runs over the place ``at``."""
    return at == 0 or at == len(text) or not (text[at - 1].isalnum() and text[at].isalnum())


class Matcher:
    """The items of one block: (id, text) pairs."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float, min_chars: int):
        import ahocorasick

        self.ids: dict[str, list] = {}
        for id, text in items:
            text = normal(text)
            if text:
                self.ids.setdefault(text, []).append(id)
        self.texts = list(self.ids)
        self.short = [len(t) < min_chars for t in self.texts]
        self.budgets = [0 if short else int(len(t) * error_rate) for t, short in zip(self.texts, self.short)]
        self.cuts = [cuts_of(len(t), k) for t, k in zip(self.texts, self.budgets)]
        self.bits: dict[tuple[int, int, int], dict[str, int]] = {}
        places: dict[str, list[tuple[int, int]]] = {}
        for i, text in enumerate(self.texts):
            for q, (low, high) in enumerate(zip(self.cuts[i], self.cuts[i][1:])):
                places.setdefault(text[low:high], []).append((i, q))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if self.texts:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[tuple[object, int, int, int]]:
        """(item id, distance, start, end) in the normal form of the text; the best place per item.

        ``start`` is ``end`` less the item's length: within the distance of where the
        stretch begins.
        """
        text = normal(text)
        if not self.texts or not text:
            return []
        hits: dict[int, list[tuple[int, int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for i, q in where:
                hits.setdefault(i, []).append((q, last + 1 - size))
        out = []
        for i, places in hits.items():
            item = self.texts[i]
            if self.short[i]:
                ends = [at + len(item) for _, at in places]
                found = min(((0, end) for end in ends if _apart(text, end - len(item)) and _apart(text, end)), default=None)
            elif (at := text.find(item)) >= 0:
                found = (0, at + len(item))
            else:
                found = min((m for q, at in places if (m := self._verify(text, i, q, at))), default=None)
            if found is not None:
                out += [(id, found[0], max(0, found[1] - len(item)), found[1]) for id in self.ids[item]]
        return out

    def _bits(self, i: int, low: int, high: int) -> dict[str, int]:
        """Of each character, where it stands in pieces ``low`` to ``high`` of item ``i``."""
        bits = self.bits.get((i, low, high))
        if bits is None:
            bits = self.bits[i, low, high] = {}
            for j, c in enumerate(self.texts[i][self.cuts[i][low]:self.cuts[i][high]]):
                bits[c] = bits.get(c, 0) | 1 << j
        return bits

    def _verify(self, text: str, i: int, piece: int, at: int) -> tuple[int, int] | None:
        """(distance, end) of item ``i`` where its ``piece`` lies at ``at``, if within budget."""
        cuts = self.cuts[i]
        found = (0, at + cuts[piece + 1] - cuts[piece])  # an item of one piece
        for low, high in climb(piece, len(cuts) - 1):
            budget = high - low - 1
            start = max(0, at - (cuts[piece] - cuts[low]) - budget)
            stop = at + cuts[high] - cuts[piece] + budget
            distance, end = myers(self._bits(i, low, high), cuts[high] - cuts[low], text[start:stop])
            if distance > budget:
                return None
            found = (distance, start + end)
        return found


def _blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> Iterator[list]:
    """The items in lists of about ``block_bytes`` of text each."""
    rows = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).filter("text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for b in range(blocks):
        part = rows if blocks == 1 else rows.filter(
            F.pmod(F.xxhash64(F.lit("block"), "id", "text"), F.lit(blocks)) == b)
        yield [(r["id"], r["text"]) for r in part.collect()]


def _shared(docs: DataFrame, items: list, error_rate: float, min_chars: int):
    data = pickle.dumps((items, error_rate, min_chars))
    return broadcast_bytes(docs.sparkSession, data, 64 << 20, "benchmark block")


def find_leaks(
    docs: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", error_rate: float = 0.1, min_chars: int = 25, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, item_id, distance, start, end): a row per row of ``docs`` and item it holds.

    An item is held if some stretch of the text is within ``error_rate`` edits a
    character of it, both in lower case with single spaces. An item of fewer than
    ``min_chars`` characters has to be there exactly, as whole words. Null and
    empty items name no text and match nothing; equal items are all reported. Null and empty texts hold nothing; repeated
    rows are reported each; null ids stay null; other columns are ignored; an
    empty table on either side gives no rows.
    """
    kinds = docs.schema[id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"id {kinds[0]}, item {kinds[1]}, distance int, start long, end long"

    def scan(shared):
        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = per_process("benchmark", shared.value, lambda d: Matcher(*pickle.loads(d)))
            for batch in stream:
                rows, found = [], []
                for k, t in enumerate(batch.column(1)):
                    for match in matcher.matches(t.as_py()):
                        rows.append(k)
                        found.append(match)
                cols = list(zip(*found)) if found else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(cols[0], item_type),
                     pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                    ["id", "item", "distance", "start", "end"])

        return run

    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(items.schema[item_id].dataType)
    own = docs.select(id, text)
    parts = [
        own.mapInArrow(scan(_shared(docs, block, error_rate, min_chars)), schema)
        for block in _blocks(items, item_id, item_text, block_bytes)
    ]
    if not parts:
        parts = [docs.sparkSession.createDataFrame([], schema)]
    return reduce(DataFrame.union, parts).withColumnRenamed("id", id).withColumnRenamed("item", item_id)


def drop_leaks(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    error_rate: float = 0.1, min_chars: int = 25, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the rows that hold an item; all columns stay, nothing is shuffled."""
    place = docs.columns.index(text)

    def scan(shared):
        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = per_process("benchmark", shared.value, lambda d: Matcher(*pickle.loads(d)))
            for batch in stream:
                yield batch.filter(pa.array(
                    [not matcher.matches(t.as_py()) for t in batch.column(place)], pa.bool_()))

        return run

    for block in _blocks(items, item_id, item_text, block_bytes):
        docs = docs.mapInArrow(scan(_shared(docs, block, error_rate, min_chars)), docs.schema)
    return docs
