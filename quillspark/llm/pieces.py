"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The transducer is a composition of three: the normaliser (space to ``▁``, a ``▁``
in front), the piece transducer (an arc per piece, in which a state is the piece
last read) and the byte fallback (a character that no piece holds becomes its
UTF-8 byte pieces). In a byte-pair model a segmentation is the model's own exactly
if every two neighbouring pieces, encoded together, stay as they are; an arc that
keeps this weighs zero and any other weighs infinity. Composed with an input, the
lattice has one path of finite weight from each start, and the shortest path in
the tropical semiring is the model's encoding.

No piece crosses the start of a word, so the input is composed word by word, and
the path of a word is kept for its next occurrence.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import broadcast_bytes, per_process, portions
from quillspark.llm.lattice import Lattice

SPACE_MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)  # piece types of the format
BPE = 2  # model type of the format
NONE = -2  # no piece
MIX = np.uint64(0x9E3779B97F4A7C15)
ARC_BITS = 21  # slots for the weights of arcs seen before
PORTION_ROWS, PORTION_BYTES = 1024, 2 << 20  # texts worked on at once
UNITS_AT_ONCE = 8_000  # units whose lattices are held at once


# --- the model file -----------------------------------------------------------

def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield tag >> 3, data[at:at + size]
            at += size


def load_model(path: str) -> dict:
    """Pieces (text, score, type) and the settings of the normaliser of a byte-pair model."""
    with open(path, "rb") as f:
        data = f.read()
    model = {"pieces": [], "prefix": True, "squeeze": True, "byte_fallback": False, "kind": 1, "map": b""}
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            score = float(np.frombuffer(own.get(2, b"\0\0\0\0"), "<f4")[0])
            model["pieces"].append((own[1].decode(), score, own.get(3, NORMAL)))
        elif number == 2:
            own = dict(_fields(value))
            model["kind"], model["byte_fallback"] = own.get(3, 1), bool(own.get(35, 0))
        elif number == 3:
            own = dict(_fields(value))
            model["map"] = own.get(2, b"")
            model["prefix"], model["squeeze"] = bool(own.get(3, 1)), bool(own.get(4, 1))
    if model["kind"] != BPE or model.pop("map"):
        raise ValueError("only byte-pair models with the identity normaliser are supported")
    return model


# --- the transducer -----------------------------------------------------------

class Transducer:
    START = -1

    def __init__(self, model: dict, cache: int = 300_000):
        self.prefix, self.squeeze = model["prefix"], model["squeeze"]
        self.text: list[bytes] = []
        self.arcs: dict[str, int] = {}
        self.order: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.size = len(model["pieces"])
        self.unknown = 0
        for i, (piece, score, kind) in enumerate(model["pieces"]):
            self.text.append(piece.replace(SPACE_MARK, " ").encode())
            if kind == BYTE:
                self.bytes[int(piece[1:-1], 16)] = i
                self.text[i] = bytes([int(piece[1:-1], 16)])
            elif kind in (NORMAL, USER_DEFINED):
                self.arcs[piece], self.order[piece] = i, score
            else:
                if kind == UNKNOWN:
                    self.unknown = i
                self.text[i] = b""
        if not model["byte_fallback"]:
            self.bytes = {}
        self.text_array = pa.array(self.text, pa.large_binary())
        self.names = [p for p, _, _ in model["pieces"]]
        self.piece_chars = np.fromiter(map(len, self.names), np.int64)
        self.longest = max(map(len, self.arcs))
        self.joined: dict[int, bool] = {}
        self.lattice = Lattice(list(self.arcs))
        self.piece_ids = np.append(np.fromiter(self.arcs.values(), np.int64), NONE)
        self.arc_keys = np.full(1 << ARC_BITS, -1, np.int64)
        self.arc_kept = np.zeros(1 << ARC_BITS, bool)
        held = {c for p in self.arcs for c in p} - {SPACE_MARK}
        known = "".join(map(re.escape, sorted(held)))
        crossing = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.arcs)
        # Units: a run of marks with the word after it, or a character no piece holds.
        self.units = re.compile(
            f"[{known}{SPACE_MARK}]+|[^{known}{SPACE_MARK}]" if crossing
            else f"{SPACE_MARK}+[{known}]*|[{known}]+|[^{known}{SPACE_MARK}]"
        )
        self.cache = cache
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    # The normaliser.

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.prefix:
            text = " " + text
        return text.replace(" ", SPACE_MARK)

    # The piece transducer: which arcs weigh nothing.

    def _merge(self, text: str) -> list[str]:
        """The model's own merges on a short string: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [(-self.order[p], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.order]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def keeps(self, before: int, piece: int) -> bool:
        """Whether the arc of ``piece`` out of the state ``before`` weighs zero."""
        key = (before + 1) * self.size + piece
        kept = self.joined.get(key)
        if kept is None:
            names = [self.names[piece]] if before == self.START else [self.names[before], self.names[piece]]
            kept = self._merge("".join(names)) == names
            if len(self.joined) >= 250_000:
                self.joined.clear()
            self.joined[key] = kept
        return kept

    def _keeps_all(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """``keeps`` of many arcs, by a table with one slot per hash of an arc."""
        keys = (before + 1) * self.size + piece
        with np.errstate(over="ignore"):
            slots = ((keys.astype(np.uint64) * MIX) >> np.uint64(64 - ARC_BITS)).astype(np.int64)
        new = np.flatnonzero(self.arc_keys[slots] != keys)
        kept = self.arc_kept[slots]
        if len(new):
            found, where = np.unique(keys[new], return_inverse=True)
            known = np.fromiter(
                (self.keeps(k // self.size - 1, k % self.size) for k in found.tolist()), bool, len(found))
            kept[new] = known[where.reshape(-1)]
            self.arc_keys[slots[new]] = keys[new]
            self.arc_kept[slots[new]] = kept[new]
        return kept

    # The composition with units, and their shortest paths.

    def shortest_paths(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids row by row, sizes) of equally long units of known characters."""
        n, size = len(units), len(units[0])
        last = np.full((size + 1, n), NONE, np.int64)
        last[0] = self.START
        arcs = self.lattice.arcs(units)
        for end in range(1, size + 1):
            for start in range(max(0, end - self.longest), end):
                if (found := arcs.get((start, end))) is None:
                    continue
                piece, before = self.piece_ids[found], last[start]
                at = np.flatnonzero((piece != NONE) & (before != NONE) & (last[end] == NONE))
                if len(at):
                    at = at[self._keeps_all(before[at], piece[at])]
                    last[end, at] = piece[at]
        # Read backwards from the end of every unit.
        lengths = self.piece_chars
        out, ends, rows = [], np.full(n, size), np.arange(n)
        while len(rows):
            piece = last[ends[rows], rows]
            if (piece == NONE).any():
                raise ValueError(f"no path through {units[rows[int(np.argmax(piece == NONE))]]!r}")
            step = np.full(n, NONE, np.int64)
            step[rows] = piece
            out.append(step)
            ends[rows] -= lengths[piece]
            rows = rows[ends[rows] > 0]
        table = np.stack(out[::-1], axis=1)
        there = table != NONE
        return table[there].astype(np.int32), there.sum(1)

    def _learn(self, units: list[str]) -> None:
        """Find and keep the paths of new units."""
        groups: dict[int, list[str]] = {}
        for u in units:
            alone = len(u) > Lattice.LONGEST or (len(u) == 1 and u not in self.arcs)
            groups.setdefault(0 if alone else len(u), []).append(u)
        flat, sizes, order = [self.flat], [], []
        for size, group in groups.items():
            for k in range(0, len(group), UNITS_AT_ONCE):
                part = group[k:k + UNITS_AT_ONCE]
                if size:
                    ids, counts = self.shortest_paths(part)
                else:
                    paths = [self.shortest_path(u) for u in part]
                    ids = np.fromiter(chain.from_iterable(paths), np.int32)
                    counts = np.fromiter(map(len, paths), np.int64, len(paths))
                flat.append(ids)
                sizes.append(counts)
                order += part
        first = len(self.known)
        self.known.update((u, first + i) for i, u in enumerate(order))
        added = np.concatenate(sizes)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(added) - added])
        self.sizes = np.concatenate([self.sizes, added])
        self.flat = np.concatenate(flat)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text)."""
        units = [self.units.findall(self.normalise(t)) for t in texts]
        distinct = set().union(*units)
        new = [u for u in distinct if u not in self.known]
        if new:
            if len(self.known) + len(new) > self.cache:
                self._forget()
                new = list(distinct)
            self._learn(new)
        per_text = np.fromiter(map(len, units), np.int64, len(units))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(units)), np.int64, int(per_text.sum()))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.starts[at] - (ends - sizes), sizes)]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(per_text)))]
        return ids, np.diff(bounds)

    def shortest_path(self, unit: str) -> tuple[int, ...]:
        n, arcs, keeps = len(unit), self.arcs, self.keeps
        if n == 1 and unit not in arcs:
            return self.fallback(unit)
        # The state reached at zero weight at each position; there is one at most.
        last: list[int | None] = [None] * (n + 1)
        last[0] = self.START
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                before = last[start]
                if before is None:
                    continue
                piece = arcs.get(unit[start:end])
                if piece is not None and keeps(before, piece):
                    last[end] = piece
                    break
        path, end = [], n
        while end:
            piece = last[end]
            if piece is None:
                raise ValueError(f"no path through {unit[:50]!r}")
            path.append(piece)
            end -= len(self.names[piece])
        return tuple(path[::-1])

    def fallback(self, character: str) -> tuple[int, ...]:
        if not self.bytes:
            return (self.unknown,)
        return tuple(self.bytes[b] for b in character.encode())

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of ``decode`` of many lists of ids, null for a null list."""
        starts = ids.offsets.to_numpy()
        pieces = self.text_array.take(ids.values.slice(starts[0], starts[-1] - starts[0]))
        lists = pa.ListArray.from_arrays(pa.array(starts - starts[0]), pieces)
        data = pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
        if self.prefix:
            data = pc.if_else(pc.starts_with(data, b" "), pc.binary_replace_slice(data, 0, 1, b""), data)
        return data if not ids.null_count else pc.if_else(ids.is_valid(), data, None)

    def decode(self, ids) -> str:
        """The text of ids: marks become spaces, byte pieces join, the space in front goes."""
        text = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


# --- operators ----------------------------------------------------------------

def _shared(df: DataFrame, vocabulary: str):
    return broadcast_bytes(df.sparkSession, pickle.dumps(load_model(vocabulary)), 64 << 20, "piece model")


def _id_list(machine: Transducer, texts: list[str]) -> pa.ListArray:
    ids, sizes = machine.encode_all(texts)
    return pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), ids)


def encode(
    docs: DataFrame, vocabulary: str, *, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(id, ids): the piece ids of every whole text.

    Null and empty texts have no ids. Null ids of rows, repeated rows and an
    empty table pass through; other columns are ignored.
    """
    shared, kind = _shared(docs, vocabulary), docs.schema[id].dataType.simpleString()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = per_process("pieces", shared.value, lambda d: Transducer(pickle.loads(d)))
        for whole in stream:
            for batch in portions(whole, 1, PORTION_ROWS, PORTION_BYTES):
                ids = _id_list(machine, [t or "" for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["id", "ids"])

    return docs.select(id, text).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id)


def decode(
    encoded: DataFrame, vocabulary: str, *, id: str = "doc_id", ids: str = "ids",
) -> DataFrame:
    """(id, text) of encoded rows; null ids give the empty text."""
    shared, kind = _shared(encoded, vocabulary), encoded.schema[id].dataType.simpleString()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = per_process("pieces", shared.value, lambda d: Transducer(pickle.loads(d)))
        for whole in stream:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [machine.decode(x.as_py() or ()) for x in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return encoded.select(id, ids).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id)


def encode_checked(
    docs: DataFrame, vocabulary: str, *, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(id, ids, n_ids, round_trip): ``encode`` and whether ``decode`` gives the text back.

    It does for every text but those that hold the mark ``▁`` itself, which reads
    back as a space. A null text counts as the empty one.
    """
    shared, kind = _shared(docs, vocabulary), docs.schema[id].dataType.simpleString()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = per_process("pieces", shared.value, lambda d: Transducer(pickle.loads(d)))
        for whole in stream:
            for batch in portions(whole, 1, PORTION_ROWS, PORTION_BYTES):
                texts = pc.fill_null(batch.column(1), "")
                ids = _id_list(machine, texts.to_pylist())
                same = pc.equal(machine.decode_all(ids), texts.cast(pa.large_binary()))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids, same], ["id", "ids", "same"])

    out = docs.select(id, text).mapInArrow(run, f"id {kind}, ids array<int>, same boolean")
    return out.select(F.col("id").alias(id), "ids", F.size("ids").cast("long").alias("n_ids"), F.col("same").alias("round_trip"))
