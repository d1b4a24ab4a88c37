"""Merkle dataset manifest that keeps SHA-256 states, so a change is folded without its left side.

A row's leaf is the digest of its columns. Leaves of a group (a language) are
ordered by id and eight consecutive nodes become one, up to the group's root;
group roots make the manifest's root in the same way. A child's digest is 64 hex
digits, one SHA block, so the state of the hash before each child slot is eight
words. A parent keeps these states. Folding a replaced leaf resumes the state of
its slot with the replacement and the siblings to the right only, level by level.

Trees are cut into blocks of four levels. A block of up to 4,096 nodes is built
by one call and stored as one row; its root is a node of the next block, so the
blocks of a level are independent of each other and none grows with the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import written
from quillspark.operators.ordering import number_and_count, number_rows

FANOUT = 8
LEVELS = 4  # levels in a block
BLOCK = FANOUT**LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


# --- SHA-256 on columns of states ---------------------------------------------

def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid - 1)
    return low


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, math.isqrt(p) + 1))]
# The standard's constants: 32 bits of the fractions of square and cube roots of primes.
START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _PRIMES[:8]], np.uint32)
ROUNDS = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _PRIMES], np.uint32)


def _rotated(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states (8, n) after a block (16, n) of big-endian words each."""
    w = list(block)
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        w.append(
            w[i - 16] + w[i - 7]
            + (_rotated(x, 7) ^ _rotated(x, 18) ^ (x >> np.uint32(3)))
            + (_rotated(y, 17) ^ _rotated(y, 19) ^ (y >> np.uint32(10)))
        )
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        t = h + (_rotated(e, 6) ^ _rotated(e, 11) ^ _rotated(e, 25)) + (g ^ (e & (f ^ g))) + (ROUNDS[i] + w[i])
        u = (_rotated(a, 2) ^ _rotated(a, 13) ^ _rotated(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


_HEX = np.array([int.from_bytes(b"%02x" % i, "big") for i in range(256)], np.uint32)


def hex_block(digest: np.ndarray) -> np.ndarray:
    """Digests (8, …) as the words (16, …) of their hex text."""
    out = np.empty((16, *digest.shape[1:]), np.uint32)
    eight = np.uint32(255)
    for i, word in enumerate(digest):
        out[2 * i] = (_HEX[word >> np.uint32(24)] << np.uint32(16)) | _HEX[(word >> np.uint32(16)) & eight]
        out[2 * i + 1] = (_HEX[(word >> np.uint32(8)) & eight] << np.uint32(16)) | _HEX[word & eight]
    return out


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of messages of so many whole blocks."""
    last = np.zeros((16, state.shape[1]), np.uint32)
    bits = np.asarray(blocks, np.uint64) * np.uint64(512)
    last[0], last[14], last[15] = 0x80000000, bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return compress(state, last)


def started(n: int) -> np.ndarray:
    return np.repeat(START[:, None], n, 1)


def _words(column: pa.Array) -> np.ndarray:
    """(8, n) words of a column of digests."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, ">u4").reshape(-1, 8).T.astype(np.uint32)


def _binary(words: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(words.T).astype(">u4")
    return pa.array([r.tobytes() for r in rows], pa.binary())


# --- blocks -------------------------------------------------------------------

@dataclass
class Level:
    """Parents of one level of a block: child counts (m), children and states (8 words, 8 slots, m)."""

    counts: np.ndarray
    kids: np.ndarray
    states: np.ndarray


def levels_of(size: int) -> int:
    """How many levels of a block a group of ``size`` nodes has."""
    n = 0
    while size > 1 and n < LEVELS:
        size, n = -(-size // FANOUT), n + 1
    return n


def grow(digests: np.ndarray, levels: int) -> tuple[list[Level], np.ndarray]:
    """The levels above the nodes (8, n) of a block, and the digest of its root."""
    out = []
    for _ in range(levels):
        n = digests.shape[1]
        m = -(-n // FANOUT)
        at = np.arange(n)
        counts = np.bincount(at // FANOUT, minlength=m)
        kids = np.zeros((8, FANOUT, m), np.uint32)
        kids[:, at % FANOUT, at // FANOUT] = digests
        states, state = np.zeros((8, FANOUT, m), np.uint32), started(m)
        for slot in range(FANOUT):
            has = counts > slot
            states[:, slot] = state  # the copy that a later fold resumes
            if has.any():
                state[:, has] = compress(state[:, has], hex_block(kids[:, slot, has]))
        out.append(Level(counts, kids, states))
        digests = finish(state, counts)
    return out, digests


def climb(cur, proof, blocks, slot, count, state, kids):
    """One level up, for a node per column.

    ``state`` is the parent's before the node's slot, ``kids`` (8, 8 slots, n) its
    children. Returns the parent's digest with the node replaced by ``cur``, the
    proof's state after all siblings, and its number of blocks.
    """
    state = compress(state, hex_block(cur))
    for t in range(1, FANOUT):
        right = (slot < t) & (t < count)
        if right.any():
            state[:, right] = compress(state[:, right], hex_block(kids[:, t, right]))
    for t in range(FANOUT):
        other = (slot != t) & (t < count)
        if other.any():
            proof[:, other] = compress(proof[:, other], hex_block(kids[:, t, other]))
    return finish(state, count), proof, blocks + count - 1


def _stored(levels: list[Level]) -> tuple[list[int], bytes]:
    """The sizes of levels and one string of their counts, children and states."""
    parts = [x.astype("<u4").tobytes() for v in levels for x in (v.counts, v.kids, v.states)]
    return [len(v.counts) for v in levels], b"".join(parts)


def _loaded(sizes: list[int], data: bytes) -> list[Level]:
    words, at, out = np.frombuffer(data, "<u4").astype(np.uint32), 0, []
    for m in sizes:
        counts, kids, states = np.split(words[at:at + m * (1 + 16 * FANOUT)], [m, m * (1 + 8 * FANOUT)])
        shape = (8, FANOUT, m)
        out.append(Level(counts.astype(np.int64), kids.reshape(shape), states.reshape(shape)))
        at += m * (1 + 16 * FANOUT)
    return out


# One level of a path: slot, count, the state before the slot, all children.
_STEP = 2 + 32 + 32 * FANOUT


def _paths(levels: list[Level], n: int) -> list[bytes]:
    """Per node of a block what ``climb`` needs on the way to the block's root."""
    out, at = np.zeros((n, len(levels), _STEP), np.uint8), np.arange(n)
    for i, v in enumerate(levels):
        up, slot = at // FANOUT, at % FANOUT
        out[:, i, 0], out[:, i, 1] = slot, v.counts[up]
        state = np.ascontiguousarray(v.states[:, slot, up].T)
        kids = np.ascontiguousarray(v.kids[:, :, up].transpose(2, 1, 0))
        out[:, i, 2:34] = state.view(np.uint8).reshape(n, 32)
        out[:, i, 34:] = kids.reshape(n, -1).view(np.uint8)
        at = up
    return [r.tobytes() for r in out.reshape(n, -1)]


def _climb_paths(cur, proof, blocks, paths: list[bytes]):
    """All levels of each node's path; paths differ in length between groups."""
    lengths = np.array([len(p) for p in paths])
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        steps = np.frombuffer(b"".join(paths[i] for i in at), np.uint8).reshape(len(at), -1, _STEP)
        c, p, b = cur[:, at], proof[:, at], blocks[at]
        for i in range(steps.shape[1]):
            step = np.ascontiguousarray(steps[:, i])
            state = np.ascontiguousarray(step[:, 2:34]).view(np.uint32).T.copy()
            kids = np.ascontiguousarray(step[:, 34:]).view(np.uint32).reshape(-1, FANOUT, 8).transpose(2, 1, 0)
            c, p, b = climb(c, p, b, step[:, 0].astype(int), step[:, 1].astype(int), state, kids)
        cur[:, at], proof[:, at], blocks[at] = c, p, b
    return cur, proof, blocks


# --- trees in Spark -----------------------------------------------------------

def _build_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """(g, block, size, root, sizes, tree) of the nodes of one block."""
    table = table.combine_chunks().sort_by("idx")
    size = table["size"][0].as_py()
    levels, root = grow(_words(table["digest"]), levels_of(size))
    sizes, tree = _stored(levels)
    return pa.table({
        "g": table["g"].slice(0, 1), "block": [key[1].as_py()], "size": [-(-size // BLOCK)],
        "root": _binary(root), "sizes": pa.array([sizes], pa.list_(pa.int32())), "tree": [tree],
    })


def _blocks(nodes: DataFrame, label: str) -> DataFrame:
    """The stored blocks over nodes (g, idx, size, digest); size is that of the group."""
    cut = nodes.select("g", F.floor(F.col("idx") / BLOCK).alias("block"), "idx", "size", "digest")
    return written(cut.groupBy("g", "block").applyInArrow(
        _build_block, "g long, block long, size long, root binary, sizes array<int>, tree binary"), label)


def _node_paths(table: pa.Table) -> pa.Table:
    """(g, idx, block, path) for every node of a stored block."""
    out = []
    for g, block, sizes, tree, n in zip(*(table[c].to_pylist() for c in ("g", "block", "sizes", "tree", "n"))):
        paths = _paths(_loaded(sizes, tree), n)
        out.append(pa.table({
            "g": [g] * n, "idx": pa.array(range(block * BLOCK, block * BLOCK + n), pa.int64()),
            "block": [block] * n, "path": pa.array(paths, pa.binary()),
        }))
    return pa.concat_tables(out)


def _explode_paths(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for i in range(batch.num_rows):
            yield from _node_paths(pa.Table.from_batches([batch.slice(i, 1)])).to_batches()


def _above(nodes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(g, idx, path) to the group's root for nodes (g, idx, size, digest), and (g, digest) of the roots.

    ``most`` is the largest group's number of nodes.
    """
    tables = []
    while most > 1:
        blocks = _blocks(nodes, "merkle-blocks")
        n = F.least(F.lit(BLOCK), F.col("all") - F.col("block") * BLOCK).cast("int")
        sized = blocks.join(nodes.groupBy("g").agg(F.first("size").alias("all")), "g").withColumn("n", n)
        tables.append(written(
            sized.select("g", "block", "sizes", "tree", "n").mapInArrow(
                _explode_paths, "g long, idx long, block long, path binary"), "merkle-paths"))
        nodes = blocks.select("g", F.col("block").alias("idx"), "size", F.col("root").alias("digest"))
        most = -(-most // BLOCK)
    paths = nodes.select("g", "idx", F.lit(b"").alias("path"))
    for t in reversed(tables):
        up = paths.select(F.col("g").alias("g2"), F.col("idx").alias("block2"), F.col("path").alias("rest"))
        paths = t.join(up, (F.col("g") == F.col("g2")) & (F.col("block") == F.col("block2"))).select(
            "g", "idx", F.concat("path", "rest").alias("path"))
    return paths, nodes.select("g", "digest")


def leaf_digest(columns: list[Column]) -> Column:
    """sha256, in hex, of the columns' values: ``-`` for null, else byte count, colon and value."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _fold_block(key: tuple[pa.Scalar, ...], leaves: pa.Table, tree: pa.Table) -> pa.Table:
    """Folds the found leaf of every row of a block up to the block's root."""
    leaves = leaves.combine_chunks()
    n = leaves.num_rows
    cur, proof, blocks = _words(leaves["found"]), started(n), np.zeros(n, np.int64)
    at = leaves["idx"].to_numpy() % BLOCK
    for v in _loaded(tree["sizes"][0].as_py(), tree["tree"][0].as_py()) if n else ():
        up, slot = at // FANOUT, at % FANOUT
        cur, proof, blocks = climb(cur, proof, blocks, slot, v.counts[up], v.states[:, slot, up], v.kids[:, :, up])
        at = up
    return pa.table({
        "id": leaves["id"], "g": leaves["g"], "block": leaves["block"], "leaf": leaves["leaf"],
        "cur": _binary(cur), "proof": _binary(proof), "blocks": blocks,
    })


def _fold_paths(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for start in range(0, batch.num_rows, 2048):  # a path is a kilobyte or so
            part = batch.slice(start, 2048)
            cur, proof, blocks = _climb_paths(
                _words(part["cur"]), _words(part["proof"]), part["blocks"].to_numpy().copy(), part["path"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part["id"], part["leaf"], part["subroot"], part["root"], _binary(finish(proof, blocks)), _binary(cur)],
                ["id", "leaf", "subroot", "root", "proof", "folded"])


@dataclass
class Manifest:
    """A stored tree: ``leaves`` (id, g, idx, leaf, found), ``blocks`` of the lowest levels with
    their states, ``paths`` (g, block, path, subroot, root) from a block up to the root."""

    leaves: DataFrame
    blocks: DataFrame
    paths: DataFrame
    id: str

    def proofs(self) -> DataFrame:
        """Per row: id, leaf, subroot, root, proof_sha256, folded_root and verified.

        ``folded_root`` is the root recomputed from the row as it was found and the
        siblings as they were stored; ``proof_sha256`` digests those siblings from
        the lowest level to the root, left to right.
        """
        block = F.floor(F.col("idx") / BLOCK).alias("block")
        leaves = self.leaves.select("id", "g", block, "idx", "leaf", "found")
        kind = self.leaves.schema["id"].dataType.simpleString()
        folded = leaves.groupBy("g", "block").cogroup(self.blocks.groupBy("g", "block")).applyInArrow(
            _fold_block, f"id {kind}, g long, block long, leaf binary, cur binary, proof binary, blocks long")
        done = folded.join(self.paths, ["g", "block"]).select(
            "id", "leaf", "subroot", "root", "cur", "proof", "blocks", "path",
        ).mapInArrow(_fold_paths, f"id {kind}, leaf binary, subroot binary, root binary, proof binary, folded binary")
        text = lambda c: F.lower(F.hex(c))
        return done.select(
            F.col("id").alias(self.id), text("leaf").alias("leaf"), text("subroot").alias("subroot"),
            text("root").alias("root"), text("proof").alias("proof_sha256"), text("folded").alias("folded_root"),
            (F.col("folded") == F.col("root")).alias("verified"),
        )


def build(
    docs: DataFrame, *, columns: tuple[str, ...] = COLUMNS, id: str = "doc_id", group: str = "lang",
    found: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of ``docs``: a tree of eight per group, and one over the group roots.

    Groups are ordered by ``group`` (null first, then by bytes), rows by ``id``
    (null first), then by leaf, so repeated ids and rows have a place; equal rows
    are equal leaves. ``found`` names columns whose values are to be verified in
    place of the stored ones, as expressions over ``docs``. Columns not named in
    ``columns`` do not count, whatever their names. A table of one row is its
    leaf; an empty table has no proofs.
    """
    found = found or {}
    key = F.when(F.col(group).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    leaf = F.unhex(leaf_digest([F.col(c) for c in columns]))
    now = F.unhex(leaf_digest([found.get(c, F.col(c)) for c in columns])) if found else leaf
    rows = written(docs.select(
        F.col(id).alias("id"), key.alias("gk"), leaf.alias("leaf"), now.alias("found"),
        F.monotonically_increasing_id().alias("copy"),
    ), "merkle-leaves")
    # ``copy`` only splits what is equal otherwise.
    numbered = number_rows(rows, ["gk", "id", "leaf", "found", "copy"])
    # A group goes by the number of its first row, which is in the order of groups.
    groups = written(numbered.groupBy("gk").agg(F.min("n").alias("g"), F.count(F.lit(1)).alias("size")), "merkle-groups")
    leaves = written(numbered.join(groups, "gk").select(
        "id", "g", (F.col("n") - F.col("g")).alias("idx"), "size", "leaf", "found"), "merkle-order")
    blocks = _blocks(leaves.select("g", "idx", "size", F.col("leaf").alias("digest")), "merkle-tree")
    largest = blocks.agg(F.max("size")).first()[0] or 0
    nodes = blocks.select("g", F.col("block").alias("idx"), "size", F.col("root").alias("digest"))
    paths, subroots = _above(nodes, largest)

    ordered, n = number_and_count(subroots.withColumnRenamed("g", "of"), ["of"])
    top = written(ordered.select(
        F.lit(0).cast("long").alias("g"), (F.col("n") - 1).alias("idx"), F.lit(n).cast("long").alias("size"),
        "digest", "of"), "merkle-subroots")
    over, roots = _above(top.select("g", "idx", "size", "digest"), n)
    root = roots.first()  # the only one
    ends = top.select("of", "idx", F.col("digest").alias("subroot")).join(
        over.select("idx", F.col("path").alias("rest")), "idx",
    ).withColumn("root", F.lit(bytes(root.digest) if root else None).cast("binary"))
    up = written(paths.join(ends.drop("idx"), F.col("g") == F.col("of")).select(
        "g", F.col("idx").alias("block"), F.concat("path", "rest").alias("path"), "subroot", "root"), "merkle-up")
    return Manifest(leaves, blocks.select("g", "block", "sizes", "tree"), up, id)
