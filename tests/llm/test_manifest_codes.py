"""Merkle manifest, token files and vector codes against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillspark.llm import merkle, token_files, vector_codes
from quillspark.llm.common import ascii_lower

BPE = str(public_tokenizers.path("byte_bpe_50k.json"))


# --- Merkle manifest ----------------------------------------------------------

def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text) -> str:
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([digest("".join(at[i:i + 8])) for i in range(0, len(at), 8)])
    return levels


def plain_fold(levels, at, found):
    proof = ""
    for level in levels[:-1]:
        run, slot = level[at // 8 * 8: at // 8 * 8 + 8], at % 8
        proof += "".join(run[:slot] + run[slot + 1:])
        found, at = digest("".join([*run[:slot], found, *run[slot + 1:]])), at // 8
    return found, proof


def plain_manifest(rows, found_text):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[lang] = plain_tree([leaf_of(r, r.text) for r in groups[lang]])
    top = plain_tree([trees[x][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        for at, r in enumerate(groups[lang]):
            h, low = plain_fold(trees[lang], at, leaf_of(r, found_text(r)))
            h, high = plain_fold(top, k, h)
            out.append((r.doc_id, leaf_of(r, r.text), trees[lang][-1][0], top[-1][0], digest(low + high), h, h == top[-1][0]))
    return sorted(out, key=str)


def test_states_make_sha256():
    rng = random.Random(5)
    for blocks in (0, 1, 3):
        hexes = [["".join(rng.choices("0123456789abcdef", k=64)) for _ in range(blocks)] for _ in range(4)]
        state = merkle.started(4)
        for i in range(blocks):
            words = np.array([[int(h[i][8 * w:8 * w + 8], 16) for h in hexes] for w in range(8)], np.uint32)
            state = merkle.compress(state, merkle.hex_block(words))
        got = merkle.finish(state, np.full(4, blocks))
        assert [("%08x" * 8) % tuple(got[:, k]) for k in range(4)] == [digest("".join(h)) for h in hexes]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, g int, idx int, gk string, n int, id string"


def check_manifest(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, 2, "k", 3, "y") for r in rows], SCHEMA)
    tampered = F.when(F.col("doc_id") % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    got = merkle.build(docs, found={"text": tampered}).proofs()
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def found_text(r):
        hit = r.doc_id is not None and r.doc_id % 3 == 0 and r.text is not None
        return r.text.translate(lower) if hit else r.text

    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(docs.collect(), found_text)


def test_manifest_equals_a_plain_tree(spark):
    rng = random.Random(3)
    sizes = {None: 3, "": 1, "en": 75, "de": 9, "é": 8, "zh": 65}
    rows = [(i, rng.choice(["Ab c", None, "", "ÄB", "plain"]), lang, rng.choice([None, "s:1"]), rng.choice([None, 4]))
            for lang, n in sizes.items() for i in rng.sample(range(10_000), n)]
    rows += [(7, "Same", "en", "s", 4)] * 20 + [(None, "X", "en", None, None), (None, None, None, None, None)]
    rows += [(7, "Other", "en", "s", 4), (9, "Long " * 200_000, "de", "s", 1)]
    check_manifest(spark, rows)


def test_manifest_over_several_blocks_and_many_groups(spark):
    rows = [(i, "T" if i % 2 else "t", "en", "s", i) for i in range(9, 9 + merkle.BLOCK + 3)]
    rows += [(i, "T", f"g{i % 70:02d}", "s", 1) for i in range(140)]
    check_manifest(spark, rows)


@pytest.mark.parametrize("n", [0, 1])
def test_manifest_of_almost_nothing(spark, n):
    check_manifest(spark, [(3, "Ab", "en", "s", 2)][:n]) if n else None
    docs = spark.createDataFrame([(3, "Ab", "en", "s", 2, "x", 1, 2, "k", 3, "y")][:n], SCHEMA)
    got = merkle.build(docs).proofs().collect()
    assert len(got) == n and all(r.verified and r.root == r.leaf for r in got)


# --- token files --------------------------------------------------------------

def test_numbers_of_all_lengths_come_back():
    edges = [0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1]
    rng = random.Random(1)
    for n in range(12):
        for numbers in (edges[:n], [rng.choice(edges) for _ in range(n)], [300] * n):
            numbers = np.array(numbers, "<u4")
            control, stored = token_files.pack(numbers)
            assert len(control) == -(-len(numbers) // 4)
            assert token_files.unpack(control, stored, len(numbers)).tolist() == numbers.tolist()


ODD = [
    "", " ", "a", " a", "a ", "a  b", "two words", "new\nline here", "tab\t x", "x \n y", "  a  b", "a\x1c b",
    "it's we'll 12 345 don't", "<|endoftext|> and x<|endoftext|> y", "日本 語 です", "é ́ x", "\x85 a\x85 b", "😀 😀",
    "word " * 300, "x" * 5000, "  a 　 b",
]


def test_words_apart_give_the_ids_of_whole_texts():
    whole, encoder = Tokenizer.from_file(BPE), token_files.WordEncoder(open(BPE, "rb").read())
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choices(" \n\tab'1.é　中s", k=40)) for _ in range(500)]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want and encoder.encode(texts[::-1]) == want[::-1]


def plain_ids(text):
    return [*Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("size,segment", [(200_000, 300), (1 << 20, 2 << 20)])
def test_files_hold_the_ids_in_order(spark, tmp_path, monkeypatch, size, segment):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", segment)
    rows = [(100 - i, t) for i, t in enumerate(ODD)] + [(5, None), (5, "other"), (None, "no id"), (-3, "x")]
    rows += [(7, "same text again")] * 40 + [(8, "long text " * 100_000)]
    docs = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "doc_id long, text string, id int, n int, hash string")
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs.repartition(5), path, BPE, text_bytes_per_file=size)
    got = token_files.read_token_files(spark, path).collect()
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(plain_ids(t))
    start = 0
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda x: (x is not None, x or 0))
    for r in got:
        assert r.ids in want[r.doc_id] and r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        want[r.doc_id].remove(r.ids)
        start += len(r.ids)
    assert not any(want.values())
    assert token_files.read_token_files(spark, path, ids=False).filter("ids IS NOT NULL").isEmpty()


def test_no_documents_and_damaged_files(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_token_files(none, str(tmp_path / "none"), BPE)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).collect() == []
    segment = token_files.segment_bytes([4, None], [2, 3], np.array([1, 2, 70_000, 2, 9], "<u4")) + b"\n"
    (names, counts, ids), = token_files.read_segments(segment)
    assert names == [4, None] and counts.tolist() == [2, 3] and ids.tolist() == [1, 2, 70_000, 2, 9]
    assert [x.tolist() for x in token_files.by_frequency(ids)] == [[2, 1, 9, 70_000], [1, 0, 3, 0, 2]]
    for bad in (segment[:-9], segment[:20], segment[:-5] + b"\xff" + segment[-4:]):
        with pytest.raises(ValueError):
            list(token_files.read_segments(bad))


# --- vector codes -------------------------------------------------------------

def plain_nearest(entries, point):
    d = [sum((int(a) - int(b)) ** 2 for a, b in zip(e, point)) for e in entries]
    return d.index(min(d)), min(d)


@pytest.mark.parametrize("span", [1, 2, 5, 300])
def test_orchard_finds_the_first_nearest(span):
    rng = np.random.default_rng(span)
    for k, width in ((1, 1), (2, 3), (64, 1), (64, 4), (40, 2)):
        entries, points = rng.integers(-span, span + 1, (k, width)), rng.integers(-span, span + 1, (200, width))
        index, apart = vector_codes.Orchard(entries).nearest(points)
        assert list(zip(index.tolist(), apart.tolist())) == [plain_nearest(entries, p) for p in points]


def plain_codes(rows, parts, k, rounds):
    """Codes and errors by plain loops; rows are (id, vector) in order."""
    dims = len(rows[0][1])
    width = -(-dims // parts)
    cut = []
    for _, v in rows:
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in v] + [0] * (width * parts - dims)
        cut.append([whole[p * width:(p + 1) * width] for p in range(parts)])
    books = [[c[p] for c in cut[:k]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(plain_nearest(books[p], c[p])[0], []).append(c[p])
            books[p] = [[sum(x) // len(members[e]) for x in zip(*members[e])] if e in members else old
                        for e, old in enumerate(books[p])]
    found = [[plain_nearest(books[p], c[p]) for p in range(parts)] for c in cut]
    return books, ["".join(f"{i:02x}" for i, _ in f) for f in found], [sum(d for _, d in f) for f in found]


VECTORS = "vec_id long, embedding array<float>, label int, code string, id int, v int, error int, __label int"


@pytest.mark.parametrize("dims,parts,k", [(32, 16, 64), (6, 4, 5), (5, 5, 8)])
def test_codes_equal_plain_loops(spark, dims, parts, k):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(0, 0.05, dims).tolist()) for i in range(150)] + [(200 + i, [0.25] * dims) for i in range(60)]
    rows += [(300, [-0.001] * dims), (301, [0.0] * dims)]
    bad = [(-1, None), (-2, []), (-3, [None] * dims), (-4, [float("nan")] * dims), (-5, [float("inf")] * dims),
           (400, [1.0] * (dims - 1))]
    label = lambda i: None if i % 7 == 0 else i % 3
    docs = spark.createDataFrame([(i, v, label(i), "c", 1, 2, 3, 4) for i, v in rows + bad], VECTORS).repartition(4)
    books = vector_codes.fit(docs, parts=parts, entries=k)
    got = vector_codes.with_label_error(vector_codes.encode(docs, books)).collect()
    want_books, codes, errors = plain_codes(rows, parts, k, 2)
    assert books.entries.tolist() == want_books
    text = ",".join(str(x) for p in want_books for e in p for x in e)
    assert books.digest() == hashlib.sha256(text.encode()).hexdigest()
    want = {i: (c, e) for (i, _), c, e in zip(rows, codes, errors)}
    total = {}
    for i, (_, e) in want.items():
        total[label(i)] = total.get(label(i), 0) + e
    assert {r.vec_id: (r.code, r.error) for r in got} == want and len(got) == len(want)
    assert all(r.label_error == total[r.label] and r.label == label(r.vec_id) for r in got)


def test_codes_of_few_equal_and_no_rows(spark):
    few = spark.createDataFrame([(None, [1.0, 2.0], None)] * 3 + [(2, [1.0, 2.0], 1), (2, [0.0, 2.0], 1), (1, [1e30, -1e30], 1)],
                                "vec_id long, embedding array<double>, label int")
    books = vector_codes.fit(few, parts=2, entries=64)
    got = vector_codes.with_label_error(vector_codes.encode(few, books)).collect()
    assert len(got) == 6 and all(r.error == 0 for r in got) and books.entries.shape == (2, 6, 1)
    assert books.entries.max() == vector_codes.component_bound(2)
    none = few.limit(0)
    assert vector_codes.fit(none) is None
    assert vector_codes.with_label_error(vector_codes.encode(none, None)).collect() == []
