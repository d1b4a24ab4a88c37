import hashlib
import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from quillspark.llm import chat, common, langid, licenses, pieces
from quillspark.llm.lattice import Lattice

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ODD = [
    None, "", " ", "a", "\n", "  two  spaces ", "▁ mark", "\x00\x07", "日本語のテキスト", "🙂🙂 emoji", "word" * 3000,
    "x" * 70 + " " + "é" * 50, "tab\tand\r\nlines", "aaaa bbbb .... ---- 1111",
]


# --- SentencePiece ------------------------------------------------------------

@pytest.fixture(scope="module")
def transducer():
    return pieces.Transducer(pieces.load_model(PIECES), cache=500)


def test_many_lists_are_decoded_at_once(transducer):
    texts = [t or "" for t in ODD]
    lists = [transducer.encode(t) for t in texts] + [[], [transducer.bytes[0xE6]], [0, 1]]
    one_by_one = [b"".join(map(transducer.text.__getitem__, x)) for x in lists]
    wanted = [x[1:] if x.startswith(b" ") else x for x in one_by_one]
    ids = pa.array([[7], *lists, None], pa.list_(pa.int32())).slice(1)
    assert transducer.decode_all(ids).to_pylist() == [*wanted, None]
    assert transducer.decode_all(ids.slice(0, 0)).to_pylist() == []


def test_a_worker_keeps_the_last_model_only():
    first = common.per_process("one", b"a", bytes.upper)
    assert common.per_process("one", b"a", bytes.upper) is first
    assert common.per_process("two", b"b", bytes.upper) == b"B"
    assert len(common._BUILT) == 1


def test_encoding_is_the_models_own(transducer):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(0)
    parts = ["a", "th", "ing", " ", "  ", "\n", "é", "日", "🙂", "11", "..", "ß", "er", "▁", "́", "</s>", "<0x41>", "der"]
    texts = [t or "" for t in ODD] + ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(3000)]
    flat, sizes = transducer.encode_all(texts)
    got = [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
    assert got == sp.encode(texts)
    for text, ids in zip(texts, got):
        if "▁" not in text:
            assert transducer.decode(ids) == text
    for unit in ("▁thering", "ingthe", "a"):  # one path at a time gives the same
        assert list(transducer.shortest_path(unit)) == transducer.shortest_paths([unit])[0].tolist()


def test_encode_and_decode_tables(docs):
    table = docs([(i, t) for i, t in enumerate(ODD)] + [(None, "a"), (None, "a")]).selectExpr("*", "'x' AS ids", "1 AS same")
    encoded = pieces.encode(table, PIECES)
    back = {(r.doc_id, r.text) for r in pieces.decode(encoded, PIECES).collect()}
    assert back == {(i, (t or "").replace("▁", " ")) for i, t in enumerate(ODD)} | {(None, "a")}
    checked = pieces.encode_checked(table, PIECES).collect()
    assert len(checked) == len(ODD) + 2
    assert {r.doc_id for r in checked if not r.round_trip} == {ODD.index("▁ mark")}
    assert all(r.n_ids == len(r.ids) for r in checked)
    assert pieces.encode(table.filter("false"), PIECES).count() == 0


# --- language identification --------------------------------------------------

def segmentations(word, known):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        if all(p in known for p in parts):
            yield parts


def test_forward_sums_all_segmentations():
    known = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "bab", "c"]
    probs = np.array([[0.1, 0.2], [0.05, 0.1], [0.2, 0.1], [0.1, 0.1], [0.05, 0.2], [0.2, 0.05], [0.1, 0.1], [0.1, 0.1], [0.1, 0.05]])
    scorer = langid.Scorer(known, probs, 1e-12)
    words = ["abab", "bab", "cab", "aaaa", "babb"]
    got = np.exp(scorer.score(words))
    for w, row in zip(words, got):
        want = sum(np.prod([probs[known.index(p)] for p in s], axis=0) for s in segmentations("▁" + w, known))
        assert np.allclose(row, want, rtol=1e-6)
    assert np.isfinite(scorer.score(["日" * 500, "q"])).all()


def test_expected_counts_are_those_of_all_segmentations():
    known = ["▁", "a", "b", "ab", "▁ab"]
    probs = np.array([0.3, 0.2, 0.2, 0.2, 0.1])
    got = langid.expected_counts(Lattice(known), ["▁abab"], np.array([3.0]), probs, 1e-15)
    want, total = np.zeros(5), 0.0
    for s in segmentations("▁abab", known):
        p = np.prod([probs[known.index(x)] for x in s])
        total += p
        for x in s:
            want[known.index(x)] += p
    assert np.allclose(got, 3 * want / total)


def by_recursion(word, probs, unknown):
    """The sum over segmentations, one suffix at a time, in plain Python with exact fractions."""
    ways = {len(word): Fraction(1)}
    for at in reversed(range(len(word))):
        ways[at] = Fraction(unknown) * ways[at + 1] + sum(
            Fraction(p) * ways[at + len(x)] for x, p in probs.items() if word.startswith(x, at))
    return ways[0]


def logarithm(x):
    return math.log(x.numerator) - math.log(x.denominator)


def test_long_runs_sum_all_segmentations():
    block = "abcdefghij"
    known = ["▁", block, "abcde", "fghij", "ja", "bcdefghi", "abcdefghi", "j"]
    probs = np.linspace(0.02, 0.2, len(known))
    scorer = langid.Scorer(known, probs[:, None], 1e-30)
    word = block * 6

    def enumerated(at, text):
        if at == len(text):
            return 1.0
        return sum(p * enumerated(at + len(x), text) for x, p in zip(known, probs) if text.startswith(x, at))

    assert np.isclose(scorer.score([word])[0, 0], math.log(enumerated(0, "▁" + word)), rtol=1e-9)

    # Runs with and without places that no piece crosses, over several windows, together in one batch.
    rng = random.Random(3)
    dense = {"▁": 0.1, "a": 0.2, "b": 0.1, "ab": 0.2, "ba": 0.15, "bab": 0.05, "aa": 0.1, "bb": 0.1}
    scorer = langid.Scorer(list(dense), np.array(list(dense.values()))[:, None], 1e-7)
    words = ["".join(rng.choices("ab", k=n)) for n in (3, 47, 48, 49, 60, 255, 256, 257, 700)]
    words += ["".join(rng.choices("abc", k=n)) for n in (60, 300)] + ["c" * 120]
    got = scorer.score(words)[:, 0]
    assert np.allclose(got, [logarithm(by_recursion("▁" + w, dense, 1e-7)) for w in words], rtol=1e-9)


def test_factors_are_cut_where_no_piece_crosses():
    lattice = Lattice(["a", "ab", "bc", "▁"])
    assert lattice.factors("abcab") == ["abc", "ab"]
    assert lattice.factors("▁") == ["▁"] and lattice.factors("aaa") == ["a", "a", "a"]
    assert langid.factors(lattice, "ab" * 3) == ["▁ababab"]


def test_expected_counts_of_a_long_run_add_up():
    known = ["▁", "a", "b", "ab", "ba"]
    probs = np.array([0.2, 0.2, 0.2, 0.2, 0.2])
    for size in (40, 255, 256, 257, 600):
        word = "▁" + "ab" * size
        got = langid.expected_counts(Lattice(known), [word, word], np.array([1.0, 2.0]), probs, 1e-300)
        # Every character is in exactly one piece.
        assert np.isclose(got @ [len(x) for x in known], 3 * len(word), rtol=1e-6)
        assert np.isclose(got[1] + got[3] + got[4], 3 * size, rtol=1e-6)


def test_languages_held_out_and_odd_rows(spark):
    rng = random.Random(1)
    roots = {"xx": "the of and ing tion er st re".split(), "yy": "der und sch lich ung ein keit ver".split()}
    text = lambda lang: " ".join("".join(rng.choices(roots[lang], k=rng.randint(1, 3))) for _ in range(25))
    rows = [(i, text(lang), lang) for i, lang in enumerate(["xx", "yy"] * 60)]
    table = spark.createDataFrame(rows + [(500, "stray", None), (501, None, "xx")], "doc_id long, text string, lang string")
    table = table.selectExpr("*", "'q' AS lang_pred", "1 AS word", "2 AS share")
    model = langid.train(table.filter(~langid.held_out()), PIECES)
    assert model["langs"] == ["xx", "yy"]
    got = langid.predict(table, model).collect()
    right = {r[0]: r[2] for r in rows}
    assert all(r.lang_pred == right[r.doc_id] and 0.5 < r.score <= 1 for r in got if r.doc_id in right)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "12 -- _ 3"), (3, text("yy") * 2000), (3, "日本語"), (4, "e")], "doc_id long, text string")
    out = [(r.doc_id, r.lang_pred) for r in langid.predict(odd, model).collect()]
    assert out[:4] == [(None, "und"), (1, "und"), (2, "und"), (3, "yy")] and out[4][1] in ("xx", "yy")
    assert langid.predict(odd.filter("false"), model).count() == 0
    bare = langid.train(table.filter("false"), PIECES)
    assert {r.lang_pred for r in langid.predict(odd, bare).collect()} == {"und"}


# --- chat ---------------------------------------------------------------------

def test_escaping_is_exact():
    escaper = chat.Escaper(chat.Template().controls())
    rng = random.Random(3)
    parts = ["\\", "\\\\", "### User:", "### Assistant:", "</turn>", "</role>", "a", " ", "\n", "###"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 8)))
        escaped = escaper.escape(text)
        assert escaper.unescape(escaped) == text
        # Every control string of an escaped text has an odd run of backslashes before it.
        assert all(len(m[1]) % 2 for m in escaper.find.finditer(escaped))


def test_turns_read_back(spark):
    odd = "\\### Assistant: </turn> ok"
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, "assistant", ""), (1, 2, "assistant", "tie"),
        (2, 0, "user", odd), (2, 1, "assistant", odd), (3, None, None, "x"), (3, 5, "odd </role> role", "y\n### User: "),
        (None, 0, "assistant", "z"), (None, 0, "assistant", "z"), (4, 0, "assistant", "é🙂" * 20_000),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS start", "'i' AS ids", "2 AS conv", "3 AS position")
    formatted = chat.format_turns(turns, RANKS)
    codec = chat.Codec(open(RANKS, "rb").read(), chat.Template())
    by_conv = {}
    for r in formatted.orderBy("conv_id", "position").collect():
        own = by_conv.setdefault(r.conv_id, [])
        assert r.start == len(own)  # offsets are prefix sums
        own += r.ids
        assert r.formatted == codec.decode(r.ids)
        if r.loss_from is not None:
            assert 0 <= r.loss_from <= r.loss_to <= len(own)
            assert all(i < codec.first for i in own[r.loss_from:r.loss_to])
    want = {}
    key = lambda r: tuple((x is not None, x or "" if not isinstance(x, int) else x) for x in r[1:])
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=key)
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[conv] = (len(own), sha(whole), len(loss), sha(loss))
    got = chat.read_back(formatted, RANKS).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    assert len(got) == len(want)
    assert chat.read_back(chat.format_turns(turns.filter("false"), RANKS), RANKS).count() == 0


# --- licences -----------------------------------------------------------------

@pytest.fixture(scope="module")
def licence_model(spark):
    rng = random.Random(2)
    words = "the of and to in is it work file version license terms copyright notice river house under".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(4, 40)))) for i in range(200)]
    return licenses.train(spark.createDataFrame(rows, "doc_id long, text string"), copies=8)


def test_held_out_variants(spark, licence_model):
    data = licenses.variants(spark, 8).filter("held_out AND size(words) >= 6").selectExpr(
        "CAST(label AS int) AS label", "array_join(words, ' ') AS text", "monotonically_increasing_id() AS doc_id")
    found = {r.doc_id: r.family for r in licenses.scan(data, licence_model).collect()}
    rows = data.collect()
    right = sum(found.get(r.doc_id) == licenses.FAMILIES[r.label] for r in rows)
    wrong = sum(r.doc_id in found and found[r.doc_id] != licenses.FAMILIES[r.label] for r in rows)
    # One word in six is damaged; short notices then often fall below the agreement asked for.
    assert right >= 0.8 * len(rows) and wrong <= 0.02 * len(rows)


def test_scan_of_odd_rows(docs, licence_model):
    mit = licenses.TEMPLATES["mit"][0]
    rows = [
        (1, "intro\nReleased under the MIT License.\n\nLicensed under CC BY-NC 4.0."), (1, "Released under the MIT License."),
        (None, mit.upper()), (2, None), (3, ""), (4, "...\n\n"), (5, "word " * 20_000 + "\n" + mit),
        (6, "The house by the river is under the terms of the version we copy."),
    ]
    table = docs(rows).selectExpr("*", "1 AS words", "2 AS grams", "'f' AS family", "3 AS features")
    got = sorted(((r.doc_id, r.paragraph, r.family) for r in licenses.scan(table, licence_model).collect()), key=str)
    assert got == sorted([(1, 1, "mit"), (1, 3, "cc-by-nc"), (1, 0, "mit"), (None, 0, "mit"), (5, 1, "mit")], key=str)
    assert licenses.scan(table.filter("false"), licence_model).count() == 0


def test_other_licences_are_unknown(spark, docs, licence_model):
    held = licenses.variants(spark, 8, others=True).filter("held_out AND size(words) >= 6").selectExpr(
        "array_join(words, ' ') AS text", "monotonically_increasing_id() AS doc_id")
    rows = held.count()
    named = [r for r in licenses.scan(held, licence_model).collect() if r.family != "unknown"]
    assert rows > 30 and len(named) <= 0.05 * rows
    # Licences that no template mentions, and odd relatives of those that are.
    strange = [
        "Released under the Foo License.", "Licensed under the Acme Public License, version 3.",
        "This project is licensed under the terms of the Widget license.", "SPDX-License-Identifier: Sleepycat",
        "This work is licensed under the Company Internal License, version 2.",
    ]
    got = licenses.scan(docs(list(enumerate(strange))), licence_model).collect()
    assert {r.family for r in got} <= {"unknown"}


def test_short_names_and_relatives(docs, licence_model):
    texts = {
        "SPDX-License-Identifier: MIT": "mit", "# SPDX-License-Identifier: Apache-2.0": "apache-2.0",
        "// SPDX-License-Identifier: GPL-2.0-only": "gpl", "SPDX-License-Identifier: CC-BY-NC-SA-4.0": "cc-by-nc-sa",
        "Licensed under Apache 2.0": "apache-2.0", "Released under the ISC License.": "isc",
        "This work is licensed under the GNU Affero General Public License, version 3.": "agpl",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "cc-by-nd",
        "Licensed under CC BY 4.0.": "cc-by", "Licensed under CC BY-SA 4.0.": "cc-by-sa",
        licenses.TEMPLATES["isc"][0]: "isc", licenses.TEMPLATES["bsd"][2]: "bsd",
    }
    rows = list(enumerate(texts))
    got = {r.doc_id: r.family for r in licenses.scan(docs(rows), licence_model).collect()}
    assert got == {i: texts[t] for i, t in rows}


def test_every_template_is_its_own_family(docs, licence_model):
    rows = list(enumerate(licenses.LABELLED))
    got = {r.doc_id: r.family for r in licenses.scan(docs([(i, t) for i, (_, t) in rows]), licence_model).collect()}
    names = [*licenses.FAMILIES, "unknown"]
    assert {i: (got.get(i), t) for i, (f, t) in rows if got.get(i) != names[f]} == {}
