import random

import numpy as np
import re

import pytest

from quillspark.llm import decontaminate, line_dedup, quality, simhash, toxicity

SPACES = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- line dedup ---------------------------------------------------------------

def brute_lines(texts, min_docs, min_chars=1):
    key = lambda x: x.strip(SPACES).translate(LOW)
    seen = {}
    for t in texts:
        for k in {key(x) for x in (t or "").split("\n")}:
            seen[k] = seen.get(k, 0) + 1
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and seen[key(x)] >= min_docs)]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_line_dedup_matches_brute_force(spark, docs):
    rng = random.Random(5)
    pool = ["A", " a\t", "b", "", "  ", "Ä", "ä", "\x0bc\x0c", "c", "long line", "Long Line "] + [f"x{i}" for i in range(30)]
    texts = [None, "", "\n", "a\n" * 400 + "tail"] + ["\n".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(80)]
    rows = [(None if i == 7 else i % 60, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    table = docs(rows).selectExpr("*", "1 AS h1", "'x' AS n_lines", "'y' AS pos", "3 AS __x", "'lang' AS docs")
    for min_docs, min_chars in ((4, 1), (2, 2)):
        got = line_dedup.dedup_lines(table, min_docs=min_docs, min_chars=min_chars, batches=5)
        assert {"h1", "pos", "__x", "docs"} <= set(got.columns)
        want = [(i, *w) for (i, _), w in zip(rows, brute_lines([t for _, t in rows], min_docs, min_chars))]
        rows_got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]
        assert sorted(rows_got, key=str) == sorted(want, key=str)


def test_line_dedup_of_nothing(docs):
    assert line_dedup.dedup_lines(docs([(1, "a")]).filter("false")).count() == 0


def test_runs_compact_and_leave_no_table(spark):
    runs = line_dedup.LineRuns(spark, min_docs=3, fanout=2, buckets=2)
    batch = spark.createDataFrame([(1, 1, 1), (2, 2, 1)], "h1 long, h2 long, docs long")
    for _ in range(5):
        runs.add(batch.filter("h1 = 1") if _ else batch)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert [tuple(r) for r in runs.frequent_keys().distinct().collect()] == [(1, 1)]
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


# --- SimHash ------------------------------------------------------------------

def brute_components(prints, radius=4):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprint_bits():
    import xxhash

    text = "The  CAT\tsat on\nthe MAT Ä"
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOW))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(len(words) - 3)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("a  B") == xxhash.xxh64_intdigest(b"a b", 42)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_components_of_fingerprints(spark):
    rng = random.Random(9)
    prints = set()
    for _ in range(12):  # clouds around centres, some of them chains
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 60])):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 4, 5])))
            prints.add(at)
    prints = sorted(prints)
    fps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    found = {r.fp % (1 << 64): r.root for r in simhash.fingerprint_components(fps).collect()}
    want = brute_components(prints)
    groups = {}
    for p, root in zip(prints, want):
        groups.setdefault(root, set()).add(p)
    got = {}
    for p in prints:
        got.setdefault(found.get(p, p - (1 << 64) if p >> 63 else p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_near_duplicates_odd_rows(docs):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(5, base), (3, base), (3, base), (None, base), (8, base.replace("word150 ", "WORD150  ")), (1, None), (2, ""), (4, " "),
            (9, "alone here"), (None, "nobody knows this text at all")]
    table = docs(rows).selectExpr("*", "'x' AS root", "1 AS fp", "2 AS th")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(table).collect()}
    of = {i: c for (i, _), c in got.items() if i is not None}
    assert of[5] == of[3] == of[8] == 3 and of[1] == of[2] == of[4] == 1 and of[9] == 9
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, base), (1, None), (9, "alone here"), (None, "nobody knows this text at all")], key=str)
    assert simhash.near_duplicates(table.filter("false")).count() == 0


# --- decontamination ----------------------------------------------------------

def edit_distance_inside(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        before, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return min(row)


def test_matches_are_those_of_brute_force():
    rng = random.Random(2)
    letters = "abcd "
    for _ in range(150):
        items = ["".join(rng.choices(letters, k=rng.randint(12, 40))) for _ in range(4)]
        text = "".join(rng.choices(letters, k=60))
        for item in items[:2]:
            copy = list(item)
            for _ in range(rng.randint(0, 5)):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], ["z"], [copy[at], "q"]])
            text += " " + "".join(copy) + " "
        matcher = decontaminate.Matcher(list(enumerate(items)), 0.12, 10)
        got = {i: d for i, d, _, _ in matcher.matches(text)}
        want = {}
        for i, item in enumerate(items):
            item = decontaminate.normal(item)
            d = edit_distance_inside(item, decontaminate.normal(text))
            if len(item) >= 10 and d <= int(len(item) * 0.12):
                want[i] = d
        assert got.keys() == want.keys()
        assert all(got[i] <= int(len(items[i]) * 0.12) for i in got)


def test_find_and_drop_leaks(spark, docs):
    item = "The quick brown fox jumps over the lazy dog near the river bank"
    items = spark.createDataFrame(
        [(1, item), (None, item.upper()), (2, ""), (3, None), (4, "short"), (5, "Nothing in any document looks like this")],
        "item_id long, text string")
    rows = [(1, "x " + item.replace("brown", "brwn") + " y"), (None, item), (2, "short short"), (3, None), (4, ""),
            (5, "a " * 50_000 + item + " b" * 50_000), (5, "clean text that is not in the set")]
    table = docs(rows).selectExpr("*", "7 AS distance", "'i' AS item_id")
    got = decontaminate.find_leaks(table, items, block_bytes=70)
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in got.collect()), key=str) == sorted(
        [(d, i, 1 if d == 1 else 0) for d in (1, None, 5) for i in (1, None)] + [(2, 4, 0)], key=str)
    kept = decontaminate.drop_leaks(table, items)
    assert kept.columns == table.columns
    assert sorted(r.text or "" for r in kept.collect()) == ["", "", "clean text that is not in the set"]
    for a, b in ((table, items.filter("false")), (table.filter("false"), items)):
        assert decontaminate.find_leaks(a, b).count() == 0
        assert decontaminate.drop_leaks(a, b).count() == a.count()


# --- toxicity -----------------------------------------------------------------

@pytest.fixture(scope="module")
def machine():
    return toxicity.grammar()


def test_clauses_are_typed(machine):
    lexicon = toxicity.Lexicon({w: 1.0 for w in toxicity.INSULTS}, {"grob": 0.9})
    kinds = lambda t: [k for k, _ in toxicity.matches(t, lexicon, machine)]
    assert kinds("what an idiot") == ["insult"]
    assert kinds("you are an idiot") == ["targeted"]
    assert kinds("He is not an idiot.") == ["negated"]
    assert kinds("she said: idiot") == ["reported"]
    assert kinds("I will hurt it. I like you. you: I will hurt you") == ["threat"]
    assert kinds("not now. an idiot") == ["insult"]
    assert kinds("an idiot is what you are") == ["targeted"]
    assert kinds("I hurt you. hurt it") == ["threat"] and kinds("idiot. you") == ["insult"]
    assert kinds("der grobian grobheit gro") == ["insult", "insult"]
    assert kinds("") == [] and kinds("you they not said") == []


def typed_by_hand(symbols):
    """What stands within reach of every insult and threat in its clause, looked up one by one."""
    out = []
    for i, s in enumerate(symbols):
        if s not in (toxicity.INSULT, toxicity.THREAT):
            continue

        def near(kind, step):
            for j in range(i + step, i + step * (toxicity.REACH + 1), step):
                if not 0 <= j < len(symbols) or symbols[j] == toxicity.BREAK:
                    return False
                if symbols[j] == kind:
                    return True
            return False

        target = near(toxicity.TARGET, -1) or near(toxicity.TARGET, 1)
        if s == toxicity.THREAT and not target:
            continue
        if near(toxicity.REPORT, -1):
            out.append("reported")
        elif near(toxicity.NEGATION, -1):
            out.append("negated")
        else:
            out.append("threat" if s == toxicity.THREAT else "targeted" if target else "insult")
    return out


def test_composed_grammar_equals_looking_around(machine):
    rng = random.Random(11)
    words = {toxicity.INSULT: "idiot", toxicity.THREAT: "hurt", toxicity.TARGET: "you", toxicity.NEGATION: "not",
             toxicity.REPORT: "said", toxicity.BREAK: ".", toxicity.OTHER: "tree"}
    lexicon = toxicity.Lexicon({"idiot": 1.0}, {})
    for _ in range(3000):
        symbols = rng.choices(range(7), weights=[3, 2, 2, 2, 1, 1, 9], k=rng.randint(0, 40))
        got = toxicity.matches(" ".join(words[s] for s in symbols), lexicon, machine)
        assert [k for k, _ in got] == typed_by_hand(symbols)


def test_composition_runs_one_transducer_after_the_other():
    rng = random.Random(12)
    one, two = toxicity.marking(toxicity.NEGATION, toxicity.NEGATED), toxicity.marking(toxicity.REPORT, toxicity.REPORTED, 2)
    both = toxicity.compose(one, two)
    for _ in range(200):
        tape = rng.choices(toxicity.TAPE, k=30)
        assert both.run(tape) == two.run(one.run(tape))


def test_learned_words_and_scores(spark, docs):
    rng = random.Random(4)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(300):
        text = rng.choices(words, k=40)
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                text.insert(rng.randrange(40), "grumpf" + rng.choice(["ig", "en", "er", "isch"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(900 + i, "copy of one toxic text with rareword inside") for i in range(40)]
    labels += [(900 + i, 1) for i in range(40)]
    table = docs(rows).selectExpr("*", "'x' AS score", "1 AS label")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(table, marks)
    assert any("grumpf".startswith(s) or s.startswith("grumpf") for s in [*model["stems"], *model["insults"]])
    assert "rareword" not in model["insults"]
    odd = docs([(None, None), (7, ""), (7, ""), (8, "grumpfig " * 30_000), (9, "wab wcd")])
    got = {(r.doc_id, r.predicted) for r in toxicity.score_texts(odd, model).collect()}
    assert got == {(None, 0), (7, 0), (8, 1), (9, 0)}
    assert toxicity.score_texts(odd.filter("false"), model).count() == 0
    assert [r.doc_id for r in toxicity.drop_toxic(odd, model).orderBy("doc_id").collect()] == [None, 7, 7, 9]
    bare = toxicity.train(table.filter("false"), marks.filter("false"))
    assert toxicity.score_texts(docs(["you idiot"]), bare).first().predicted == 1


# --- quality ------------------------------------------------------------------

def brute_repeats(words):
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    return len(hit)


def test_statistics_match_brute_force():
    rng = random.Random(6)
    for n in (0, 1, 8, 9, 40, 400):
        for pool in (2, 5, 1000):
            words = [f"w{rng.randrange(pool)}" for _ in range(n)]
            assert quality.repeat_words([w.encode() for w in words]) == brute_repeats(words)
    got = quality.text_statistics("a b\na b\n \n \n#c\xa0d|\n#c\xa0d|\nA b")
    assert got[:5] == (8, 16, 4, 2, 0)
    assert quality.text_statistics(None)[:5] == (0, 0, 0, 0, 0)


def test_chi_square():
    assert abs(quality.chi2_cdf(15.507, 8) - 0.95) < 1e-4
    assert abs(quality.chi2_quantile(0.975, 8) - 17.535) < 1e-2


def test_outliers_are_rejected(spark):
    rng = random.Random(8)
    plain = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 7))) for _ in range(n)) + "."
    rows = [(i, plain(rng.randint(30, 80)), rng.choice(["en", None]), rng.choice(["s1", "s2", None])) for i in range(300)]
    junk = " ".join("".join(rng.choices("#$%&*|", k=5)) for _ in range(60))
    rows += [(900, junk, "en", "s1"), (901, None, "en", "s1"), (902, "", None, None), (903, plain(5), "xx", "rare"),
             (904, plain(50), "xx", "rare"), (None, plain(50), "en", "s1"), (905, "same words " * 100, "en", "s2"),
             (906, plain(60_000), "en", "s1")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "1 AS grp", "'n' AS n_words", "2 AS kept")
    got = {r.doc_id: r for r in quality.quality(table).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(300))
    assert not any(got[i].kept for i in (900, 901, 902, 903, 905)) and not got[900].base_failed
    assert got[904].kept and got[None].kept
    assert got[901].n_words == 0 and got[901].distance is None and got[905].base_failed
    assert quality.quality(table.filter("false")).count() == 0


def test_spread_of_the_data_sets_the_distance(spark):
    """Two statistics that go together: breaking the bond is far off, though each value alone is ordinary."""
    rng = random.Random(9)
    rows = []
    for i in range(400):
        t = rng.uniform(-1, 1)
        x = {"upper": 0.2 + 0.02 * t + rng.gauss(0, 0.002), "word_length": 0.1 + 0.03 * t + rng.gauss(0, 0.003)}
        rows.append(("g", "p", *[x.get(n, 0.0) for n in quality.NAMES]))
    table = spark.createDataFrame(rows, ", ".join(["grp string, parent string"] + [f"x_{n} double" for n in quality.NAMES]))
    fit = quality.estimate(table).first()
    inverse = dict(zip(quality.PAIRS, fit.inverse))
    off = [0.0] * len(quality.NAMES)
    off[quality.NAMES.index("upper")], off[quality.NAMES.index("word_length")] = 0.02, -0.03
    d2 = sum(off[i] * off[j] * v * (1 if i == j else 2) for (i, j), v in inverse.items())
    assert d2 > quality.chi2_quantile(1 - 1e-4, len(quality.NAMES))
    digits = quality.NAMES.index("digits")
    assert abs(inverse[digits, digits] - 1 / quality.FEATURES["digits"] ** 2) < 1e-6


def plain_mcd(groups, share, steps, prior):
    """Distances of the rows of each group by plain loops; groups: {(parent, name): rows}."""
    spread = np.array(list(quality.FEATURES.values())) ** 2
    factor = quality.consistency(share, len(spread))
    rank = lambda v, q: sorted(v)[max(0, int(np.ceil(q * len(v))) - 1)]

    def level(rows):
        s = np.cov(rows.T, bias=True) * factor
        none = np.diag(s) < quality.NO_SPREAD * spread
        s[none, :] = s[:, none] = 0
        s[none, none] = spread[none]
        return len(rows), rows.mean(0), s

    def draw(own, parent):
        w = own[0] / (own[0] + prior)
        return w * own[1] + (1 - w) * parent[0], w * own[2] + (1 - w) * parent[1]

    def fit(chosen):
        top = level(np.concatenate(list(chosen.values())))
        whole = draw(top, (top[1], np.diag(spread)))
        return {g: draw(level(x), draw(level(np.concatenate([v for k, v in chosen.items() if k[0] == g[0]])), whole))
                for g, x in chosen.items()}

    def apart(x, f):
        return np.einsum("ij,jk,ik->i", x - f[0], np.linalg.inv(f[1]), x - f[0])

    first = {}
    for g, x in groups.items():
        centre = np.array([rank(c, 0.5) for c in x.T])
        var = (1.4826 * np.array([rank(c, 0.5) for c in abs(x - centre).T])) ** 2
        first[g] = centre, np.diag(np.where(var < quality.NO_SPREAD * spread, spread, var))
    halves = {g: x[apart(x, first[g]) <= rank(apart(x, first[g]), 0.5)] for g, x in groups.items()}
    best = {}
    for f in (first, fit(groups), fit(halves)):
        for _ in range(steps):
            f = fit({g: x[apart(x, f[g]) <= rank(apart(x, f[g]), share)] for g, x in groups.items()})
        for g in groups:
            det = np.linalg.slogdet(f[g][1])[1]
            if g not in best or det < best[g][0] - 1e-9:
                best[g] = det, apart(groups[g], f[g])
    return {g: b[1] for g, b in best.items()}


def test_fits_of_groups_of_any_size_equal_plain_loops(spark):
    rng = np.random.default_rng(4)
    k = len(quality.NAMES)
    mix = rng.normal(0, 0.05, (k, k))
    groups = {}
    for n in (*range(1, 61, 3), 39, 40, 41, 300):
        x = rng.normal(0, 1, (n, k)) @ mix + 0.3
        x[:, 6] = 0.0  # one statistic never differs
        x[: n // 8] += 3.0
        groups[f"p{n % 3}", f"g{n}"] = x
    rows = [(g, p, i, *map(float, v)) for (p, g), x in groups.items() for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, ", ".join(["grp string, parent string, i int"] + [f"x_{n} double" for n in quality.NAMES]))
    got = table.join(quality.estimate(table), "grp").select("parent", "grp", "i", quality._distance().alias("d2")).collect()
    want = plain_mcd(groups, 0.75, 4, 40)
    assert len(got) == len(rows)
    cut = quality.chi2_quantile(1 - 1e-4, k)
    for r in got:
        d2 = want[r.parent, r.grp][r.i]
        assert r.d2 >= 0 and abs(r.d2 - d2) < 1e-4 * (1 + d2)
        n = len(groups[r.parent, r.grp])
        assert (r.d2 <= cut) == (r.i >= n // 8)  # planted rows go, all others stay


def test_verdicts_of_small_groups(spark):
    """From one row to sixty, plain texts stay and a text of symbols goes."""
    rng = random.Random(12)
    plain = lambda: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 7))) for _ in range(60)) + "."
    rows = [(1000 * n + i, plain(), f"l{n}", "s") for n in (1, 2, 3, 5, 8, 12, 39, 40, 60) for i in range(n)]
    rows += [(7, " ".join("#$%&*" for _ in range(60)) + " " + plain(), "l3", "s")]
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [i for i, r in got.items() if not r.kept] == [7]
    assert all(r.distance >= 0 for r in got.values())


# --- short items, several labels ----------------------------------------------

def test_short_items_are_found_as_whole_words(spark, docs):
    items = spark.createDataFrame([(1, "Capital of  France?"), (2, "cat"), (3, " "), (4, None)], "item_id long, text string")
    table = docs(["what is the capital of\nfrance? it is", "concatenate", "a CAT.", "capital of francs?", None, "cat", "caté"])
    got = decontaminate.find_leaks(table, items).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got) == [(0, 1, 0), (2, 2, 0), (5, 2, 0)]
    assert [r.doc_id for r in decontaminate.drop_leaks(table, items).collect()] == [1, 3, 4, 6]


def test_the_largest_of_several_labels_counts(spark, docs):
    labels = spark.createDataFrame([(0, 0), (0, 1), (0, None), (1, 0), (1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(docs(["a", "b", "c"]), labels, "doc_id", "text", 100)
    assert sorted((r.id, r.label) for r in got.collect()) == [(0, 1), (1, 0)]
