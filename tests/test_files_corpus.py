import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalog.text import file_normalise
from quillspark.operators import corpus, files, packing, training
from quillspark.plans import training as plans
from quillspark.sources import state
from quillspark.sources import text as text_source
from quillspark.sources import trees

LONG = "This body is long enough to enter the corpus and the training set, since it has more than a hundred characters."


def keep(spark, path, content, repo="r"):
    df = spark.createDataFrame([(repo, path, content)], "repo string, path string, content string")
    return files.extract_files(df).collect()[0]


def test_name_gates(spark):
    names = ["a.md", "LICENSE.md", "requirements.txt", "package-lock.json", "x.PNG", ".gitignore", "b.YAML", ".git/c.txt"]
    df = spark.createDataFrame([("r", n) for n in names] + [(".h", "a.md")], "repo string, path string")
    assert sorted(r.path for r in files.filter_files(df).collect()) == ["a.md", "b.YAML"]
    assert sorted(r.path for r in files.filter_files(df, compat=True).collect()) == [".git/c.txt", "a.md", "b.YAML"]


def test_length_gate(spark):
    assert keep(spark, "a.txt", " " + "x" * 49).status == "skipped"
    assert keep(spark, "a.txt", "x" * 50).status == "ok"


@pytest.mark.parametrize("text,kept", [
    ('{"lastUpdate": 1}', True), ('{"a": 1}', False), ('[{"a": 1}, {"venue": 2}]', False),
    ('[{"venue": 2}, 1]', True), ("[1]", False), ("[]", False), ("3", False), ("{bad", False),
])
def test_json_gate(text, kept):
    assert (files._json_text(text, files.RELEVANCE_KEYWORDS) is not None) == kept


def test_json_keeps_key_order_and_text():
    got = files._json_text('{"venue": "é", "a": [1]}', files.RELEVANCE_KEYWORDS)
    assert got == '{\n  "venue": "é",\n  "a": [\n    1\n  ]\n}'


def test_csv():
    rows = '{"date": "1", "venue": "2"}\n{"date": "4", "venue": "5"}'
    assert files._csv_text("date,venue\n1,2\n3\n4,5", files.RELEVANCE_KEYWORDS) == rows
    assert files._csv_text("date,venue", files.RELEVANCE_KEYWORDS) is None
    assert files._csv_text("a,b\n1,2", files.RELEVANCE_KEYWORDS) is None


def test_csv_columns_last_duplicate_wins(values):
    header, row = F.split("h", ","), F.split("r", ",")
    got = values({"h": "a,b,a", "r": '1,"2,3'}, files.csv_rows_to_json(header, row))
    assert got == ['{"a": "3", "b": "\\"2"}']
    assert values({"h": "a,b", "r": "1"}, files.csv_rows_to_json(header, row)) == [None]


def test_yaml_sorted_block_style():
    got = files._yaml_text("venue: x\nb: [1, 2]\n", files.RELEVANCE_KEYWORDS)
    assert got == "b:\n- 1\n- 2\nvenue: x\n"
    assert files._yaml_text("- 1\n- [", files.RELEVANCE_KEYWORDS) is None


def test_prose_plan_has_no_python(spark):
    df = spark.createDataFrame([("r", "a.md", LONG)], "repo string, path string, content string")
    plan = training.to_training(files.corpus_files(files.extract_files(df, structured=False)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


def test_decode(values, spark):
    df = spark.createDataFrame([(b"a\xff\r\nb\rc",), ("x\ufffdé".encode(),)], "b binary")
    assert [r[0] for r in df.select(trees.decode_text(F.col("b"))).collect()] == ["a\nb\nc", "x\ufffdé"]


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "repos"
    for path, body in {
        "r1/a.md": "# T\n[![b](x)](y)\n" + LONG, "r1/sub dir/b+c.json": '{"venue": "%s"}' % LONG,
        "r1/LICENSE.md": LONG, "r2/d.csv": f"date,n\n1,\"{LONG}\"\n2\n", "r2/e.yaml": f"song: {LONG}\n",
        "r2/f.png": "no", "r2/short.txt": "short",
    }.items():
        file = root / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(body)
    return str(root)


def test_tree_to_corpus_and_training(spark, tree):
    read = trees.read_text_files(spark, tree, suffixes=None)
    assert ("r1", "sub dir/b+c.json") in [(r.repo, r.path) for r in read.collect()]
    done = files.extract_files(read)
    stats = {r.repo: tuple(r)[1:] for r in files.extraction_stats(done).collect()}
    assert stats[None] == (2, 4, 3, 0) and stats["r1"] == (1, 2, 1, 0)
    rows = plans.files_to_training(spark, tree).collect()
    assert len(rows) == 4
    md = next(r for r in rows if r.path == "a.md")
    assert md.text == f"The following is content from a.md in the r1 repository:\n\n# T\n\n{LONG}"


def test_names_that_the_listing_leaves_out(spark, tmp_path):
    names = ["r/_config.yml", "r/.travis.yml", "r/_docs/b c.MD", "r/c.md", "r/.git/x.txt", "_r/d.md", ".h/e.md", "r/.x.png"]
    for n in names:
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text(n)
    read = trees.read_text_files(spark, str(tmp_path))
    got = sorted(f"{r.repo}/{r.path}" for r in read.collect())
    assert got == sorted(names[:-1])
    assert all(r.content == f"{r.repo}/{r.path}" for r in read.collect())
    kept = sorted(f"{r.repo}/{r.path}" for r in files.filter_files(read).collect())
    assert kept == sorted(["r/_config.yml", "r/.travis.yml", "r/_docs/b c.MD", "r/c.md", "_r/d.md"])


def test_corpus_split(values):
    text = "[r] :: [a.md]\nX\n[not] a header\n\n[r] :: [b.md]\nY\n"
    (parts,) = values({"t": text}, corpus.split_entries(F.col("t")))
    assert parts == ["[r] :: [a.md]\nX\n[not] a header\n", "[r] :: [b.md]\nY\n"]
    (head,) = values({"t": "[r] :: [a[1].md]"}, corpus.parse_header(F.col("t")))
    assert tuple(head) == ("r", "a[1")
    assert values({"t": "none"}, corpus.parse_header(F.col("t"))) == [None]


@pytest.mark.parametrize("split_bytes", ["128m", "64b"])
def test_corpus_text_reads_like_one_string(spark, tmp_path, split_bytes):
    body = "\n".join(["[x] line", LONG, "[a] :: no", "tail [b] :: [c]"])
    whole = "preamble\n\n" + "\n".join(f"[r{i}] :: [f{i}.md]\n{body} {i}\n" for i in range(9))
    (tmp_path / "one.txt").write_text(whole)
    (tmp_path / "two.txt").write_text(f"[s] :: [g.md]\n{body}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        entries = text_source.read_corpus_text(spark, str(tmp_path))
        got = sorted((r.repo, r.path, r.content) for r in corpus.parse_entries(entries.select("entry")).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [(f"r{i}", f"f{i}.md", f"{body} {i}") for i in range(9)] + [("s", "g.md", body)]
    assert got == want


def test_entries_need_two_lines_and_length(spark):
    df = spark.createDataFrame([(f"[r] :: [a]\n{LONG}\n",), ("[r] :: [b]",), ("[r] :: [c]\nshort",)], "entry string")
    assert [r.path for r in corpus.parse_entries(df).collect()] == ["a"]


BODY = "\n".join(["b1 " + "x" * 80, "URL: kept in the body", "b2 " + "y" * 80, "b3 " + "z" * 80])


@pytest.fixture
def episodes(spark):
    return spark.createDataFrame(
        [(1, "Zeta", "u1", "2020-01-01", BODY, 7), (2, None, "u2", "", BODY, None), (3, "Alpha", "u3", "", "short", 1)],
        "pos long, title string, url string, date string, transcript string, word_count long",
    )


def test_episodes_round_trip(spark, episodes, tmp_path):
    numbered = corpus.number_episodes(episodes, "pos")
    assert sorted((r.episode, r.title) for r in numbered.collect()) == [(1, ""), (2, "Alpha"), (3, "Zeta")]
    path = str(tmp_path / "t")
    text_source.write_transcripts(corpus.render_transcripts(numbered, "H", "s", "d", "2020"), path)
    document = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*")))
    assert document.startswith("=== H ===\n\nSource: s\n") and document.count(corpus.RULE) == 4
    got = plans.transcripts_to_training(spark, path, "the 'X' podcast").collect()
    assert sorted(r.title for r in got) == ["EPISODE 1:", "EPISODE 3: Zeta"]
    zeta = next(r for r in got if r.title.endswith("Zeta"))
    assert zeta.text == f"The following is from the 'X' podcast - EPISODE 3: Zeta:\n\n{BODY}"


def test_plain_form(episodes):
    got = [r.text for r in corpus.render_plain(episodes, "pos").orderBy("n").collect()]
    assert got[2] == f"=== Alpha ===\nDate: \nURL: u3\n\nshort\n\n{corpus.RULE}\n"


def test_compat_parser_loses_lines(values):
    block = F.col("b")
    text = "EPISODE 1: T\nURL: u\nDate: d\nWord Count: 3\n\nb1\nb2\nURL: x\nb3"
    fixed, compat = values({"b": text}, corpus.parse_episode_block(block), corpus.parse_episode_block(block, True))
    assert fixed.content == "b1\nb2\nURL: x\nb3" and compat.content == "b2\nb3"
    assert (fixed.title, fixed.url, fixed.word_count) == ("EPISODE 1: T", "u", 3) and compat.url == "x"


def test_totals(episodes):
    assert tuple(corpus.transcript_totals(episodes).collect()[0]) == (3, 8, "8")


def test_prompts(spark):
    df = spark.createDataFrame([("r", "p.md", "a" * 1000 + "\n\n" + "b" * 1000)], "repo string, path string, content string")
    got = [r.text for r in training.to_training(df).orderBy("part").collect()]
    assert got[0].startswith("The following is content from p.md in the r repository (part 1 of 2):\n\naaa")
    assert got[1].endswith("b" * 1000)


def test_union_is_idempotent(spark):
    base, added = spark.createDataFrame([("a",)], "text string"), spark.createDataFrame([("a",), ("b",)], "text string")
    once = training.build_training_set(base, added, existing=True)
    assert tuple(training.union_delta(once).collect()[0]) == (1, 2, 1)
    again = training.build_training_set(once.select("text"), added, existing=True)
    assert tuple(training.union_delta(again).collect()[0]) == (2, 2, 0)


def test_packing_never_overfills(spark):
    df = spark.range(3000).select("id", (F.pmod(F.xxhash64("id"), F.lit(900)) + 1).alias("n_tokens"))
    df = df.unionByName(spark.createDataFrame([(9999, 5000)], "id long, n_tokens long"))
    packed = training.pack_sequences(df, capacity=2048, per_shard=200)
    assert packed.count() == 3001
    for r in training.packing_summary(packed).collect():
        assert r.fill <= 2048 or r.n_rows == 1
        assert r.padding == max(2048 - r.fill, 0)


def fill_by_rows(lengths, capacity):
    """Best fit, longest first, row by row: the number of samples."""
    room = []
    for n in sorted((x for x in lengths if 1 <= x <= capacity), reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
        else:
            room.append(capacity - n)
    return len(room)


def test_plan_places_every_rank_once():
    rng = random.Random(3)
    for capacity in (1, 7, 50):
        for size in (0, 1, 5, 60, 400):
            lengths = [rng.choice([1, 2, 3, capacity // 2 + 1, rng.randint(0, capacity + 3)]) for _ in range(size)]
            counts = Counter(lengths)
            segments, samples = packing.plan(counts, capacity)
            used, seen = Counter(), Counter()
            for n, a, b, base, k, at in segments:
                for rank in range(a, b):
                    seen[n, rank] += 1
                    sample = base + (rank - a) // k
                    used[sample] += n
                    assert sample < samples and at + ((rank - a) % k + 1) * n <= capacity
            assert seen == Counter({(n, r): 1 for n, c in counts.items() if 1 <= n <= capacity for r in range(c)})
            assert len(used) == samples and all(v <= capacity for v in used.values())
            assert samples <= 1.1 * fill_by_rows(lengths, capacity) + 1


def test_packing_is_full_whatever_the_ids(spark):
    rng = random.Random(4)
    rows = [(f"{rng.getrandbits(64):x}", 100) for _ in range(2000)]
    fill = packing.sample_fill(packing.pack_by_length(spark.createDataFrame(rows, "id string, n_tokens int")))
    assert fill.count() == 100  # twenty rows of a hundred tokens each
    rows += [(str(i), rng.randint(1, 2048)) for i in range(1500)] + [("long", 9000), ("long", 9000), ("empty", 0), (None, None), (None, 5)]
    table = spark.createDataFrame(rows, "id string, n_tokens int").selectExpr("*", "1 AS sample", "2 AS n", "3 AS kind", "4 AS rank", "5 AS base")
    got = packing.pack_by_length(table).collect()
    assert Counter((r.id, r.n_tokens) for r in got) == Counter(rows)
    samples = {}
    for r in got:
        assert (r.sample is None) == (not r.n_tokens)
        if r.sample is not None:
            samples.setdefault(r.sample, []).append((r.start, r.n_tokens))
    assert sorted(samples) == list(range(len(samples)))
    packed = 0
    for rows_ in samples.values():
        at = 0
        for start, n in sorted(rows_):
            assert start == at
            at += n
        assert at <= 2048 or len(rows_) == 1
        packed += at if at <= 2048 else 0
    assert packed >= 0.97 * 2048 * (len(samples) - 2)
    assert packing.pack_by_length(table.limit(0)).count() == 0


def test_open_ranges(spark):
    pages = spark.createDataFrame([(p,) for p in (3, 4, 4, 9, 10, 20, 99, None, -5, 0)], "page int")
    for block in (1, 2, 5, 1 << 16):
        got = sorted(map(tuple, state.open_ranges(pages, 21, block=block).collect()))
        assert got == [(1, 2), (5, 8), (11, 19), (21, 21)]
    assert state.open_ranges(pages.limit(0), 4).collect() == [(1, 4)]
    assert state.open_ranges(pages.limit(0), 0).collect() == []


def test_structured_files_are_parsed_by_every_core(spark, tmp_path):
    rows = [(k, f"name {k}", "BUILDING" if k % 5 == 0 else "FURNITURE") for k in range(30)] + [(None, None, None), (1, "again", "X")]
    customers = spark.createDataFrame(rows, "c_custkey long, c_name string, c_mktsegment string").coalesce(1)
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    found = file_normalise(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert found.count() == 32
    assert found.where("path LIKE '%.yaml' AND status = 'ok'").count() == 8
