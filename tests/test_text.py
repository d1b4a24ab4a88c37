import random

from pyspark.sql import functions as F

from quillspark.functions import text as T

C = F.col("t")


def test_white_space_set_is_pythons():
    assert T.WHITE_SPACE == "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def test_strip_and_collapse(values):
    s = "\u00a0\u2003 a \x1c\tb\u3000\n"
    assert values({"t": s}, T.strip(C), T.collapse_ws(C)) == [s.strip(), " ".join(s.split())]


def test_clean_text(values):
    cases = {
        "a\n\n\n\nb": "a\n\nb", "a \t b": "a b", "  \n ": "", "a\n \n\t\n\nb": "a\n\nb",
        "a\u00a0b": "a\u00a0b",
    }
    for raw, want in cases.items():
        assert values({"t": raw}, T.clean_text(C)) == [want]


def test_clean_markdown_drops_badges_and_comments(values):
    badge = "# T\n[![x](y)](z)\ntext"
    assert values({"t": badge}, T.clean_text(C, True)) == ["# T\n\ntext"]
    comment = "a<!-- x\ny -->b"
    assert values({"t": comment}, T.clean_text(C, True), T.clean_text(C)) == ["ab", comment]


def test_comment_removal_leaves_blank_runs(values):
    # Blank lines are collapsed before comments go, so a new run may remain.
    assert values({"t": "a\n\n<!-- x -->\n\nb"}, T.clean_text(C, True)) == ["a\n\n\n\nb"]


def test_markdown_choice_by_column(spark):
    df = spark.createDataFrame([("x<!-- c -->", True), ("x<!-- c -->", False)], "t string, md boolean")
    got = [r[0] for r in df.select(T.clean_text(C, F.col("md"))).collect()]
    assert got == ["x", "x<!-- c -->"]


def test_chunk_golden(values):
    cases = {
        "aaaa\n\nbbbb": ["aaaa\n\nbbbb"], "aaaa\n\nbbbbb": ["aaaa", "bbbbb"],
        "a" * 12: ["a" * 12], "aa\n\nbbbbbbbbbbbb\n\nc": ["aa", "bbbbbbbbbbbb", "c"], " \n\n ": [],
    }
    for raw, want in cases.items():
        assert values({"t": raw}, T.chunk_text(C, 10)) == [want]


def test_chunks_lose_nothing_and_respect_the_limit(spark):
    rng = random.Random(5)
    words = ["a", "bb", "\n\n", "\n", " ", "é", "cccccc", "\n\n\n"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, chunks in df.select("t", T.chunk_text(C, 12)).collect():
        assert all(chunks)
        assert "".join("".join(chunks).split()) == "".join(t.split())
        assert all(len(c) <= 12 for c in chunks if "\n\n" in c)


def test_chunks_are_filled_greedily(spark):
    rng = random.Random(6)
    texts = ["\n\n".join("x" * rng.randint(1, 9) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, chunks in df.select("t", T.chunk_text(C, 12)).collect():
        assert "\n\n".join(chunks) == t
        for here, following in zip(chunks, chunks[1:]):
            assert len(here) + 2 + len(following.split("\n\n")[0]) > 12


def test_keyword_scope(values):
    assert values({"t": "xx lastUpdate"}, T.keyword_relevant(C), T.keyword_relevant(C, first_chars=5)) == [True, False]


def test_small_parsers(values):
    assert values({"t": "26–50 of 37,279 results"}, T.result_total(C), T.page_count(C)) == [37279, 1492]
    assert values({"t": "nothing"}, T.page_count(C)) == [None]
    title = "Band Live at Some Hall on 1992-06-17"
    assert values({"t": title}, T.first_date(C), T.venue_of(C)) == ["1992-06-17", "Some Hall"]
    assert values({"t": "none"}, T.first_date(C), T.venue_of(C)) == [None, None]
    assert values({"t": "a  b\n c\u00a0d "}, T.word_count(C)) == [4]
    assert values({"t": "o/r"}, T.safe_name(C)) == ["o_r"]


def test_ratio_is_guarded(values):
    n = F.lit(3), F.lit(4), F.lit(0)
    assert values({"t": ""}, T.ratio_text(n[0], n[1]), T.ratio_text(n[2], n[2])) == ["3/4 (75.0%)", "0/0 (0%)"]


def test_expressions_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("a",)], "t string").select(T.chunk_text(T.clean_text(C, True)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
