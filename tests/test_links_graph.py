import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from quillspark.operators import graph, links, ordering


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture
def pages(spark):
    html = """<a href="/e/1">First one</a><a href="/e/1">Second one</a><a href="/e/2">Short</a>
      <a href="/e/3">Sixsix</a><a href="/m">Read more</a><a href="mailto:u@h">mail us</a>
      <a href="/f/a.PDF?x=1">paper</a><a href="i.jpeg">image</a><a href="https://o/z">other site</a>
      <a href="/t">see [Full Transcript] here</a>"""
    return spark.createDataFrame([(1, "https://h/p/q?x#y", html)], "page_id long, url string, html string")


def test_episode_links_keep_the_first_title(pages):
    got = rows(links.episode_links(pages, "/e/"), "url", "title")
    assert got == [("https://h/e/1", "First one"), ("https://h/e/3", "Sixsix")]


def test_links_of_a_page_are_distinct_without_a_shuffle(spark, pages):
    got = rows(links.item_links(pages, r"^/e/"), "pos", "url", "text")
    assert got == [(0, "https://h/e/1", "First one"), (2, "https://h/e/2", "Short"), (3, "https://h/e/3", "Sixsix")]
    assert got == rows(links.distinct_links(links.extract_links(pages, pattern=r"^/e/")), "pos", "url", "text")
    for found in (links.item_links(pages), links.link_candidates(pages, href_contains=["/"])):
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    empty = spark.createDataFrame([(2, "https://h/", None), (3, None, "<a href='/e/1'>Long title</a>")], pages.schema)
    assert rows(links.item_links(empty, "^/e/"), "page_id") == [(3,)]
    # Many links to few targets: sorted once, not compared in pairs.
    html = "".join(f'<a href="/e/{i % 7}">number {i}</a>' for i in range(20_000))
    many = spark.createDataFrame([(4, "https://h/", html)], pages.schema)
    assert rows(links.item_links(many, "^/e/"), "pos") == [(i,) for i in range(7)]


def test_candidates_gate_titles_and_prefer_earlier_selectors(pages):
    got = rows(links.link_candidates(pages, href_contains=["/e/3", "/"]), "sel", "url")
    assert (0, "https://h/e/3") in got and all(u != "https://h/m" for _, u in got)
    tree = rows(links.link_candidates(pages, selectors=['a[href*="/e/"]']), "sel", "url", "title")
    assert tree == [(0, "https://h/e/1", "First one"), (0, "https://h/e/3", "Sixsix")]


def test_bracket_links(pages):
    got = rows(links.bracket_links(pages), "url", "title")
    assert got == [("https://h/t", "Transcript: Full Transcript")]


def test_attachments(pages):
    got = rows(links.extract_attachments(pages), "url", "filename", "extension", "type")
    assert got == [
        ("https://h/f/a.PDF?x=1", "a.PDF", ".pdf", "document"),
        ("https://h/p/i.jpeg", "i.jpeg", ".jpeg", "image"),
    ]


def test_edges_stay_inside_the_site(pages):
    targets = {t for (t,) in rows(graph.link_edges(pages), "target")}
    assert "https://h/e/1" in targets and "mailto://u@h" not in targets and "https://o/z" not in targets
    assert "mailto://u@h" in {t for (t,) in rows(graph.link_edges(pages, compat=True), "target")}


def python_bfs(edges, root, limit):
    out, seen, queue = [], set(), deque([(root, 0, None)])
    while queue:
        url, depth, parent = queue.popleft()
        if url in seen or depth > limit:
            continue
        seen.add(url)
        out.append((url, depth, len(out) + 1, parent))
        if depth < limit:
            queue.extend((t, depth + 1, url) for _, t in sorted(edges.get(url, [])) if t not in seen)
    return out


@pytest.mark.parametrize("depth", [4, None])
def test_bfs_equals_a_queue(spark, depth):
    rng = random.Random(3)
    table = {}
    for i in range(60):
        targets = rng.sample(range(60), rng.randint(0, 3))
        table[f"n{i}"] = [(p, f"n{t}") for p, t in enumerate(targets)]
    table["n0"] = [(0, "n1"), (1, "n0"), (2, "n2")]
    edges = spark.createDataFrame(
        [(s, t, p) for s, ts in table.items() for p, t in ts], "source string, target string, pos long"
    )
    nodes = graph.bfs(edges, "n0", depth)
    want = python_bfs(table, "n0", 1000 if depth is None else depth)
    assert rows(nodes, "url", "depth", "rank", "parent") == sorted(want, key=lambda r: r[0])
    assert graph.tree_edges(nodes).count() == len(want) - 1


def test_small_frontiers_leave_the_edges_in_place(spark):
    edges = graph.stored_edges(spark.range(100).select(
        F.lit("hot").alias("source"), F.col("id").cast("string").alias("target"), F.col("id").alias("pos")
    ))
    nodes = graph.bfs(edges, "hot", stored=True)
    assert nodes.count() == 101
    frontier = nodes.select(F.col("url").alias("source"))
    plan = edges.join(frontier, "source")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_bfs_without_links(spark):
    edges = spark.createDataFrame([], "source string, target string, pos long")
    assert rows(graph.bfs(edges, "r"), "url", "depth", "rank") == [("r", 0, 1)]


@pytest.fixture
def small_graph(spark):
    nodes = spark.createDataFrame(
        [("https://s", 0, 1, None), ("https://s/", 1, 2, "https://s"), ("https://s/about", 1, 3, "https://s")],
        "url string, depth int, rank long, parent string",
    )
    return nodes, graph.tree_edges(nodes)


def test_reports(small_graph):
    nodes, edges = small_graph
    degrees = graph.node_degrees(nodes, edges)
    assert rows(degrees, "url", "in_degree", "out_degree") == [
        ("https://s", 0, 2), ("https://s/", 1, 0), ("https://s/about", 1, 0)
    ]
    assert [tuple(r) for r in graph.depth_histogram(nodes).collect()] == [(0, 1), (1, 2)]
    assert [tuple(r) for r in graph.graph_summary(nodes, edges).collect()] == [(3, 2, 1)]
    top = graph.top_linked(degrees, 2)
    assert [r.url for r in top.collect()] == ["https://s/", "https://s/about"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_unknown_ends_have_depth_zero(spark, small_graph):
    edges = spark.createDataFrame([("https://s/about", "gone")], "source string, target string")
    assert rows(graph.edges_with_depth(edges, small_graph[0]), "source_depth", "target_depth") == [(1, 0)]


def test_exports(spark, small_graph, tmp_path):
    nodes, edges = small_graph
    graph.write_dot(graph.graph_to_dot(nodes, edges, "site", "https://s"), str(tmp_path / "dot"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "dot").glob("part-*")))
    assert text.splitlines() == [
        "digraph site {", "  rankdir=TB;", "  node [shape=box, style=filled];",
        '  "https://s" [label="/", fillcolor="lightblue"];',
        '  "https://s/" [label="/\\n", fillcolor="lightgreen"];',
        '  "https://s/about" [label="/\\nabout", fillcolor="lightgreen"];',
        '  "https://s" -> "https://s/";', '  "https://s" -> "https://s/about";', "}",
    ]
    graph.write_graph_csv(graph.edges_with_depth(edges, nodes), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["source", "target", "source_depth", "target_depth"] and back.count() == 2


def test_numbers_are_dense_with_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"), "id"
    )
    got = ordering.number_rows(df, ["k", "id"], "n").collect()
    want = {k: n for n, k in enumerate(sorted((r.k, r.id) for r in got), 1)}
    assert all(want[(r.k, r.id)] == r.n for r in got)


def test_running_max_over_blocks(spark):
    rng = random.Random(2)
    data = [(g, i, rng.choice([None, rng.randint(0, 99)])) for g in "ab" for i in range(200)]
    df = spark.createDataFrame(data, "g string, i long, v long")
    got = {(r.g, r.i): r.m for r in ordering.running_max(df, F.col("v"), "i", ["g"], "m", 16).collect()}
    best = {}
    for g, i, v in data:
        best[g] = max((x for x in (best.get(g), v) if x is not None), default=None)
        assert got[(g, i)] == best[g]


def test_numbers_of_narrow_rows_come_back_to_the_texts(spark):
    data = [(None if i == 3 else i, "t" if i % 2 else None, "x" * 50) for i in range(40)]
    df = spark.createDataFrame(data, "id int, title string, body string").repartition(5)
    got = {r.id: (r.n, r.body) for r in ordering.number_by(df, ["title"], "id").collect()}
    want = sorted(data, key=lambda r: (r[1] is not None, r[1] or "", r[0] is not None, r[0] or 0))
    assert got == {r[0]: (k, r[2]) for k, r in enumerate(want, 1)}
