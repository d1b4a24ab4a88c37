"""Link graph: edges, breadth-first levels, degrees, reports and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import html, urls
from quillspark.operators.ordering import number_and_count, write_in_order
from quillspark.runtime import scratch_path

# Node colours by depth.
DEPTH_COLORS = (
    "lightblue", "lightgreen", "lightyellow", "lightcoral", "lightpink", "lightgray",
    "lightsalmon", "lightseagreen", "lightsteelblue", "lightgoldenrodyellow",
)


def link_edges(pages: DataFrame, compat: bool = False) -> DataFrame:
    """Distinct internal edges (source, target, pos) between normalised URLs.

    Repeats, inside a page or between pages that normalise to one URL, are combined
    in the map task before the shuffle.
    """
    own = urls.authority_of(F.col("url"))
    targets = F.transform(
        html.links_of(F.col("html")),
        lambda x: F.struct(
            urls.url_join(F.col("url"), x["href"]).alias("to"), x["pos"].alias("pos")
        ),
    )
    links = pages.select("page_id", "url", F.explode(targets).alias("_l")).where(
        urls.is_internal(F.col("_l.to"), own, compat)
    )
    return (
        links.select(
            urls.normalize_url(F.col("url")).alias("source"),
            urls.normalize_url(F.col("_l.to")).alias("target"),
            F.col("_l.pos").cast("bigint").alias("pos"),
        )
        .groupBy("source", "target")
        .agg(F.min("pos").alias("pos"))
    )


def lookup(rows: DataFrame, table: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join rows to a table that is unique by ``on``, where one key may own many rows.

    A plain join: the optimizer sends a small table to all tasks by its size in
    bytes, and adaptive execution splits the rows of a hot key otherwise, whatever
    share of the data it holds.
    """
    return rows.join(table, on, how)


def resolve_links(edges: DataFrame, pages: DataFrame) -> DataFrame:
    """Edges whose target is one of the landed pages."""
    landed = pages.select(urls.normalize_url(F.col("url")).alias("target")).distinct()
    return lookup(edges, landed, "target", "left_semi")


def stored_edges(edges: DataFrame) -> DataFrame:
    """Edges written once to the shared folder, for all levels and lookups to read."""
    path = scratch_path(edges.sparkSession, "edges")
    edges = edges.select("source", "target", "pos")
    edges.write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path)


def bfs(
    edges: DataFrame, root: str, max_depth: int | None = None, stored: bool = False
) -> DataFrame:
    """Breadth-first tree from ``root``: (url, depth, rank, parent).

    ``rank`` is the first-in-first-out visiting order and ``parent`` the earliest
    visited page that links to the node. The search ends when a level finds nothing
    new, or after ``max_depth`` levels if the caller sets that. Each level is one
    join, one aggregate to the best parent (before the anti-join, so no target
    repeats) and one numbering pass over the new nodes. Edges (unless ``stored``
    already) and levels are written to the shared folder once, so lineage stays one
    level deep and sizes are known: a frontier that is small in bytes goes to all
    tasks and leaves the edges in place, and the hot sources of a large one are split
    by adaptive execution.
    """
    spark = edges.sparkSession
    placed = edges if stored else stored_edges(edges)
    levels = [
        spark.createDataFrame(
            [(root, 0, 1, None)], "url string, depth int, rank long, parent string"
        )
    ]
    visited_rows, depth = 1, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        frontier = levels[-1].select(
            F.col("url").alias("source"), F.col("rank").alias("parent_rank")
        )
        reached = placed.join(frontier, "source")
        # The URL is carried in the minimum, which keeps the anti-join above the aggregate.
        by = F.struct(
            "parent_rank", "pos", F.col("source").alias("parent"), F.col("target").alias("url")
        )
        best = reached.groupBy("target").agg(F.min(by).alias("_by")).select("_by.*")
        visited = levels[0].select("url")
        for level in levels[1:]:
            visited = visited.unionByName(level.select("url"))
        fresh = best.join(visited, "url", "left_anti")
        numbered, found = number_and_count(
            fresh, ["parent_rank", "pos"], "_n"
        )
        if found == 0:
            break
        numbered = numbered.select(
            "url",
            F.lit(depth).alias("depth"),
            (F.col("_n") + visited_rows).alias("rank"),
            "parent",
        )
        visited_rows += found
        path = scratch_path(spark, "level")
        numbered.write.parquet(path)
        levels.append(spark.read.schema(numbered.schema).parquet(path))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def tree_edges(nodes: DataFrame) -> DataFrame:
    """The edges recorded on first visits: every node but the root has one."""
    return nodes.where(F.col("parent").isNotNull()).select(
        F.col("parent").alias("source"), F.col("url").alias("target"), F.col("rank").alias("pos")
    )


def reached_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """All edges between visited nodes, the useful graph for link counts."""
    urls_only = nodes.select("url")
    kept = lookup(edges, urls_only.withColumnRenamed("url", "source"), "source", "left_semi")
    return lookup(kept, urls_only.withColumnRenamed("url", "target"), "target", "left_semi")


def edges_with_depth(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the depth of both ends, 0 when an end is unknown."""
    depth = nodes.select("url", "depth")
    with_source = lookup(edges, depth.toDF("source", "source_depth"), "source")
    both = lookup(with_source, depth.toDF("target", "target_depth"), "target")
    return both.select(
        "source",
        "target",
        F.coalesce("source_depth", F.lit(0)).alias("source_depth"),
        F.coalesce("target_depth", F.lit(0)).alias("target_depth"),
    )


def end_degrees(edges: DataFrame) -> DataFrame:
    """In- and out-degree of every URL that an edge names.

    Both counts come from one aggregate over edge ends, so edges are read once and
    a popular page is reduced before the shuffle.
    """
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("source").alias("url"), F.lit(0).alias("i"), F.lit(1).alias("o")),
                F.struct(F.col("target").alias("url"), F.lit(1).alias("i"), F.lit(0).alias("o")),
            )
        ).alias("_e")
    ).select("_e.*")
    return ends.groupBy("url").agg(
        F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree")
    )


def node_degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with in- and out-degree, zeros included."""
    return nodes.join(end_degrees(edges), "url", "left").select(
        *nodes.columns,
        F.coalesce("in_degree", F.lit(0)).alias("in_degree"),
        F.coalesce("out_degree", F.lit(0)).alias("out_degree"),
    )


def depth_histogram(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("depth").agg(F.count(F.lit(1)).alias("pages")).orderBy("depth")


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: pages, links, greatest depth."""
    zero = F.lit(0)
    ones = nodes.select(F.lit(1).alias("p"), zero.alias("l"), F.col("depth").alias("d"))
    ones = ones.unionByName(
        edges.select(zero.alias("p"), F.lit(1).alias("l"), zero.alias("d"))
    )
    return ones.agg(
        F.coalesce(F.sum("p"), zero).alias("pages"),
        F.coalesce(F.sum("l"), zero).alias("links"),
        F.coalesce(F.max("d"), zero).alias("max_depth"),
    )


def top_linked(degrees: DataFrame, n: int = 5, tie: str = "rank") -> DataFrame:
    """Most linked-to pages, ties in discovery order."""
    return degrees.orderBy(F.desc("in_degree"), F.asc(tie)).limit(n)


def _label(url: Column, site: str) -> Column:
    short = F.replace(url, F.lit(site)) if site else url
    label = F.replace(short, F.lit("/"), F.lit("/\\n"))
    return F.when(label == "", "/").otherwise(label)


def graph_to_dot(
    nodes: DataFrame, edges: DataFrame, name: str = "site", site: str = ""
) -> DataFrame:
    """Lines of a DOT document with their order: (section, a, b, line).

    Nodes come in visiting order, edges by the rank of their source, then target.
    """
    spark = nodes.sparkSession
    colors = F.array(*(F.lit(c) for c in DEPTH_COLORS))
    color = F.element_at(colors, F.least(F.col("depth"), F.lit(len(DEPTH_COLORS) - 1)) + 1)
    frame = spark.createDataFrame(
        [
            (0, 1, 0, f"digraph {name} {{"),
            (0, 2, 0, "  rankdir=TB;"),
            (0, 3, 0, "  node [shape=box, style=filled];"),
            (3, 0, 0, "}"),
        ],
        "section int, a long, b long, line string",
    )
    node_lines = nodes.select(
        F.lit(1).alias("section"),
        F.col("rank").alias("a"),
        F.lit(0).cast("bigint").alias("b"),
        F.format_string(
            '  "%s" [label="%s", fillcolor="%s"];', F.col("url"), _label(F.col("url"), site), color
        ).alias("line"),
    )
    rank = nodes.select("url", "rank")
    ranked = lookup(edges.select("source", "target"), rank.toDF("source", "a"), "source")
    ranked = lookup(ranked, rank.toDF("target", "b"), "target")
    edge_lines = ranked.select(
        F.lit(2).alias("section"),
        "a",
        "b",
        F.format_string('  "%s" -> "%s";', F.col("source"), F.col("target")).alias("line"),
    )
    return frame.unionByName(node_lines).unionByName(edge_lines)


def write_dot(lines: DataFrame, path: str) -> None:
    write_in_order(lines, "line", ["section", "a", "b"], path)


def write_graph_csv(df: DataFrame, path: str) -> None:
    """Edge list or node list with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)
