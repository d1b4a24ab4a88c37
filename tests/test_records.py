import json

import pytest
from pyspark.sql import functions as F

from quillspark.operators import firstwins, records
from quillspark.plans import items


def page(spark, html, url="https://h/items/show/1"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def item(spark, html, **options):
    return records.extract_item(page(spark, html), **options).collect()[0]


LD = '<script type="application/ld+json">{}</script>'


def test_item_from_title(spark):
    got = item(spark, "<h1>Band Live at Some Hall on 1992-06-17 · Site</h1><p>by The Band</p>",
               creator_phrase="The Band", title_suffix="· Site")
    assert (got.title, got.date, got.creator) == ("Band Live at Some Hall on 1992-06-17", "1992-06-17", "The Band")
    assert got.tags == ["Venue: Some Hall"] and got.subjects == [] and got.attachments == []
    assert got.description == "" and got.type == ""


def test_item_precedence(spark):
    ld = LD.format('{"name": "B", "dateCreated": "2001", "datePublished": "2002", "keywords": "k"}')
    got = item(spark, f"<h1>A</h1>{ld}")
    assert (got.title, got.date, got.tags) == ("B", "2002", ["k"])
    got = item(spark, f"<h1>A</h1>{ld}<dl><dt>Date</dt><dd>2003</dd><dt>Subject</dt><dd>x</dd></dl>")
    assert (got.date, got.tags, got.subjects) == ("2003", ["k", "x"], [])
    got = item(spark, '<h1>A 1990-01-01</h1><div class="x-metadata"><p>on 1991-02-03</p></div>')
    assert got.date == "1991-02-03"


def test_transcripts(spark):
    body = "word " * 60
    got = records.extract_transcript(
        page(spark, f'<h1>T</h1><div class="field-content">short</div><article>{body}</article><time>2020</time>'),
        scraped_at="s",
    ).collect()[0]
    assert (got.title, got.date, got.word_count, got.scraped_at) == ("T", "2020", 60, "s")
    assert records.extract_transcript(page(spark, "<article>short</article>")).count() == 0


def test_transcript_blocks_fall_back_to_main_content(spark):
    got = records.extract_transcript_blocks(
        page(spark, '<title>x</title><div class="transcript"></div><div class="content">main</div>'), "s"
    ).collect()[0]
    assert (got.title, got.transcript, got.date) == ("x", "main", "")


@pytest.fixture
def recording(spark):
    def run(doc, old=False, **options):
        df = spark.createDataFrame([("i", json.dumps(doc))], "identifier string, j string").select(
            "identifier", F.parse_json("j").alias("metadata")
        )
        return (records.extract_recording_old if old else records.extract_recording)(df, **options).collect()[0]

    return run


def test_recordings(recording):
    assert recording({"date": "", "year": 1977}).date == "1977"
    got = recording({"coverage": "X"})
    assert (got.date, got.venue) == ("X", "X")
    assert recording({"notes": ["a", "b"], "lineage": "<b>c</b>"}).setlist == "a b c"
    assert recording({"description": ["<p>a", "b</p>"]}).description == "a b"
    assert recording({"subject": "s"}).subject == ["s"]
    assert recording({"subject": 7}).subject == []
    assert recording({"subject": ["s", 7]}).subject == ["s", "7"]
    assert recording({}).creator == ""


def test_old_recordings(recording):
    got = recording({"tracklist": ["a", "<i>b</i>"], "lineage": "c", "downloads": 5}, old=True)
    assert (got.setlist, got.downloads, got.avg_rating, got.error) == ("a b", 5, 0.0, None)


def test_old_recordings_clean_lists_element_by_element(recording):
    got = recording(
        {"tracklist": [], "setlist": [" <b>a</b> x", None, "<i>b</i>", ""], "description": "<p>one</p>"},
        old=True, lists=True)
    assert (got.setlist, got.description) == (["a x", None, "b", ""], ["one"])
    got = recording({"setlist": [], "lineage": "c<br>d"}, old=True, lists=True)
    assert (got.setlist, got.description) == (["cd"], [])


def test_manifest_defaults_and_document(spark, tmp_path):
    repos = spark.createDataFrame(
        [(1, "o/a", None, "c1", 5, None), (2, "o/b", "d", "c2", 9, ("MIT",)), (3, "o/c", "e", "c3", 5, None)],
        "id long, full_name string, description string, clone_url string, stargazers_count int, license struct<name:string>",
    )
    manifest = records.repo_manifest(repos)
    got = records.by_stars(manifest).collect()
    assert [r.name for r in got] == ["o/b", "o/a", "o/c"]
    assert (got[1].description, got[1].license, got[0].license, got[1].topics) == ("No description", "No license", "MIT", [])
    records.write_manifest_document(manifest, str(tmp_path / "m"), "2001-02-03")
    doc = json.loads("".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*"))))
    assert doc["total_repos"] == 3 and [r["name"] for r in doc["repositories"]] == ["o/b", "o/a", "o/c"]


def test_search_dedup(spark):
    df = spark.createDataFrame(
        [("q1", 0, 1, 0, 1), ("q1", 0, 1, 1, 2), ("q2", 1, 1, 0, 2), ("q2", 1, 1, 1, 3)],
        "query string, query_pos int, page int, rank int, id int",
    )
    per = firstwins.query_stats(df)
    assert sorted(map(tuple, per.collect())) == [("q1", 2, 2), ("q2", 2, 1)]
    total = firstwins.search_stats(per, timestamp="t").collect()[0]
    assert (total.total_found, total.unique_repos, total.deduplication_ratio) == (4, 3, "3/4 (75.0%)")
    assert total.queries["q2"].new_repos == 1
    empty = firstwins.search_stats(firstwins.query_stats(df.limit(0)), timestamp="t").collect()[0]
    assert empty.deduplication_ratio == "0/0 (0%)"


def test_first_wins_with_a_hot_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), (5000 - F.col("id")).alias("pos"), "id"
    )
    got = {r.k: r.id for r in firstwins.dedup_first(df, ["k"], ["pos"]).collect()}
    assert got[-1] == 4998 and len(got) == 5000 - 1667 + 1


def test_unseen_drops_seen_and_repeats(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "id string, pos int")
    seen = spark.createDataFrame([("a",), ("a",)], "id string")
    fresh = firstwins.unseen(new, seen, "id", ["pos"])
    assert sorted(map(tuple, fresh.collect())) == [("b", 2), ("c", 4)]
    assert "LeftAnti" in fresh._jdf.queryExecution().executedPlan().toString()
    assert firstwins.seen_only(new, seen).count() == 1


def test_dead_letters(spark):
    df = spark.createDataFrame([("a", None), ("", "boom")], "id string, error string")
    ok, failed = firstwins.split_errors(df)
    assert ok.columns == ["id"] and ok.count() == 1
    assert firstwins.dead_letters(failed, timestamp="t").collect()[0].line == "t | unknown | boom"


def test_new_item_links(spark):
    listing = spark.createDataFrame(
        [(1, "https://h/l", '<a href="/items/show/2">b</a><a href="/items/show/1">a</a><a href="/x">x</a>'),
         (2, "https://h/l", '<a href="/items/show/2">b</a><a href="/items/show/3">c</a>')],
        "page_id long, url string, html string",
    )
    seen = spark.createDataFrame([("https://h/items/show/1",)], "id string")
    urls = [r.url for r in items.new_item_links(listing, seen, max_items=5).collect()]
    assert urls == ["https://h/items/show/2", "https://h/items/show/3"]
    assert items.new_item_links(listing, seen, max_pages=1).count() == 1
