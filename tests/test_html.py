import html as std

from pyspark.sql import functions as F

from quillspark.functions import html as H
from quillspark.functions import markup as M

PAGE = """<html><head><title>T &amp; x</title><style>p{}</style></head><body>
<h1> Big <b>Head</b> &eacute;&#233;&#x1F600; &bogus; </h1><script>var a="</p>";</script>
<a href="/x?a=1&amp;b=2" title='t"1'>Hi <i> you </i></a><!-- <a href="no">n</a> --><a name=q>z</a><a href=bare>Bare</a>
<dl><dt>Date</dt><dd>2003</dd><dt>Subject</dt><dd>x <b>y</b></dd></dl>
<div class="item-Metadata"><p>Zed <span>1999-01-02</span></p></div>
<div class="transcript">a<br>b &lt;</div><p title="a>b">one</p></body>"""
H_ = F.col("h")


def test_text_forms(values):
    frag = "<p> a <b>b</b>c</p><!-- no --> d &amp;lt; <script>x</script>"
    got = values({"h": frag}, H.html_text(H_), H.html_text(H_, ""), H.html_text(H_, None))
    assert got == ["a b c d &lt;", "abcd &lt;", "a bc d &lt;"]


def test_unescape_matches_the_standard_library(values):
    for s in ["&amp;amp; &eacute; &#8364;", "&#x20AC;", "a & b", "&nosuch;", "&lt", "&hearts;&nbsp;x", "&#xD800;", "&&amp;"]:
        want = s if "D800" in s else std.unescape(s)
        assert values({"h": s}, H.unescape(H_)) == [want], s


def test_links(values):
    (links,) = values({"h": PAGE}, H.links_of(H_))
    assert [(x.pos, x.href, x.title, x.text) for x in links] == [
        (0, "/x?a=1&b=2", 't"1', "Hiyou"), (2, "bare", "", "Bare")
    ]


def test_titles(values):
    assert values({"h": PAGE}, H.page_title(H_)) == ["BigHeadéé😀 &bogus;"]
    assert values({"h": "<title>x</title>"}, H.page_title(H_)) == ["x"]
    assert values({"h": "<p>x</p>"}, H.page_title(H_)) == ["Unknown Title"]
    assert values({"h": "A · Site"}, H.clean_title(H_, "· Site")) == ["A"]


def test_definitions(values):
    (pairs,) = values({"h": PAGE}, H.definition_pairs(H_))
    assert [tuple(p) for p in pairs] == [("date", "2003"), ("subject", "xy")]
    (pairs,) = values({"h": "<dl><dt>A</dt><dt>B</dt><dd>x</dd></dl>"}, H.definition_pairs(H_))
    assert [tuple(p) for p in pairs] == [("a", "x"), ("b", "x")]
    slots = {"creator date": "creator", "updated": "date", "format": "type", "description": "description",
             "subjects": "tags", "other": None}
    for key, slot in slots.items():
        assert values({"h": key}, H.definition_slot(H_)) == [slot]


def test_json_ld_survives_bad_blocks(values):
    for body in ["", "{bad", "[1]", "null"]:
        (got,) = values({"h": f'<script type="application/ld+json">{body}</script>'}, H.json_ld(H_))
        assert got.name is None and got.keywords is None


def test_selectors(values):
    got = values(
        {"h": PAGE},
        M.select_texts(H_, [".transcript", '[class*="data"]', "time, h1", "dl dd", "nav a"]),
        M.nested_texts(H_, "metadata", ["span", "div", "p"]),
        M.select_first(H_, [".transcript", "h1"], 5),
    )
    assert got[0] == ["ab <", "Zed1999-01-02", "BigHeadéé😀 &bogus;", "2003", None]
    assert got[1] == ["Zed1999-01-02", "1999-01-02"]
    assert got[2] == "BigHeadéé😀 &bogus;"


def test_select_links_in_container(values):
    page = '<a href="/out">outside</a><div class="v"><h3><a href="/e/1" title="Ti">x</a></h3><a href="/e/2">y</a></div>'
    (got,) = values({"h": page}, M.select_links(H_, ['a[href*="/e/"]', "h3 a"], ".v"))
    assert [(x.sel, x.href, x.title) for x in got] == [(0, "/e/1", "Ti"), (1, "/e/1", "Ti"), (0, "/e/2", "")]


def test_text_is_jvm_only(spark):
    df = spark.createDataFrame([(PAGE,)], "h string").select(H.html_text(H_), H.links_of(H_), H.json_ld(H_))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_very_long_runs(values):
    n = 100_000
    for sep, want in ((" ", "a b c"), ("", "a" + " " * n + "bc"), (None, "a" + " " * n + "bc")):
        page = "a" + " " * n + "b" + "<br>" * n + "c"
        assert values({"v": page}, H.html_text(F.col("v"), sep)) == [want]


def test_page_text_keeps_every_visible_word(values):
    page = (
        "<html><head><title>T &amp; t</title><style>no</style></head><body>lead<p>one<p>two <b>bold</b><div>three"
        "<ul><li>x<li>y</ul><script>no</script><table><tr><td>1<td>2</table>end<br/>last"
    )
    text, plain = values({"v": page}, H.page_text(F.col("v")), H.html_text(F.col("v"), " "))
    assert text.split() == plain.split()
    assert text.split("\n\n") == ["T & t", "lead", "one", "two bold", "three", "x", "y", "1", "2", "end", "last"]
    assert values({"v": None}, H.page_text(F.col("v"))) == [None]
