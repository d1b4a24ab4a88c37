from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from quillspark.functions import urls as U

BASES = ["https://h/b/c", "http://h", "http://h/", "http://h/a/b/?q=1#f", "https://h:80/x/y;p", "https://h/a/../b/c"]
REFS = [
    "", "/a", "d", "../x", "../../../x", "./y", "//o/p", "?q=2", "#z", "mailto:u@h", "http://k", "a//b",
    "/a/../b", "/a//b/./c/", "..", ".", "x;y?z#w", "javascript:void(0)", "/a?x=1&y=2", "x/#?", "a?b?c",
]


def test_join_and_normalise_match_the_standard_library(spark):
    df = spark.createDataFrame([(b, r) for b in BASES for r in REFS], "b string, r string")
    rows = df.select("b", "r", U.url_join(F.col("b"), F.col("r")), U.normalize_url(F.col("b"))).collect()
    for b, r, joined, normal in rows:
        assert joined == urljoin(b, r), (b, r)
        p = urlparse(b)
        assert normal == f"{p.scheme}://{p.netloc}{p.path}"


def test_internal_links(values):
    c = F.col("u")
    assert values({"u": "https://h/a"}, U.is_internal(c, "h")) == [True]
    assert values({"u": "https://o/a"}, U.is_internal(c, "h")) == [False]
    mail = {"u": "mailto:u@h"}
    assert values(mail, U.is_internal(c, "h"), U.is_internal(c, "h", compat=True), U.normalize_url(c)) == [
        False, True, "mailto://u@h"
    ]


def test_suffixes(values):
    for path, want in {"/a/x.PNG": ".png", "/.gitignore": "", "/a.b/c": "", "x.tar.gz": ".gz", "/x.": ""}.items():
        assert values({"p": path}, U.path_suffix(F.col("p"))) == [want]


def test_item_id_and_target(values):
    c = F.col("u")
    first = values({"u": "https://h/items/show/12?x"}, U.item_id(c))
    other = values({"u": "https://h/z"}, U.item_id(c))
    assert first == ["12"] and other == values({"u": "https://h/z"}, U.item_id(c)) and other != first
    import hashlib

    digest = hashlib.md5(b"https://h/z").hexdigest()[:8]
    assert values({"u": "https://h/z"}, U.attachment_target(c, F.lit("f.pdf"), F.lit("12"))) == [f"12/{digest}_f.pdf"]
