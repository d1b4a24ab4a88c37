from pyspark.sql import functions as F

from quillspark.llm import simhash
from quillspark.llm.line_dedup import dedup_lines


def stage(table):
    out = dedup_lines(table, keep_first=True)
    return out.drop("n_lines", "n_dropped")


def test_one_copy_of_every_text_is_left(spark, docs):
    """Texts with ten copies and more come through once, whole; a line that many share comes through once."""
    body = lambda g: [f"Line {k} of text {g} says something" for k in range(20)]
    copies = {g: "\n".join(["All texts have this line", *body(g)]) for g in range(3)}
    rows = [(100 * g + i, copies[g] if i % 2 else copies[g].upper()) for g in copies for i in range(16)]
    near = {500 + i: "\n".join([f"copy {i} has this line"] + body(7)) for i in range(12)}
    footed = {600 + i: f"{i} is a text of some length, all its own, that goes on\nfooter" for i in range(12)}
    table = docs(rows + list(near.items()) + list(footed.items()) + [(None, copies[0]), (5, copies[0])])
    out = stage(table)
    got = {r.doc_id: r.text for r in out.collect()}
    assert out.count() == table.count()
    for i, t in rows:
        assert got[i] == (t if i % 100 == 0 else "")
    assert got[None] == ""
    for i, t in near.items():
        assert got[i] == (t if i == 500 else t.split("\n")[0])
    assert all(got[i] == (t if i == 600 else t.split("\n")[0]) for i, t in footed.items())
    left = {r.text.lower() for r in simhash.keep_one(out).collect()}
    assert {c.lower() for c in copies.values()} | {near[500].lower()} <= left


def test_every_line_is_somewhere(spark, docs):
    """Essays that quote one paragraph keep it in the first; columns of any name do no harm."""
    quoted = "a paragraph that all of them quote " * 3
    rows = [(20 - i, f"essay {i} begins here\n{quoted}\nessay {i} ends after some more words") for i in range(12)]
    rows += [(50, ""), (51, None), (None, quoted), (60, quoted + "\n" + quoted)]
    table = docs(rows).selectExpr("*", "1 AS at", "2 AS pos", "3 AS n", "'k' AS k", "4 AS h1", "5 AS w1")
    got = {r.doc_id: r for r in stage(table).collect()}
    lines = {x.strip().lower() for _, t in rows for x in (t or "").split("\n")}
    assert {x.strip().lower() for r in got.values() for x in r.text.split("\n")} == lines
    assert quoted in got[9].text and not any(quoted in got[i].text for i in range(10, 21))
    assert got[9].at == 1 and got[9].k == "k" and got[None].text == "" and got[60].text == ""
    assert stage(table.filter("false")).count() == 0
