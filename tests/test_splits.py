"""Records over lines and splits, against readers of whole files."""

import csv
import io
import random

import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from quillspark.operators import corpus
from quillspark.sources import text as text_source
from quillspark.sources import splits as splits_module
from quillspark.sources.splits import read_records
from quillspark.sources.trees import quoted_lines, read_csv


@pytest.fixture(params=["100b", "128m"])
def splits(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def table(rng, rows, escape):
    cell = lambda: "".join(rng.choices(["a", "b", " ", ",", '"', "\n", "\n\n", "é", "x" * 30], k=rng.randint(1, 9)))
    out = io.StringIO()
    writer = csv.writer(
        out, lineterminator="\n", doublequote=escape == '"', escapechar=None if escape == '"' else escape,
        quoting=csv.QUOTE_ALL if escape != '"' or rng.random() < 0.5 else csv.QUOTE_MINIMAL)
    body = [[str(i), cell(), cell()] for i in range(rows)]
    writer.writerow(["id", "first\nname", "b"])
    writer.writerows(body)
    return out.getvalue(), body


@pytest.mark.parametrize("escape", ['"', "\\"])
def test_quoted_line_breaks_in_splits(spark, tmp_path, splits, escape):
    rng = random.Random(f"{splits}{escape}")
    want = []
    for k in range(2):
        whole, body = table(rng, 15, escape)
        (tmp_path / f"{k}.csv").write_text(whole)
        want += body
    got = read_csv(spark, str(tmp_path), escape)
    assert got.columns == ["id", "first\nname", "b"]
    assert sorted(map(list, got.collect())) == sorted(want)


def test_lines_open_and_close_as_in_a_whole_file_reader():
    rng = random.Random(5)
    step = quoted_lines('"')
    for _ in range(3000):
        whole = "".join(rng.choices(['"', '""', ",", "a", "\n"], k=rng.randint(0, 14)))
        state, records = 0, 0
        for line in whole.split("\n"):
            starts, state = step(False, line, state)
            records += starts
        # An empty last line is a line here and no record there.
        reader = csv.reader(io.StringIO(whole + "\nx" if not state else whole, newline=""))
        assert records == len(list(reader)) - (not state)


def test_odd_files(spark, tmp_path, splits):
    read = lambda name, data: read_csv(spark, (tmp_path / name).write_bytes(data) and str(tmp_path / name), '"')
    assert [tuple(r) for r in read("a.csv", b'x,y\r\n1,"p\r\nq"\r\n\r\n2\r\n3,,4').collect()] == [
        ("1", "p\r\nq"), ("2", None), ("3", None)]
    same = read("b.csv", b'k,K,\n5" disc,"",z\n')
    assert same.columns == ["k0", "K1", "_c2"] and [tuple(r) for r in same.collect()] == [('5" disc', "", "z")]
    assert read("c.csv", b"only,header\n").count() == 0
    (tmp_path / "empty.csv").write_bytes(b"")
    assert read_csv(spark, str(tmp_path / "empty.csv")).columns == []


def test_unclosed_quote_takes_the_rest_of_its_file_only(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text('h\n"open\n' + "more\n" * 60)
    (tmp_path / "b.csv").write_text("h\n1\n2\n")
    got = read_records(spark, str(tmp_path), quoted_lines('"')).select("text").collect()
    assert sorted(len(r.text) for r in got) == [1, 1, 1, 1, len('"open\n' + "more\n" * 60) - 1]


def test_many_splits_are_joined_in_order(spark, tmp_path, splits):
    whole, body = table(random.Random(9), 40, '"')
    (tmp_path / "t.csv").write_text(whole)
    step = quoted_lines('"')
    sent = read_records(spark, str(tmp_path), step)
    joined = read_records(spark, str(tmp_path), step, most_broadcast=0)
    assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, joined.collect()))
    assert sent.count() == len(body) + 1


def test_one_entry_over_many_splits(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        body = "\n".join(f"[line {i}] of the long entry, [x] :: {i}" for i in range(40_000))
        (tmp_path / "c.txt").write_text(f"[r] :: [small]\nfirst\n\n[r] :: [long]\n{body}\n\n[r] :: [last]\nend\n")
        entries = text_source.read_corpus_text(spark, str(tmp_path))
        parsed = corpus.parse_entries(entries.orderBy("file", "begin", "line").select("entry"), shortest=1)
        assert [(r.path, r.content) for r in parsed.collect()] == [("small", "first"), ("long", body), ("last", "end")]
        assert entries.where(F.length("entry") > 1_000_000).count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_portions_are_bounded_by_bytes():
    lengths = [300_000] * 9 + [0, 3_000_000, 1, 0]
    batch = pa.record_batch({"file": ["f"] * 13, "value": ["x" * n for n in lengths]}).slice(1)
    parts = list(splits_module._portions(batch, 1))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    sizes = [sum(map(len, p.column(1).to_pylist())) for p in parts]
    assert all(s <= splits_module.PORTION_BYTES or p.num_rows == 1 for s, p in zip(sizes, parts))
    assert list(splits_module._portions(batch.slice(0, 0), 1)) == []
