import base64
import hashlib
import os
import random

from quillspark.llm import warc


def archive(tmp_path, records):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(warc.member_bytes(r) + b"\0" for r in records))
    return path


def records(payloads):
    return [
        warc.record_bytes(i, f"http://a/{i}", p, base64.b32encode(hashlib.sha1(p).digest()).decode(), None, "2000-01-01T00:00:00Z")
        for i, p in enumerate(payloads)
    ]


def test_ranges_own_each_record_once(tmp_path):
    rng = random.Random(1)
    payloads = [rng.randbytes(rng.choice([0, 3, 900, 70_000, 3_000_000])) for _ in range(24)]
    made = records(payloads)
    path = archive(tmp_path, made)
    size = os.path.getsize(path)
    for step in (size, 100_003, 1 << 20):
        found = []
        with warc._open(str(path)) as file:
            for start in range(0, size, step):
                found += list(warc.range_members(file, start, start + step))
        assert [r for _, r in found] == made
        assert len({o for o, _ in found}) == len(made)


def test_false_magic_and_damage(tmp_path):
    a, b, c = records([b"a" * 10, b"b" * 400_000, b"c"])
    members = [warc.member_bytes(r) + b"\0" for r in (a, b, c)]
    broken = members[1][:60] + b"\xff\xff" + members[1][62:]
    path = tmp_path / "d"
    path.write_bytes(warc.MAGIC * 3 + members[0] + broken + warc.MAGIC + b"\xff" + members[2] + members[0][:20])
    with warc._open(str(path)) as file:
        assert [r for _, r in warc.range_members(file, 0, 1 << 30)] == [a, c]


def test_large_record_ends_in_zero():
    record = b"WARC/1.1\r\n" + b"x" * (1 << 24)
    member = warc.member_bytes(record) + b"\0"
    import zlib

    unpack = zlib.decompressobj(31)
    assert unpack.decompress(member) == record and unpack.unused_data == warc.EMPTY_MEMBER


def test_roundtrip_with_revisits_nulls_and_ties(spark, tmp_path):
    rows = [
        (5, "u5", "same", 1), (2, "u\n2", "same", 1), (2, "u2", "same", 1), (9, None, "same", 1),
        (None, "n", "same", 1), (None, "n", "alone", 1), (None, "n", "alone", 1), (1, "e", None, 1), (3, "e", "", 1),
        (4, "ü", "häß\r\n\r\nx", 1), (6, "big", "z" * 3_000_000, 1),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    path = str(tmp_path / "w")
    warc.write_warc(pages, path)
    read = warc.read_warc(spark, path, split_bytes=200)
    got = sorted(warc.page_records(read).collect(), key=str)
    b32 = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    first = {"same": 2, "": 1}
    want = []
    for p, _, h, _ in rows:
        h = h or ""
        f = first.get(h)
        again = f is not None and p != f
        want.append((p, len(h.encode()), b32(h), "revisit" if again else "response", f if again else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    whole = {r.payload.decode() for r in read.filter("record_type = 'response'").collect()}
    assert whole == {"same", "alone", "", "häß\r\n\r\nx", "z" * 3_000_000}


def test_min_bytes_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "m"), min_bytes=4)
    kinds = {r.page_id: r.record_type for r in warc.page_records(warc.read_warc(spark, str(tmp_path / "m"))).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    warc.write_warc(pages.filter("false"), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0
