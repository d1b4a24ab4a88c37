"""Token ids in binary files: frequency ranks in byte-aligned variable-length coding.

Ids are replaced by their rank of frequency, so frequent ids are small numbers. A
number takes one to four bytes; its length is a code of two bits, and the codes of
four numbers make a control byte. Control bytes and number bytes are stored apart,
so a reader looks up a control byte's four lengths and byte positions in tables
and gathers many numbers at once with numpy.

A file is a row of segments in the order of documents. A segment of about two
million ids has a header, its ids by rank, the documents' ids and lengths, control
bytes, number bytes and one end byte. Ranks are counted over the segment they
serve: texts are encoded once, nothing goes through the driver, and a file is read
without any other. Files are written by Spark's text sink as raw bytes (the end
byte is its line separator), so they reach any store and a lost task leaves
nothing behind.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import broadcast_bytes, per_process, portions, written

MAGIC = b"QTI1"
# Magic, documents, ids, different ids, control bytes, number bytes, check sum of the rest.
HEADER = struct.Struct("<4sIQIQQI")
SEGMENT_IDS = 2 << 20
GROUPS_AT_ONCE = 1 << 16
KNOWN_WORDS, LONGEST_WORD = 800_000, 48
MOST_TOKENIZER_BYTES = 64 << 20


# --- encoding -----------------------------------------------------------------

# Pieces that a byte-level pre-tokenizer always parts, so they can be encoded alone: a Latin
# word with the blank before it, if a blank, a line break or one of a few marks follows;
# such marks after a word up to white space; a single line break; and whatever is left
# up to the next blank or line break, with the blanks and breaks before it.
_PIECES = re.compile(
    r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+(?=[ \n,.;:!?)]|\Z)|[,.;:!?)]+(?=[ \n]|\Z)|\n(?=[^ \n])|[ \n]*[^ \n]+|[ \n]+")
# With other white space the pieces are not safe; texts that hold it are encoded whole.
_RARE = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200f\u2028\u2029\u202f\u205f\u3000]")
_SIMPLE = re.compile(r" ?[^ \n]+")
JOINED = 20_000


class WordEncoder:
    """Ids of texts by the tokenizers library, which sees a piece once while it is remembered.

    Only for byte-level pre-tokenizers without a normaliser or leading blank; with
    others every text goes to the library whole.
    """

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(data)
        pre = self.tokenizer.pre_tokenizer
        self.by_word = (
            type(pre).__name__ == "ByteLevel" and self.tokenizer.normalizer is None
            and not pre.add_prefix_space and pre.use_regex
        )
        self.known: dict[str, bytes | None] = {}
        self.line_break = self._each(["\n"])[0]

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def _together(self, pieces: list[str]) -> list[bytes]:
        """One call for many pieces without line breaks, parted by the ids of line breaks."""
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        mark = np.frombuffer(self.line_break, "<u4")
        cuts = np.flatnonzero(ids == mark[0]) if len(mark) == 1 else []
        if len(cuts) != len(pieces) - 1:
            return self._each(pieces)
        data, ends = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
        return [data[a:b] for a, b in zip([0, *(4 * cuts + 4).tolist()], ends)]

    def _learn(self, pieces: set[str]) -> None:
        simple, other = [], []
        for p in pieces:
            if _RARE.search(p):
                self.known[p] = None
            else:
                (simple if _SIMPLE.fullmatch(p) else other).append(p)
        self.known.update(zip(other, self._each(other)))
        for i in range(0, len(simple), JOINED):
            part = simple[i:i + JOINED]
            self.known.update(zip(part, self._together(part)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if not self.by_word:
            return self._each(texts)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known, new, cut = self.known, set(), [_PIECES.findall(t) for t in texts]
        for c in cut:
            new.update([p for p in c if p not in known])
        self._learn(new)
        out = []
        for t, c in zip(texts, cut):
            ids = list(map(known.__getitem__, c))
            out.append(self._each([t])[0] if None in ids else b"".join(ids))
        for p in new:
            if len(p) > LONGEST_WORD:
                del known[p]
        return out


def _encoded(stream: Iterator[pa.RecordBatch], column: int, data, end: int):
    """(batch, ids per text with the end id) in bounded portions."""
    encoder = per_process("token-ids", data.value, WordEncoder)
    tail = np.array([end], "<u4").tobytes()
    for batch in stream:
        for rows in portions(batch, column, rows=512, size=2 << 20):
            texts = [t or "" for t in rows.column(column).to_pylist()]
            yield rows, [np.frombuffer(x + tail, "<u4") for x in encoder.encode(texts)]


# --- coding -------------------------------------------------------------------

# Per control byte: the lengths of its four numbers, their sum, and for each of the
# 16 bytes of four whole numbers its place among the stored bytes and whether it is stored.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
STORED = LENGTHS.sum(1)
_STARTS = np.cumsum(LENGTHS, 1) - LENGTHS
PLACES = (_STARTS[:, :, None] + np.arange(4)).reshape(256, 16)
PRESENT = (np.arange(4) < LENGTHS[:, :, None]).reshape(256, 16).astype(np.uint8)


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, number bytes) of unsigned 32-bit numbers."""
    n = len(numbers)
    numbers = np.ascontiguousarray(numbers, "<u4")
    code = (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    four = np.pad(code, (0, -n % 4)).reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8)
    stored = numbers.view(np.uint8).reshape(n, 4)[np.arange(4) <= code[:, None]]
    return control.tobytes(), stored.tobytes()


def unpack(control, stored, n: int) -> np.ndarray:
    """The ``n`` numbers, by table lookup. Numbers that fill the last control byte are not stored."""
    c = np.frombuffer(control, np.uint8)
    data = np.concatenate([np.frombuffer(stored, np.uint8), np.zeros(16, np.uint8)])
    sizes = STORED[c]
    starts, out = np.cumsum(sizes) - sizes, np.empty((len(c), 4), "<u4")
    for k in range(0, len(c), GROUPS_AT_ONCE):
        part = c[k:k + GROUPS_AT_ONCE]
        at = np.minimum(starts[k:k + GROUPS_AT_ONCE, None] + PLACES[part], len(data) - 1)
        out[k:k + GROUPS_AT_ONCE] = (data[at] * PRESENT[part]).view("<u4")
    return out.ravel()[:n]


def by_frequency(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the different ids, most frequent first and then smallest, the rank of every id)."""
    counts = np.bincount(ids)
    table = np.flatnonzero(counts)
    table = table[np.lexsort((table, -counts[table]))].astype("<u4")
    rank = np.zeros(len(counts), "<u4")
    rank[table] = np.arange(len(table))
    return table, rank[ids]


def segment_bytes(names: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """One segment without its end byte."""
    table, ranks = by_frequency(ids)
    control, stored = pack(ranks)
    there = np.array([i is not None for i in names], np.uint8).tobytes()
    places = np.array([i or 0 for i in names], "<i8").tobytes()
    body = table.tobytes() + there + places + np.array(counts, "<u8").tobytes() + control + stored
    return HEADER.pack(MAGIC, len(names), len(ids), len(table), len(control), len(stored), zlib.crc32(body)) + body


def read_segments(data) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(document ids, lengths, token ids) of each segment of a file; damage raises ValueError."""
    at, data = 0, memoryview(data)
    while at < len(data):
        if len(data) - at < HEADER.size:
            raise ValueError(f"token file: cut off at {at}")
        magic, docs, n, n_table, n_control, n_stored, crc = HEADER.unpack_from(data, at)
        at += HEADER.size
        sizes = [4 * n_table, docs, 8 * docs, 8 * docs, n_control, n_stored]
        body = data[at:at + sum(sizes)]
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError(f"token file: damaged segment before {at}")
        ends = np.cumsum(sizes).tolist()
        table, there, names, counts, control, stored = (body[b - s:b] for s, b in zip(sizes, ends))
        there, names = np.frombuffer(there, np.uint8), np.frombuffer(names, "<i8").tolist()
        ids = np.frombuffer(table, "<u4")[unpack(control, stored, n)]
        yield [i if t else None for i, t in zip(names, there)], np.frombuffer(counts, "<u8").astype(np.int64), ids
        at += len(body) + 1


# --- files --------------------------------------------------------------------

def write_token_files(
    docs: DataFrame, path: str, tokenizer_file: str, *, id: str = "doc_id", text: str = "text", end: int = 2,
    text_bytes_per_file: int = 32 << 20,
) -> None:
    """Encode every text, append the id ``end`` and write the ids to files below ``path`` in ascending id order.

    Part files are in order by name and hold about ``text_bytes_per_file`` bytes of
    texts each. A null text is empty; a null id comes first; rows of equal ids are
    ordered by a hash of their text, and a third key splits those that are equal
    throughout. Ids are whole numbers. Other columns are ignored; an empty table
    has files without segments.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as f:
        tokenizer = broadcast_bytes(spark, f.read(), MOST_TOKENIZER_BYTES, "tokenizer")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0

    def segments(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, lengths, held, n = [], [], [], 0

        def segment():
            data = segment_bytes(names, lengths, np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

        for rows, found in _encoded(stream, 1, tokenizer, end):
            for name, x in zip(rows.column(0).to_pylist(), found):
                names.append(name)
                lengths.append(len(x))
                held.append(x)
                n += len(x)
                if n >= SEGMENT_IDS:
                    yield segment()
                    names, lengths, held, n = [], [], [], 0
        if names:
            yield segment()

    keyed = docs.select(
        F.col(id).cast("long").alias("id"), F.col(text).alias("text"),
        F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("copy"))
    order = ["id", "hash", "copy"]
    placed = keyed.repartitionByRange(1 + total // text_bytes_per_file, *order).sortWithinPartitions(*order)
    (
        placed.select("id", "text").mapInArrow(segments, "value binary").select(F.col("value").cast("string"))
        .write.option("lineSep", "\n").text(path)
    )


def _before(sums: DataFrame, key: str, value: str, block: int = 4096) -> DataFrame:
    """(key, before): what the rows with smaller keys add up to, in blocks of keys."""
    cut = sums.withColumn("b", F.floor(F.col(key) / block))
    ahead = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("b").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.groupBy("b").agg(F.sum(value).alias("v")).select("b", F.coalesce(F.sum("v").over(ahead), F.lit(0)).alias("c"))
    return cut.join(carried, "b").select(key, (F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("c")).alias("before"))


def read_token_files(spark: SparkSession, path: str, *, ids: bool = True, id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of the documents in the files below ``path``.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is that of the
    ids as little-endian 32-bit numbers; ``ids=False`` leaves the lists null. A
    file is read by one task; ``text_bytes_per_file`` of the writer bounds its size.
    """
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for i in range(batch.num_rows):
                file, start = batch.column(0)[i].as_py(), 0
                for names, counts, found in read_segments(batch.column(1)[i].as_buffer()):
                    cuts = np.cumsum(counts) - counts
                    lists = [found[a:a + n] for a, n in zip(cuts.tolist(), counts.tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([file] * len(names), pa.int32()), pa.array(names, pa.int64()), pa.array(cuts + start),
                        pa.array(counts), pa.array([zlib.crc32(x) for x in lists], pa.int64()),
                        pa.array([x.astype(np.int32) for x in lists] if ids else [None] * len(names), pa.list_(pa.int32())),
                    ], ["file", "id", "at", "n_tokens", "ids_crc32", "ids"])
                    start += int(counts.sum())

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0")
    part: Column = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    rows = files.select(part.alias("file"), "content").mapInArrow(
        run, "file int, id long, at long, n_tokens long, ids_crc32 long, ids array<int>")
    rows = written(rows, "token-rows")
    sums = written(_before(rows.groupBy("file").agg(F.sum("n_tokens").alias("n")), "file", "n"), "token-starts")
    return rows.join(sums, "file").select(
        F.col("id").alias(id), (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "ids")
