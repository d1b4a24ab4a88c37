"""Chat formatting by token-level assembly.

Every turn is encoded on its own: its role mark, its text and its end mark. Marks
are reserved ids above the vocabulary, spliced between the ids of the segments,
so no text can ever form one. Control strings inside a text are escaped before
it is encoded, for readers that see the decoded string. Offsets of the segments
in the conversation, and with them the loss mask, are prefix sums of the
segments' lengths.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import broadcast_bytes

# Fixed value: the public split pattern of the byte-level vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@dataclass(frozen=True)
class Template:
    """Marks of a chat template; all of them are control strings inside texts."""

    roles: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: ", "tool": "### Tool: ",
    })
    other: str = "### Role: "  # any other role, whose name follows as text
    name_end: str = " </role> "
    end: str = " </turn>\n"
    learned: tuple[str, ...] = ("assistant",)

    def marks(self) -> list[str]:
        return [*self.roles.values(), self.other, self.name_end, self.end]

    def controls(self) -> list[str]:
        """What is escaped: the marks without the white space around them, longest first."""
        return sorted({m.strip() for m in self.marks()}, key=lambda m: (-len(m), m))


class Escaper:
    r"""A backslash before each control string; backslashes right before one are doubled.

    The run of backslashes before a control string has 2k + 1 of them after
    escaping k, so reading back is exact; other backslashes stay as they are.
    """

    def __init__(self, controls: list[str]):
        any_control = "|".join(map(re.escape, controls))
        self.find = re.compile(rf"(\\*)({any_control})")
        self.quick = re.compile(any_control)

    def escape(self, text: str) -> str:
        if not self.quick.search(text):
            return text
        return self.find.sub(lambda m: m[1] * 2 + "\\" + m[2], text)

    def unescape(self, text: str) -> str:
        if not self.quick.search(text):
            return text
        return self.find.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)


class Codec:
    """A byte-level vocabulary with the template's marks as reserved ids above it."""

    def __init__(self, vocabulary: bytes, template: Template):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.base = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        first = max(ranks.values()) + 1
        self.template = template
        self.ids = {m: first + i for i, m in enumerate(template.marks())}
        self.names = {i: m for m, i in self.ids.items()}
        self.first = first
        self.escaper = Escaper(template.controls())

    def encode(self, text: str) -> list[int]:
        """Ids of the escaped text; lone surrogates cannot occur in a table's strings."""
        return self.base.encode_ordinary(self.escaper.escape(text))

    def turn(self, role: str | None, text: str | None) -> tuple[list[int], list[int]]:
        """The ids of a turn and the lengths of its segments: mark, text, end.

        A null role is written as the empty name, which is no known role.
        """
        t = self.template
        known = t.roles.get(role or "")
        head = [self.ids[known]] if known else [
            self.ids[t.other], *self.encode(role or ""), self.ids[t.name_end]]
        body = self.encode(text or "")
        return [*head, *body, self.ids[t.end]], [len(head), len(body), 1]

    def decode(self, ids: list[int]) -> str:
        """The formatted string of ids, marks included, still escaped."""
        out, run = [], []
        for i in ids:
            if i < self.first:
                run.append(i)
            else:
                out += [self.base.decode(run), self.names[i]]
                run = []
        return "".join([*out, self.base.decode(run)])

    def read_turn(self, ids: list[int]) -> tuple[str, str, tuple[int, int]]:
        """(role, text, segment bounds of the text) read back from a turn's ids."""
        t = self.template
        at = 1
        if ids[0] == self.ids[t.other]:
            stop = ids.index(self.ids[t.name_end])
            role, at = self.escaper.unescape(self.base.decode(ids[1:stop])), stop + 1
        else:
            role = {m: r for r, m in t.roles.items()}[self.names[ids[0]]]
        end = len(ids) - 1
        if ids[end] != self.ids[t.end]:
            raise ValueError("a turn without its end mark")
        return role, self.escaper.unescape(self.base.decode(ids[at:end])), (at, end)


def load_vocabulary(spark: SparkSession, path: str):
    """Broadcast a vocabulary file, a few MB at most, that the driver can read."""
    with open(path, "rb") as f:
        return broadcast_bytes(spark, f.read(), 16 << 20, "vocabulary")


def format_turns(
    turns: DataFrame, vocabulary: str, *, template: Template = Template(), conv: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Format every turn; one row per turn.

    Returns ``conv``, ``turn``, ``ids`` (token ids), ``formatted`` (their string),
    ``start`` (offset of the turn in the ids of its conversation), ``loss_from``
    and ``loss_to`` (the part of the conversation's ids under the loss mask;
    null for roles that are not learned). Turns are ordered by turn, nulls first,
    then by role and text, so ties and repeated rows have one order; every row
    stays. Null texts are empty, null roles are the empty name, a null
    conversation is a conversation of its own. Other columns are ignored.
    Offsets are a running sum over a window whose rows Spark spills, so a long
    conversation costs time in its task but no memory.
    """
    shared = load_vocabulary(turns.sparkSession, vocabulary)
    rows = turns.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.col(role).alias("role"), F.col(text).alias("text"),
    )

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, template)
        for batch in stream:
            made = [codec.turn(r, t) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            ids = [m[0] for m in made]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int32())),
                 pa.array([codec.decode(i) for i in ids], pa.string()),
                 pa.array([m[1] for m in made], pa.list_(pa.int32()))],
                ["conv", "turn", "role", "text", "ids", "formatted", "sizes"])

    encoded = rows.mapInArrow(
        encode, "conv long, turn long, role string, text string, ids array<int>, formatted string, sizes array<int>")
    order = Window.partitionBy("conv").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    before = F.coalesce(F.sum(F.size("ids")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    learned = F.col("role").isin(*template.learned)
    start = F.col("start")
    return encoded.withColumn("start", before.cast("long")).withColumn("n", F.row_number().over(order)).select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("n").alias("position"), "ids", "formatted", "start",
        F.when(learned, start + F.get("sizes", F.lit(0))).alias("loss_from"),
        F.when(learned, start + F.get("sizes", F.lit(0)) + F.get("sizes", F.lit(1))).alias("loss_to"),
    )


def read_back(
    formatted: DataFrame, vocabulary: str, *, template: Template = Template(), conv: str = "conv_id",
) -> DataFrame:
    """Digests per conversation, read from the ids and masks of ``format_turns``.

    (conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). Rows
    of a conversation stream through one task in order, sorted by Spark; the task
    holds a batch and two digests in progress, never the conversation.
    """
    shared = load_vocabulary(formatted.sparkSession, vocabulary)

    class Open:
        def __init__(self, conv):
            self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()

        def row(self):
            return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)

    def digest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, template)
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def out(rows):
            cols = list(zip(*rows)) if rows else [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        now, done = None, []
        for batch in stream:
            for c, ids, start, low, high, chars in zip(*(x.to_pylist() for x in batch.columns)):
                if now is None or now.conv != c:
                    if now is not None:
                        done.append(now.row())
                    now = Open(c)
                role, text, _ = codec.read_turn(ids)
                now.turns += 1
                now.all.update(f"{role}\n{text}\n".encode())
                now.chars += chars
                if low is not None:
                    said = codec.escaper.unescape(codec.base.decode(ids[low - start:high - start]))
                    now.loss_chars += len(said)
                    now.loss.update(said.encode())
            if done:
                yield out(done)
                done = []
        yield out(done + ([now.row()] if now is not None else []))

    # By conversation and turn: the window of format_turns left them so.
    rows = formatted.select(
        F.col(conv).alias("conv"), "ids", "start", "loss_from", "loss_to",
        F.char_length("formatted").cast("long").alias("chars"), "position",
    ).repartition("conv").sortWithinPartitions("conv", "position").drop("position")
    return rows.mapInArrow(
        digest,
        "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    ).withColumnRenamed("conv", conv)
