"""Chat formatting: a role machine validates turn order, a declarative template gives text segments with loss flags.

A conversation is read turn by turn. Rows are dealt out by conversation and sorted inside their
partition, and a task holds one row and one machine state at a time: a conversation of any
length streams through, also one that holds a third of all rows.

Control strings inside texts are escaped: a backslash goes behind the first
character of every control string, and one more where there are some already. Taking one out
again gives the text back. Roles are percent-escaped, so a header ends at its line break.

Defined results: NULL text and NULL role count as empty; a role that the template does not know is formatted
as any other, carries no loss and breaks the order; NULL conversations are one conversation; rows of
one turn number are ordered by role and text; repeated rows are turns of their own and break the order; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around a turn, roles that carry loss, and for each state the roles that may follow."""

    before: str = "<|im_start|>"
    after_role: str = "\n"
    after: str = "<|im_end|>\n"
    control: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>")
    loss: frozenset[str] = frozenset({"assistant"})
    order: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "opened", "user": "asked"},
            "opened": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    final: frozenset[str] = frozenset({"answered"})

    def pattern(self, marks: str) -> re.Pattern:
        return re.compile("|".join(f"{re.escape(c[0])}{marks}(?=\\\\*{re.escape(c[1:])})" for c in self.control))

    def escape(self, text: str) -> str:
        return self.pattern("").sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self.pattern(r"\\").sub(lambda m: m[0][:-1], text)

    def step(self, state: str, role: str) -> str:
        """The state after a turn; an order once broken stays broken."""
        return self.order.get(state, {}).get(role, "broken")


CHATML = Template()
SEGMENTS = "conv_id {kind}, place bigint, segment string, loss boolean, state string"


def _segments(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[pa.RecordBatch]:
    now, state, place = object(), "start", 0
    for batch in batches:
        rows: list[tuple] = []
        for conv, role, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            conv, role = conv.as_py(), role.as_py() or ""
            if conv != now:
                now, state, place = conv, "start", 0
            state = template.step(state, role)
            head = template.before + quote(role, safe=" ") + template.after_role
            for segment, loss in ((head, False), (template.escape(text.as_py() or ""), role in template.loss), (template.after, False)):
                rows.append((conv, place, segment, loss, state))
                place += 1
        kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.bool_(), pa.string()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "place", "segment", "loss", "state"])


def format_chats(df: DataFrame, template: Template = CHATML, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, place, segment, loss, state)``: three segments a turn, in order by ``place``.

    The formatted conversation is its segments one after the other. ``state`` is the machine's after the turn: a
    conversation is valid if its last state is one of ``template.final``.
    """
    kind = df.schema[conversation].dataType.simpleString()
    rows = df.select(F.col(conversation).alias("c"), F.col(role).cast("string").alias("r"), F.col(text).cast("string").alias("x"), F.col(turn).alias("t"))
    dealt = rows.repartition("c").sortWithinPartitions("c", "t", "r", "x").select("c", "r", "x")
    return dealt.mapInArrow(partial(_segments, template=template), SEGMENTS.format(kind=kind))


def _read(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[pa.RecordBatch]:
    """Parses the character stream of the segments; only an unfinished turn is held."""
    header = re.compile(re.escape(template.before) + "([^\n]*?)" + re.escape(template.after_role))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "state"]

    class Reading:
        def __init__(self, conv) -> None:
            self.conv, self.rest, self.turns, self.chars, self.loss_chars, self.state = conv, "", 0, 0, 0, "start"
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()

        def take(self, segment: str, loss: bool, state: str) -> None:
            self.chars += len(segment)
            self.state = state
            if loss:
                plain = template.unescape(segment)
                self.loss_chars += len(plain)
                self.loss.update(plain.encode())
            self.rest += segment
            # an escaped text cannot hold the mark that ends a turn
            while segment.endswith(template.after[-1:]) and (end := self.rest.find(template.after)) >= 0:
                m = header.match(self.rest)
                if not m or m.end() > end:
                    raise ValueError(f"conversation {self.conv!r}: a turn without a header")
                role, text = unquote(m[1]), template.unescape(self.rest[m.end() : end])
                self.all.update(f"{role}\n{text}\n".encode())
                self.turns += 1
                self.rest = self.rest[end + len(template.after) :]

        def row(self) -> tuple:
            if self.rest:
                raise ValueError(f"conversation {self.conv!r}: an unfinished turn")
            return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.state

    reading, kind = None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        kind, rows = batch.schema.field(0).type, []
        for conv, segment, loss, state in zip(*(batch.column(i) for i in range(4)), strict=True):
            conv = conv.as_py()
            if reading is None or conv != reading.conv:
                rows += [reading.row()] if reading else []
                reading = Reading(conv)
            reading.take(segment.as_py(), loss.as_py(), state.as_py())
        yield out(rows)
    if reading:
        yield out([reading.row()])


def read_chats(segments: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation, parsed back from its segments: turns, digests of all turns and of the text under loss, lengths, validity.

    A digest runs over a conversation in order, so one conversation stays in one task; it streams.
    """
    kind = segments.schema["conv_id"].dataType.simpleString()
    dealt = segments.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "segment", "loss", "state")
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, state string"
    read = dealt.mapInArrow(partial(_read, template=template), schema)
    return read.withColumn("valid", F.col("state").isin(*sorted(template.final)))
