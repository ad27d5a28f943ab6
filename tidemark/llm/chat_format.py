"""Chat formatting with a grammar round trip.

A conversation is written as one text: per turn a header line ``### Role:``, a line with the text, and a line with
the closing mark ``</turn>``. Inside texts, and in role names the template does not know, a backslash is put before every control
string; a backslash in front of a control string (or of further backslashes before one) is doubled the same way, so
that the step can be undone. Every rendered turn is read back by a deterministic parser and compared with its source;
where they differ the text is escaped once more, now with every backslash, ``#`` and ``<`` marked, until they agree.
A rendered turn can be parsed on its own and begins and ends at marks that no escaped text holds, so a conversation
parses exactly as its turns do, and turns are rendered and checked in parallel.

Defined results: null texts are empty, null roles are the empty role; turns are ordered by turn number (nulls first), equal numbers by
role and a hash of the text, and rows that repeat are turns of their own; a null conversation id forms a conversation. Very long texts are rendered
whole. Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import by_batch, quoted, text_of

HEADERS = {"system": "### System:", "user": "### User:", "assistant": "### Assistant:", "tool": "### Tool:"}
OTHER = "### Role "  # a role without a header of its own: "### Role name:"
CLOSE = "</turn>"
CONTROL = regex.compile(r"\\*(?:### (?:System|User|Assistant|Tool):|### Role |</turn>)")
STRICT = regex.compile(r"[\\#<]")
GRAMMAR = regex.compile(
    r"### (?:(?P<known>System|User|Assistant|Tool)|Role (?P<other>(?:[^\\:\n]|\\[\\#<:n])*)):(?P<mode>!?)\n"
    r"(?P<text>.*?)\n</turn>\n",
    regex.DOTALL,
)


class Unparsable(ValueError):
    """The text does not follow the grammar."""


def escaped(text: str, level: int) -> str:
    """Level 0: a backslash before every run of backslashes and control string, each backslash doubled; level 1:
    a backslash before every backslash, ``#`` and ``<``."""
    if level:
        return STRICT.sub(r"\\\g<0>", text)
    return CONTROL.sub(lambda m: m[0].replace("\\", "\\\\").replace("###", "\\###").replace("</", "\\</"), text)


UNMARK = regex.compile(r"(?P<slashes>\\+)(?P<control>### (?:System|User|Assistant|Tool):|### Role |</turn>)")


def unescaped(text: str, level: int) -> str:
    if level:
        return regex.sub(r"\\([\\#<])", r"\1", text)

    def undo(m: regex.Match) -> str:
        if len(m["slashes"]) % 2 == 0:
            raise Unparsable(f"a control string stands unescaped at {m.start()}")
        return "\\" * (len(m["slashes"]) // 2) + m["control"]

    return UNMARK.sub(undo, text)


def role_name(role: str) -> str:
    return regex.sub(r"[\\#<:]|\n", lambda m: "\\n" if m[0] == "\n" else "\\" + m[0], role)


def render_turn(role: str, text: str, level: int = 0) -> str:
    header = HEADERS.get(role, f"{OTHER}{role_name(role)}:")
    return f"{header}{'!' if level else ''}\n{escaped(text, level)}\n{CLOSE}\n"


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the text inside ``rendered``) of each turn."""
    at = 0
    while at < len(rendered):
        m = GRAMMAR.match(rendered, at)
        if not m:
            raise Unparsable(f"no turn at {at}")
        name = m["other"]
        role = m["known"].lower() if name is None else regex.sub(
            r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], name
        )
        yield role, unescaped(m["text"], 1 if m["mode"] else 0), m.start("text"), m.end("text")
        at = m.end()


def checked_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and the bounds of its text, after reading it back."""
    for level in (0, 1):
        rendered = render_turn(role, text, level)
        try:
            turns = list(parse(rendered))
        except Unparsable:
            continue
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return rendered, *turns[0][2:]
    raise Unparsable("the turn does not survive its round trip")


def format_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", trained_role: str = "assistant",
) -> DataFrame:
    """(conv_id, turn, role, text, rendered, loss_start, loss_end): every turn of the formatted conversations.

    A conversation's text is its ``rendered`` turns in order; the loss mask covers the characters from ``loss_start`` to before
    ``loss_end`` of a turn (nothing when they are equal).
    """

    def rendered(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, starts, ends = [], [], []
        for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
            turn, start, end = checked_turn(role, text)
            texts.append(turn)
            starts.append(start)
            ends.append(end if role == trained_role else start)
        names = [*batch.schema.names, "rendered", "loss_start", "loss_end"]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
            names=names,
        )

    turns = conversations.select(
        quoted(conv_col).alias("conv_id"), quoted(turn_col).alias("turn"), text_of(role_col).alias("role"),
        text_of(text_col).alias("text"),
    )
    kind = {f.name: f.dataType.simpleString() for f in turns.schema.fields}
    schema = f"conv_id {kind['conv_id']}, turn {kind['turn']}, role string, text string, rendered string, " \
        "loss_start bigint, loss_end bigint"
    return turns.mapInArrow(by_batch(rendered), schema)


@dataclass
class Digest:
    """Running digests of one conversation as its rendered turns are read back."""

    conv_id: object
    turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    everything: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)

    def add(self, rendered: str, masked: bool) -> None:
        self.chars += len(rendered)
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.everything.update(f"{role}\n{text}\n".encode())
            if masked:
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.everything.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
        )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the rendered turns: turn count, digests of all turns and of the
    text under the loss mask, and the length of the formatted conversation.

    Turns stream through the task of their conversation in order, so no conversation is held in memory.
    """
    order = ["conv_id", "turn", "role", "text_key"]
    rows = formatted.select(
        "conv_id", "turn", "role", F.xxhash64("text").alias("text_key"), "rendered",
        (F.col("loss_end") > F.col("loss_start")).alias("masked"),
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.repartition("conv_id").sortWithinPartitions(*order)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Digest | None = None
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "rendered", "masked"))
            for conv_id, turn, masked in zip(*columns):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = Digest(conv_id)
                now.add(turn, masked)
            if done:
                yield as_batch(done)
        if now is not None:
            yield as_batch([now.row()])

    def as_batch(done: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(x, t) for x, t in zip(zip(*done), types)]
        return pa.RecordBatch.from_arrays(arrays, names=NAMES)

    types = [to_arrow_type(rows.schema["conv_id"].dataType), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return rows.mapInArrow(
        digested,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
