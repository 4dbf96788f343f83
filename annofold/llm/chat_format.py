"""Chat formatting: a state machine over roles and a declarative template.

A template gives each role an opening and a closing control string and says whether its text
counts for the loss, and which role may follow which. A conversation becomes segments of
text with a loss flag: control strings, and each turn's text with every control string and
escape sign inside it escaped, so that the output can be read back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings by role, the loss roles, and the turn order.

    Each control string starts with ``[`` or ``<`` and holds that sign nowhere else, so no
    end of a text and start of a control string can form another one.
    """

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
    )
    #: For any other role: before its name, between name and text, after the text.
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")
    loss_roles: frozenset[str] = frozenset({"assistant"})
    #: state -> roles that may come next; a state is the role before it, "" at the start.
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    final: frozenset[str] = frozenset({"user", "assistant"})

    @property
    def controls(self) -> list[str]:
        return sorted({m for pair in self.marks.values() for m in pair} | set(self.other))


class ChatFormatter:
    """Formats and reads back conversations under one template."""

    def __init__(self, template: ChatTemplate) -> None:
        self.template = template
        any_control = "|".join(re.escape(c) for c in template.controls)
        self._escapable = re.compile(rf"\\|{any_control}")
        self._control = re.compile(any_control)

    def escape(self, text: str) -> str:
        """A backslash is doubled; a control string gets one after its first sign."""
        return self._escapable.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def turn_order(self, roles: list[str]) -> bool:
        """Whether the state machine accepts this order of roles."""
        state = ""
        for role in roles:
            if role not in self.template.follows.get(state, ()):
                return False
            state = role
        return state in self.template.final

    def segments(self, turns: list[tuple[str, str]]) -> list[tuple[str, bool]]:
        """(text, loss) segments of (role, text) turns."""
        out: list[tuple[str, bool]] = []
        for role, text in turns:
            if role in self.template.marks:
                opening, closing = self.template.marks[role]
            else:
                before, between, closing = self.template.other
                opening = before + self.escape(role) + between
            out += [(opening, False), (self.escape(text), role in self.template.loss_roles), (closing, False)]
        return out

    def read_back(self, formatted: str) -> list[tuple[str, str]]:
        """The (role, text) turns of a formatted conversation."""
        by_opening = {opening: role for role, (opening, _) in self.template.marks.items()}
        turns: list[tuple[str, str]] = []
        role, start = "", 0
        for m in self._control.finditer(formatted):
            mark = m[0]
            if mark in by_opening:
                role, start = by_opening[mark], m.end()
            elif mark == self.template.other[0]:
                start = m.end()
            elif mark == self.template.other[1]:
                role, start = self.unescape(formatted[start : m.start()]), m.end()
            else:
                turns.append((role, self.unescape(formatted[start : m.start()])))
        return turns


_SEGMENT = pa.list_(pa.struct([pa.field("text", pa.string()), pa.field("loss", pa.bool_())]))


def format_chats(conversations: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """(conv_id, n_turns, valid_order, segments) from rows (conv_id, turn, role, text).

    Turns are ordered by turn, then role and text, which settles ties; equal rows stay as
    turns of their own; a null turn comes first; null role or text counts as empty; a role
    without marks is written by name. A conversation in an order that the state machine
    rejects is formatted too, and marked. A null conv_id is one conversation; an empty table
    gives none. Only the four columns are read. A conversation's turns meet in one row; no
    other rows do.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    whole = conversations.groupBy(F.col("conv_id").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    held = whole.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = ChatFormatter(template)
        for batch in it:
            roles, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            made = [
                [{"text": s, "loss": loss} for s, loss in formatter.segments(list(zip(r, t, strict=True)))]
                for r, t in zip(roles, texts, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(r) for r in roles], pa.int64()),
                    pa.array([formatter.turn_order(r) for r in roles], pa.bool_()),
                    pa.array(made, _SEGMENT),
                ],
                ["conv_id", "n_turns", "valid_order", "segments"],
            )

    kind = conversations.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, n_turns long, valid_order boolean, segments array<struct<text: string, loss: boolean>>"
    return held.mapInArrow(run, ddl)


def read_back_digests(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Digests of what can be read back from the segments of ``format_chats``."""
    import hashlib

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = ChatFormatter(template)
        for batch in it:
            rows = []
            for segments in batch.column(1).to_pylist():
                text = "".join(s["text"] for s in segments)
                turns = formatter.read_back(text)
                told = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(formatter.unescape(s["text"]) for s in segments if s["loss"])
                rows.append(
                    (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
                )
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), batch.column(2)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid_order"],
            )

    kind = formatted.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid_order boolean"
    return formatted.select("conv_id", "segments", "valid_order").mapInArrow(run, ddl)
