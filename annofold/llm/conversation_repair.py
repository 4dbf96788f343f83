"""Conversation structure repair by dynamic programming over turns and grammar.

A conversation should read system?, then pairs of user and assistant, or be empty: role
initials ``(s?(ua)+)?``. Edits mend it at least cost; the grammar is a machine of four states.

1. Backward: the cost-to-go of every (row, state) is the least cost of edits that bring the
   rest of the conversation to an accepted end. Inserts stay at a row and are settled by
   relaxing twice, since a cycle of inserts only adds cost.
2. Forward: from the start state, among the edits whose cost and cost-to-go add up to that of
   the state, the one with the ASCII-least initial. Edits of one state have initials of their
   own and one next state each, so the walk spells the ASCII-least of all cheapest audits.
3. The audit is applied to the texts, and the repaired conversation is hashed turn by turn.

Two passes over rows sorted by (conversation, turn). The first carries no texts: a row is its
role's initial, its fault and a digest, so a conversation of any number of turns costs a task
some bytes a turn. The second brings audits and texts together and feeds a running hash: a task holds
one batch and one audit. A conversation's hash is one number over all its text, so one task
has to read that text in order; it never holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from annofold.llm._shared import batches, durable, tidy

# Fixed values of the contract: characters between words, ends of sentences, costs of edits.
BLANKS = r"\x20\x09-\x0D"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Faults of a row: none, no visible character, equal to an earlier row, no end of a sentence.
SOUND, BLANK, DUPLICATE, CUT = range(4)
START, SYSTEM, USER, ASSISTANT = range(4)
#: state -> role initial -> next state.
GRAMMAR = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ACCEPTED = (START, ASSISTANT)
#: Initials to which a row can be reroled, or of which one can be inserted.
MADE = {"u": "user", "a": "assistant"}
#: Pairs of neighbouring initials that the grammar knows.
LEGAL = {"su", "ua", "au"}
FAR = 1 << 60


def made_in(state: int) -> tuple[str, int]:
    """The one role initial that an edit can make in a state, and the state after it."""
    return next((i, to) for i, to in GRAMMAR[state].items() if i in MADE)


def _row_edits(initial: str, fault: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) of the edits that use up a row."""
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    extra = TRUNCATED if fault == CUT else 0
    if initial in GRAMMAR[state]:
        yield "K", KEEP + extra, GRAMMAR[state][initial]
    yield "R", REROLE + extra, made_in(state)[1]


_EDITS: dict[tuple[str, int], list[list[tuple[str, int, int]]]] = {}


def edits_of(initial: str, fault: int) -> list[list[tuple[str, int, int]]]:
    """By state, in ASCII order of the initials."""
    known = _EDITS.get((initial, fault))
    if known is None:
        known = _EDITS[initial, fault] = [sorted(_row_edits(initial, fault, state)) for state in range(4)]
    return known


def _with_inserts(own: list[int]) -> list[int]:
    """Costs-to-go of the states of one row, where inserts may come first."""
    to_go = list(own)
    for _ in range(2):
        for state in range(4):
            to_go[state] = min(to_go[state], INSERT + to_go[made_in(state)[1]])
    return to_go


def cheapest_audit(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, edits' initials) of the cheapest repair of rows (role initial, fault), ties ASCII-least."""
    to_go = [_with_inserts([0 if state in ACCEPTED else FAR for state in range(4)])]
    for initial, fault in reversed(rows):
        after = to_go[-1]
        to_go.append(_with_inserts([min(cost + after[to] for _, cost, to in edits) for edits in edits_of(initial, fault)]))
    to_go.reverse()
    at, state, audit = 0, START, []
    while at < len(rows) or to_go[at][state]:
        left = to_go[at][state]
        tight = {"I": (at, made_in(state)[1])} if INSERT + to_go[at][made_in(state)[1]] == left else {}
        if at < len(rows):
            tight |= {e: (at + 1, to) for e, cost, to in edits_of(*rows[at])[state] if cost + to_go[at + 1][to] == left}
        edit = min(tight)
        audit.append(edit)
        at, state = tight[edit]
    return to_go[0][START], "".join(audit)


class Repairer:
    """Applies an audit to rows that come one by one, and hashes what it leaves."""

    def __init__(self, audit: str) -> None:
        self._audit, self._at, self._state, self._any = audit, 0, START, False
        self._hash = hashlib.sha256()

    def _turn(self, role: str, text: str) -> tuple[str, str]:
        self._hash.update(f"{chr(10) * self._any}{role}:{text}".encode("utf-8", "surrogatepass"))
        self._any = True
        return role, text

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self._audit[self._at : self._at + 1] == "I":
            initial, self._state = made_in(self._state)
            self._at += 1
            yield self._turn(MADE[initial], "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The turns that stand in the place of a row, with those inserted before it."""
        yield from self._inserted()
        edit, self._at = self._audit[self._at], self._at + 1
        if edit == "K":
            self._state = GRAMMAR[self._state][role[:1]]
            yield self._turn(role, text)
        elif edit == "R":
            initial, self._state = made_in(self._state)
            yield self._turn(MADE[initial], text)

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()

    def digest(self) -> str:
        return self._hash.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text), damaged by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes ends of sentences, 3 repeats the row, 4 makes
    the role user; other rows stay. Null values are one space in the text that is hashed, and
    a null role or text becomes one space. conv_id and turn themselves stay null.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    held = conversations.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind")
    ).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return held.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("nth")).drop("nth")


#: Columns of an audit beside conv_id.
_NUMBERS = ("n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_AUDIT_DDL = ", ".join([*(f"{c} long" for c in _NUMBERS), "audit string"])


def _clean(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest); a null role or text counts as one space."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").cast("long").alias("turn"), value("role").alias("role"), value("text").alias("text")
    )
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def _by_conversation(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows) of rows sorted by their first column; a conversation's rows are to be read to their end."""
    rows = (row for batch in it for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    row = next(rows, None)

    def own(conv: object) -> Iterator[tuple]:
        nonlocal row
        while row is not None and row[0] == conv:
            yield row
            row = next(rows, None)

    while row is not None:
        yield row[0], own(row[0])


def _audited(conv: object, rows: Iterator[tuple]) -> tuple:
    """One audit from rows (conv_id, turn, initial, blank, cut, digest); those without a digest only name the conversation."""
    low = high = before = None
    distinct = illegal = 0
    seen: set[bytes] = set()
    states: list[tuple[str, int]] = []
    for _, turn, initial, blank, cut, digest in rows:
        if digest is None:
            continue
        states.append((initial, BLANK if blank else DUPLICATE if digest in seen else CUT if cut else SOUND))
        seen.add(digest)
        if turn is not None:
            low = turn if low is None else low
            distinct += turn != high
            high = turn
        illegal += before is not None and before + initial not in LEGAL
        before = initial
    cost, audit = cheapest_audit(states)
    faults = [fault for _, fault in states]
    counts = (faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT))
    return (conv, len(states), 0 if low is None else high - low + 1 - distinct, *counts, illegal, cost, audit)


def audit_conversations(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit), one row a conversation.

    ``conversations`` (conv_id, turn, role, text) in order of turn, nulls first; rows of one
    turn by role and digest, so that equal ones stand side by side. Each row counts with its
    first fault: blank, duplicate (role and text stood earlier), truncated. ``ids`` (conv_id)
    names further conversations, of which no row may be left: zeros and an empty audit. A null
    conv_id is one conversation. Texts stay behind: a row goes on as initial, fault and digest.
    """
    text = F.col("text")
    narrow = _clean(conversations).select(
        "conv_id",
        "turn",
        "role",
        F.substring("role", 1, 1).alias("initial"),
        (~text.rlike(f"[^{BLANKS}]")).alias("blank"),
        (~text.rlike(rf"[{ENDS}][{BLANKS}]*\z")).alias("cut"),
        "digest",
    )
    if ids is not None:
        names = ids.select(F.col("conv_id").alias("conv_id")).distinct()
        narrow = narrow.unionByName(names, allowMissingColumns=True)
    kind = conversations.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *((c, pa.int64()) for c in _NUMBERS), ("audit", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches((_audited(conv, own) for conv, own in _by_conversation(it)), schema, 2000)

    placed = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    chosen = placed.select("conv_id", "turn", "initial", "blank", "cut", "digest")
    return chosen.mapInArrow(tidy(run), f"conv_id {kind.simpleString()}, {_AUDIT_DDL}")


def _with_audits(conversations: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, role, text, audit): each conversation's audit in front of its rows."""
    order = ("conv_id", "is_row", "turn", "role", "digest")
    rows = _clean(conversations).withColumn("is_row", F.lit(True))
    heads = audits.select("conv_id", F.struct(*_NUMBERS, "audit").alias("audit"), F.lit(False).alias("is_row"))
    both = rows.unionByName(heads, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text", "audit")


def repaired_turns(conversations: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the turns that ``audits`` leave, numbered from 0."""
    kind = conversations.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def turns(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, own in _by_conversation(it):
            repairer = Repairer(next(own)[3]["audit"])
            made = (turn for row in own for turn in repairer.row(row[1], row[2]))
            at = -1
            for at, turn in enumerate(made):
                yield (conv, at, *turn)
            for at, turn in enumerate(repairer.end(), at + 1):
                yield (conv, at, *turn)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(turns(it), schema, 2000)

    return _with_audits(conversations, audits).mapInArrow(tidy(run), f"conv_id {kind.simpleString()}, position long, role string, text string")


def repair_conversations(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The columns of ``audit_conversations`` and repaired_sha256: SHA-256 of the repaired turns
    ``role:text``, joined by newlines (of the empty string where none is left).

    An empty table without ``ids`` gives no rows. Columns beside conv_id, turn, role and text are not read.
    """
    audits = durable(audit_conversations(conversations, ids))
    kind = conversations.schema["conv_id"].dataType
    numbers = [(c, pa.int64()) for c in _NUMBERS]
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *numbers, ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def digests(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, own in _by_conversation(it):
            head = next(own)[3]
            repairer = Repairer(head["audit"])
            for _, role, text, _ in own:
                for _ in repairer.row(role, text):
                    pass
            for _ in repairer.end():
                pass
            yield (conv, *head.values(), repairer.digest())

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(digests(it), schema, 2000)

    return _with_audits(conversations, audits).mapInArrow(tidy(run), f"conv_id {kind.simpleString()}, {_AUDIT_DDL}, repaired_sha256 string")
