from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from annofold.llm.conversation_repair import (
    BLANK,
    CUT,
    DUPLICATE,
    SOUND,
    audit_conversations,
    cheapest_audit,
    damaged,
    repair_conversations,
    repaired_turns,
)

DDL = "conv_id long, turn long, role string, text string"
NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute_audit(rows):
    """Every string of edits, the inserts at most two in a row, tried in turn: (cost, audit), least first."""
    best = None
    n = len(rows)
    for edits in itertools.product("DKR", repeat=n):
        if any(e != "D" and f in (BLANK, DUPLICATE) for e, (_, f) in zip(edits, rows, strict=True)):
            continue
        for counts in itertools.product(range(3), repeat=n + 1):
            audit = "".join("I" * c + e for c, e in zip(counts, [*edits, ""], strict=True))
            cost = sum({"D": 2, "K": 0, "R": 1, "I": 5}[e] for e in audit)
            cost += 5 * sum(e != "D" and f == CUT for e, (_, f) in zip(edits, rows, strict=True))
            if best is not None and (cost, audit) >= best:
                continue
            choices, left = [], iter(rows)
            for e in audit:
                initial = next(left)[0] if e != "I" else ""
                choices.append("ua" if e in "RI" else initial if e == "K" else None)
            choices = [c for c in choices if c is not None]
            if any(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in itertools.product(*choices)) and "" not in choices:
                best = (cost, audit)
    return best


def test_audits_against_all_strings_of_edits():
    rng = random.Random(5)
    kinds = [(i, f) for i in ["s", "u", "a", "x", ""] for f in (SOUND, BLANK, DUPLICATE, CUT)]
    for n in range(4):
        rows = list(itertools.product(kinds, repeat=n)) if n < 2 else [tuple(rng.choices(kinds, k=n)) for _ in range(120 if n == 2 else 60)]
        for r in rows:
            assert cheapest_audit(list(r)) == brute_audit(r), r
    plain = [(i, SOUND) for i in "sua"]
    for r in itertools.product(plain, repeat=4):
        assert cheapest_audit(list(r)) == brute_audit(r), r


def test_long_audit():
    cost, audit = cheapest_audit([("u", SOUND), ("a", SOUND)] * 100_000)
    assert (cost, audit) == (0, "K" * 200_000)


def brute(rows, do_damage=True):
    """The contract on lists, row by row."""
    after, ids = [], {r[0] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if do_damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv in ids:
        own = [r for r in after if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        seen, states = set(), []
        for _, _, role, text in own:
            shown = re.sub("[\x20\x09-\x0d]", "", text)
            states.append((role[:1], BLANK if not shown else DUPLICATE if (role, text) in seen else CUT if shown[-1] not in ".!?" else SOUND))
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit = cheapest_audit(states)
        left, said, grammar = iter(own), [], ""
        for e in audit:
            row = next(left) if e != "I" else None
            if e == "D":
                continue
            role = row[2] if e == "K" else "assistant" if grammar[-1:] == "u" else "user"
            said.append(f"{role}:{row[3] if row else ''}")
            grammar += role[0]
        assert re.fullmatch("(s?(ua)+)?", grammar)
        faults = [f for _, f in states]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(states))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=repr)


def table(seed=1, n=400):
    rng = random.Random(seed)
    texts = [None, "", " ", "\x0b\n", "Hi.", "Hi. ", "no end", "Why?\n", "é!", "\x1c", "a\nb.", "x" * 5000 + "."]
    rows = []
    for k in range(n):
        for turn in range(rng.choice([1, 2, 3, 4, 8])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", None, "", "tool", "ux"])
            rows.append((k if k % 29 else None, rng.choice([turn, turn, turn * 2, None, -turn]), role, rng.choice(texts)))
    return rows + rows[:20]


@pytest.mark.parametrize("seed", [1, 2])
def test_query_s_path_against_the_contract(spark, seed):
    rows = table(seed)
    frame = spark.createDataFrame(rows, DDL).repartition(5)
    got = repair_conversations(damaged(frame), frame.select("conv_id"))
    assert sorted((tuple(r) for r in got.select("conv_id", *NUMBERS).collect()), key=repr) == brute(rows)


def test_plain_rows_and_turns(spark):
    rows = table(3, 60)
    frame = spark.createDataFrame(rows, DDL)
    got = repair_conversations(frame)
    want = brute(rows, do_damage=False)
    assert sorted((tuple(r) for r in got.select("conv_id", *NUMBERS).collect()), key=repr) == want
    turns = repaired_turns(frame, audit_conversations(frame)).orderBy("conv_id", "position").collect()
    by = {}
    for r in turns:
        assert len(by.setdefault(r.conv_id, [])) == r.position
        by[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(by.get(w[0], [])).encode()).hexdigest() == w[-1] for w in want)


def test_one_long_conversation(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], f"turn {k}" + "." * (k % 7 != 0)) for k in range(20_000)] + [(2, 0, "user", "a?")]
    frame = spark.createDataFrame(rows, DDL).repartition(6)
    got = repair_conversations(damaged(frame), frame.select("conv_id"))
    assert sorted((tuple(r) for r in got.select("conv_id", *NUMBERS).collect()), key=repr) == brute(rows)


def test_clashing_names_and_empty(spark):
    rows = table(4, 40)
    more = spark.createDataFrame(rows, DDL).withColumns({k: F.lit("x") for k in ("kind", "nth", "digest", "audit", "is_row", "cut", "initial", "again")})
    got = repair_conversations(damaged(more), more.select("conv_id", "kind"))
    assert sorted((tuple(r) for r in got.select("conv_id", *NUMBERS).collect()), key=repr) == brute(rows)
    assert repair_conversations(damaged(more.limit(0)), more.select("conv_id").limit(0)).count() == 0
    nothing = repair_conversations(more.limit(0), more.filter("conv_id = 3").select("conv_id")).collect()
    assert [tuple(r) for r in nothing] == [(3, 0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
