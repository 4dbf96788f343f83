"""Small hostile tables that the tests of this folder share."""

from __future__ import annotations

import random

WORDS = [f"w{k}" for k in range(400)]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng: random.Random, text: str, changes: int) -> str:
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def documents(seed: int = 1, families: int = 6, members: int = 8) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): exact and near copies, shared passages, and odd texts."""
    rng = random.Random(seed)
    passage = prose(rng, 40)
    texts: list[str | None] = [None, "", " \n\t ", "one", "a b c d e", "A B c d E", "é" * 30, "x|y|z|# $ %", "word " * 3000]
    for _ in range(families):
        base = prose(rng, rng.choice([6, 30, 80, 300]))
        for k in range(members):
            texts.append(edited(rng, base, rng.choice([0, 0, 1, 2, k])))
    texts += [prose(rng, 20) + "\n" + passage + ".\n" + prose(rng, 15) for _ in range(12)]
    texts += [passage + " " + prose(rng, 8) for _ in range(10)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(k, texts[at], "en", f"s{k % 11}" if k % 13 else None, len(texts[at] or "")) for k, at in enumerate(order)]


DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"
