from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from annofold.llm.packing import pack_documents, pack_histogram, slots_by_length
from annofold.llm.queries import tokenizer_path


def brute_ids(texts, name="word_bpe_49k.json"):
    t = Tokenizer.from_file(tokenizer_path(name))
    return [np.array([*e.ids, 1], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(pieces, rows, capacity):
    ids = {doc: x for (doc, *_), x in zip(rows, brute_ids([r[1] for r in rows]), strict=True)}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids[doc])
            assert p["ids_crc32"] == zlib.crc32(ids[doc][at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids[doc])
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    assert set(by_sequence) == set(range(len(by_sequence)))
    return sum(len(x) for x in ids.values()) / (capacity * len(by_sequence))


@pytest.mark.parametrize("capacity", [64, 2048])
def test_every_id_lies_in_one_piece(spark, docs, capacity):
    pieces = pack_documents(docs, tokenizer_path(), capacity).collect()
    full = check(pieces, [tuple(r) for r in docs.collect()], capacity)
    if capacity == 64:  # enough sequences for padding to mean anything
        assert full > 0.97


def test_hostile_texts(spark):
    rng = random.Random(7)
    odd = ["<|endoftext|> a", "<|STARTOFTEXT|>", "don't stop.it's 3.5,6", "a.b.c", "naïve İstanbul ǅ ß", "​ x", "汉字 테스트", "a\r\nb\x0bc", "'s 'll", "... ,,", "😀👍🏽"]
    for _ in range(200):
        odd.append("".join(rng.choice("ab1.,'<|> \n\téİ -") for _ in range(rng.randrange(40))))
    rows = [(k, t) for k, t in enumerate(odd)]
    check(pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path(), 32).collect(), rows, 32)


def test_ids_empty_and_clashing(spark, docs, clashing):
    assert pack_documents(docs.limit(0), tokenizer_path()).count() == 0
    assert pack_documents(clashing, tokenizer_path()).count() == pack_documents(docs, tokenizer_path()).count()
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    got = pack_documents(twice, tokenizer_path(), with_ids=True).collect()
    assert len(got) == 3 and all(len(r["ids"]) == 4 * r["length"] for r in got)
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 3


def test_shortest_pack_first_places_every_length():
    rng = random.Random(2)
    for _ in range(50):
        histogram = {rng.randint(1, 50): rng.randint(1, 30) for _ in range(12)}
        patterns = pack_histogram(histogram, 50)
        assert all(sum(p) <= 50 for p, _ in patterns)
        for length, n in histogram.items():
            assert sum(p.count(length) * c for p, c in patterns) == n
        assert {k: int(sum(v[:, 0] * 0) + len(v)) > 0 for k, v in slots_by_length(patterns).items()} == {k: True for k in histogram}


def test_a_tokenizer_of_another_kind(spark):
    """One that keeps case and spaces is told apart and encodes whole texts."""
    rows = [(1, "The Same WORDS, again.  the same words"), (2, None), (3, "  a\nb. " * 400), (4, "Straße 3.14")]
    path = tokenizer_path("byte_bpe_50k.json")
    pieces = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), path, 128, with_ids=True).collect()
    for (doc, _), ids in zip(rows, brute_ids([t for _, t in rows], "byte_bpe_50k.json"), strict=True):
        own = sorted((p["start"], bytes(p["ids"])) for p in pieces if p["doc_id"] == doc)
        assert b"".join(b for _, b in own) == ids.tobytes()
