from __future__ import annotations

import random
import zlib

from annofold.llm.sharding import RoomTree, best_fit_decreasing, shard_by_bytes


def test_tree_finds_the_tightest_bin():
    rng = random.Random(4)
    tree, rooms = RoomTree(), []
    for k in range(400):
        if rooms and rng.random() < 0.5:
            size = rng.randint(1, 60)
            fits = [r for r in rooms if r[0] >= size]
            want = min(fits) if fits else None
            assert tree.take_tightest(size) == want
            if want:
                rooms.remove(want)
        else:
            rooms.append((rng.randint(1, 60), k))
            tree.add(*rooms[-1])


def test_equals_plain_best_fit():
    rng = random.Random(6)
    for _ in range(40):
        sizes = [(s, rng.randint(1, 6)) for s in rng.sample(range(1, 50), 8)]
        bins, runs = best_fit_decreasing(sizes, 60)
        rooms = []
        for size, count in sorted(sizes, reverse=True):
            for _ in range(count):
                fits = [(r, k) for k, r in enumerate(rooms) if r >= size]
                if fits:
                    rooms[min(fits)[1]] -= size
                else:
                    rooms.append(60 - size)
        assert bins == len(rooms)
        load = [0] * bins
        for size, count in sizes:
            at = [*(a for a, _ in runs[size]), count]
            for (first, b), end in zip(runs[size], at[1:], strict=True):
                load[b] += size * (end - first)
        assert max(load) <= 60 and sorted(60 - x for x in load) == sorted(rooms)


def test_shards(spark, docs, clashing):
    rng = random.Random(9)
    rows = [(k, f"{k % 1500} " + "x" * (k % 1500 * 7 % 400)) for k in range(3000)] + [(5000 + k, "same text here") for k in range(700)] + [(9000, None), (9001, ""), (9001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = shard_by_bytes(df).collect()
    assert len(got) == len(rows)
    total, slots, groups = {}, {}, {}
    text = dict(rows)
    for r in got:
        t = text[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode())
        total[r["shard"]] = total.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        groups.setdefault(t, set()).add(r["shard"])
    assert set(total) == set(range(8)) and max(total.values()) - min(total.values()) < 0.01 * sum(total.values()) / 8
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for t, v in groups.items() if t != "same text here")
    assert shard_by_bytes(df.limit(0)).count() == 0
    assert shard_by_bytes(clashing).count() == docs.count()


def shards_of_texts(spark, rows):
    """({text: shards}, {shard: bytes}) for (doc_id, text) rows with distinct ids."""
    text, shards, total = dict(rows), {}, {}
    for r in shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        shards.setdefault(text[r["doc_id"]], set()).add(r["shard"])
        total[r["shard"]] = total.get(r["shard"], 0) + r["size"]
    assert sum(total.values()) == sum(len(t.encode()) + 1 for _, t in rows)
    return shards, total


def test_groups_up_to_a_share_stay_whole(spark):
    """Groups of 10 to 95 % of a share, more than one bin of them in all, beside small texts."""
    sizes = [95, 80, 60, 50, 40, 30, 20, 10, 10]
    texts = [f"{k} ".ljust(99, "x") for k in range(len(sizes))]
    rows = [t for t, s in zip(texts, sizes, strict=True) for _ in range(s * 5)]
    rows += [f"own {k} ".ljust(99, "y") for k in range(500 * 8 - len(rows))]
    shards, total = shards_of_texts(spark, list(enumerate(rows)))
    assert all(len(v) == 1 for v in shards.values())
    assert len(total) == 8 and max(total.values()) - min(total.values()) <= 0.01 * sum(total.values()) / 8


def test_larger_groups_are_cut_as_little_as_balance_allows(spark):
    big, half = "big ".ljust(99, "x"), "half ".ljust(99, "x")
    rows = [big] * 1150 + [half] * 250
    rows += [f"own {k} ".ljust(99, "y") for k in range(500 * 8 - len(rows))]
    shards, total = shards_of_texts(spark, list(enumerate(rows)))
    assert 2 <= len(shards[big]) <= 3 and all(len(v) == 1 for t, v in shards.items() if t != big)
    assert max(total.values()) - min(total.values()) <= 0.01 * sum(total.values()) / 8
    # Ten equal groups of 0.8 shares do not fit eight shards whole: some have to be cut.
    rows = [f"{k} ".ljust(99, "x") for k in range(10) for _ in range(400)]
    shards, total = shards_of_texts(spark, list(enumerate(rows)))
    assert len(total) == 8 and max(total.values()) < 1.3 * sum(total.values()) / 8
