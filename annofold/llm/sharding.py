"""Shards of near-equal bytes by best-fit-decreasing bin packing of indivisible groups.

1. Equal texts are one group. Only a group larger than a shard's share is cut, into as few
   parts as fit a share, by a hash of doc_id. Where the largest and the smallest shard would
   then differ by more than 1 % of a share, groups above 1/2, 1/4, 1/8 and at last 1/16 of a
   share are cut too, as far as it takes; if nothing meets 1 %, the evenest placement is taken,
   and of equal ones that with fewer cuts. At most 16 groups per shard are ever cut.
2. The sizes of all parts become a histogram: exact up to 4 KB, above with 12 significant
   bits, so its rows are bounded (about 2,048 for each doubling). It alone reaches the driver.
3. Sizes are placed largest first; each part goes into the bin with the least room that
   still holds it, found in a balanced tree of the bins' room. All parts of one size that
   follow each other into one bin are placed at once. The smallest capacity, in steps of
   0.05 %, with which the bins do not exceed the shard count is taken.
4. Parts get a dense rank within their size and look their bin up; rows follow their part
   (those of groups above 1/16 of a share by a broadcast, so a large group meets in no task),
   and get a dense rank within their shard.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annofold.llm._shared import dense_rank_in, durable, row_mark

SHARDS = 8
#: Groups above this part of a share may be cut where whole ones leave the shards uneven.
PARTS_PER_SHARD = 16
#: Difference of the largest and the smallest shard, as a part of a share, that is even enough.
EVEN = 0.01


class RoomTree:
    """Treap of (room, bin); node = [room, bin, priority, left, right]."""

    def __init__(self) -> None:
        self._root: list | None = None

    def add(self, room: int, bin_: int) -> None:
        key = (room, bin_)
        low, high = self._split(self._root, key)
        node = [room, bin_, (bin_ * 2654435761 + room * 40503) & 0xFFFFFFFF, None, None]
        self._root = self._join(self._join(low, node), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (room, bin) with the least room of at least ``size``."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            self._root = low
            return None
        least = high
        while least[3] is not None:
            least = least[3]
        _, rest = self._split(high, (least[0], least[1] + 1))
        self._root = self._join(low, rest)
        return least[0], least[1]

    def _split(self, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        if node is None:
            return None, None
        if (node[0], node[1]) < key:
            low, high = self._split(node[4], key)
            node[4] = low
            return node, high
        low, high = self._split(node[3], key)
        node[3] = high
        return low, node

    def _join(self, low: list | None, high: list | None) -> list | None:
        if low is None or high is None:
            return low or high
        if low[2] > high[2]:
            low[4] = self._join(low[4], high)
            return low
        high[3] = self._join(low, high[3])
        return high


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int) -> tuple[int, dict[int, list[tuple[int, int]]]]:
    """(bins used, {size: [(first rank, bin)]}) for (size, count) pairs, none above capacity."""
    tree = RoomTree()
    bins = 0
    runs: dict[int, list[tuple[int, int]]] = {}
    for size, count in sorted(sizes, reverse=True):
        at = 0
        while at < count:
            found = tree.take_tightest(size)
            if found is None:
                found = capacity, bins
                bins += 1
            room, bin_ = found
            placed = min(count - at, room // size)
            runs.setdefault(size, []).append((at, bin_))
            at += placed
            if room > placed * size:
                tree.add(room - placed * size, bin_)
    return bins, runs


def fewest_even_bins(sizes: list[tuple[int, int]], shards: int) -> dict[int, list[tuple[int, int]]]:
    """Runs for the smallest capacity, in steps of 0.05 %, that needs at most ``shards`` bins."""
    total = sum(s * c for s, c in sizes)
    capacity = max([-(-total // shards), *(s for s, _ in sizes)])
    while True:
        bins, runs = best_fit_decreasing(sizes, capacity)
        if bins <= shards:
            return runs
        capacity += max(1, capacity // 2000)


def unevenness(sizes: list[tuple[int, int]], runs: dict[int, list[tuple[int, int]]], shards: int) -> float:
    """Largest less smallest bin of ``runs``, as a part of the mean."""
    load = [0] * shards
    for size, count in sizes:
        ends = [*(at for at, _ in runs[size][1:]), count]
        for (at, bin_), end in zip(runs[size], ends, strict=True):
            load[bin_] += size * (end - at)
    return (max(load) - min(load)) * shards / sum(load)


def _size_class(size: Column) -> Column:
    """``size`` up to 4096, above rounded up to 12 significant bits."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(size.cast("double"))) - 11, F.lit(0))).cast("long")
    return (F.ceil(size / step) * step).cast("long")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of ``docs`` (doc_id, text).

    size: UTF-8 bytes of the text plus 1. Null text counts as empty, and is in one group with
    empty texts; a text larger than a shard's share sets the capacity; rows that are equal in
    all stay in one part; slots are gapless from 0 in each shard; an empty table gives none.
    Only doc_id and text are read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = durable(
        docs.select(
            F.col("doc_id").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("g1"),
            F.xxhash64(F.lit("group"), text).alias("g2"),
        )
    )
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    share = max(1, -(-total // shards))
    least = max(1, -(-share // PARTS_PER_SHARD))
    groups = durable(
        rows.groupBy("g1", "g2")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("copies"))
        .withColumn("heavy", (F.col("bytes") > least) & (F.col("copies") > 1))
    )
    # At most shards * PARTS_PER_SHARD rows, by the definition of least.
    large = durable(groups.filter("heavy").select("g1", "g2", "bytes"))
    columns = ["g1", "g2", "part", "class", "heavy"]
    light = groups.filter("NOT heavy").select("g1", "g2", F.lit(0).cast("long").alias("part"), _size_class(F.col("bytes")).alias("class"), "heavy")
    counted = Counter({r["class"]: r["n"] for r in light.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()})

    def cut_above(limit: int) -> DataFrame:
        """The rows of large groups with their part."""
        cuts = large.select("g1", "g2", F.ceil(F.col("bytes") / limit).alias("cuts"))
        return rows.join(F.broadcast(cuts), ["g1", "g2"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("cuts")))

    def parts_of(cut: DataFrame) -> DataFrame:
        summed = cut.groupBy("g1", "g2", "part").agg(F.sum("size").alias("bytes"))
        return durable(summed.select("g1", "g2", "part", _size_class(F.col("bytes")).alias("class"), F.lit(True).alias("heavy")))

    any_large = not large.isEmpty()
    best = None
    pieces = 1
    while pieces <= PARTS_PER_SHARD:
        limit = max(1, -(-share // pieces))
        cut = cut_above(limit)
        heavy = parts_of(cut)
        sizes = counted + Counter(r["class"] for r in heavy.select("class").collect())
        histogram = list(sizes.items())
        placement = fewest_even_bins(histogram, shards) if histogram else {}
        uneven = unevenness(histogram, placement, shards) if histogram else 0.0
        if best is None or uneven < best[0]:
            best = uneven, cut, heavy, histogram, placement
        if uneven <= EVEN or not any_large:
            break
        pieces *= 2
    _, cut, heavy, histogram, placement = best
    parts = light.select(*columns).union(heavy.select(*columns))
    runs = {k: np.array(v, np.int64) for k, v in placement.items()}

    def look_up(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in it:
            shard = np.empty(len(some), np.int32)
            ranks = some["rank"].to_numpy()
            for size, at in some.groupby("class").indices.items():
                run = runs[size]
                shard[at] = run[np.searchsorted(run[:, 0], ranks[at], side="right") - 1, 1]
            yield some[["g1", "g2", "part", "heavy"]].assign(shard=shard)

    ranked = dense_rank_in(parts, ["class"], ["g1", "g2", "part"], sum(c for _, c in histogram), "rank")
    placed = durable(
        ranked.select("g1", "g2", "part", "class", "heavy", "rank").mapInPandas(
            look_up, "g1 long, g2 long, part long, heavy boolean, shard int"
        )
    )
    few = F.broadcast(placed.filter("heavy").select("g1", "g2", "part", "shard"))
    others = rows.join(F.broadcast(large.select("g1", "g2")), ["g1", "g2"], "left_anti")
    found = [cut.join(few, ["g1", "g2", "part"]), others.join(placed.filter("NOT heavy").select("g1", "g2", "shard"), ["g1", "g2"])]
    out = durable(reduce(DataFrame.union, [side.select("doc_id", "size", "text_crc32", "shard") for side in found]).withColumn("mark", row_mark()))
    return dense_rank_in(out, ["shard"], ["doc_id", "text_crc32", "size", "mark"], n, "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )
