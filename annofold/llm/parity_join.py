"""N-gram Jaccard join with parity sketches.

A text's set is its distinct 5-word shingles, as 64-bit hashes. Sets are linked when their
Jaccard similarity is at least ``PERCENT`` / 100; then the symmetric difference of sets of a
and b shingles is at most T = (a + b) * (100 - PERCENT) // (100 + PERCENT).

* Sketch: per size band, a sparse bit sketch of P blocks of 2^32 bits or more. A shingle
  flips one bit. Bits differ only where the sets do, so the Hamming distance, and the number
  of blocks that differ, are at most the symmetric difference. A block is kept as the XOR of
  its flipped positions' hashes.
* Pigeonhole: of P blocks at most T differ. Under an order on (block, content) that both
  sides follow, their first T + 1 blocks have one in common. The order takes full blocks
  before empty ones, blocks with some uncommon shingle first, and those with most shingles
  before others, so that what is shared is rarely shared by chance. Common shingles are found by
  local counts over all texts; they touch only the order, never the result.
* Position: when the first common block stands at place p of the order, p blocks differ; so
  a meeting counts only at places up to T of the two sizes, and a set writes no block beyond
  the T of its size and the largest partner it can have.
* A pair is joined in the band of its smaller set; a set that may be the larger one also
  writes blocks for the band below. Sets of under ``SMALL`` shingles have a block for each.
* Equal sets are one class, joined once. In a block's group every member is paired with the
  group's smallest document only; each document keeps its likeliest such pair, verified
  exactly. A verified pair makes a family, with the exact distance to its centre. Groups that
  still hold several components go on: two families are compared by their centres, and by
  the triangle inequality only those near enough are opened into pairs of members, verified
  exactly. So copies are never expanded into all pairs and no link between different texts
  is lost.
* Two families that share many large groups are paired in the first one: each carries its
  smallest keys, so a group can tell that an earlier one has both.
* In a group of more than ``LARGE`` families, and among the opened members, each side carries a
  short parity sketch of all its shingles: a pair whose sketches differ in more bits than the
  sets may is dropped inside the join, before it is a row.
* Verification intersects the shingle hashes. Pairs are first compared by their sketches, so only sets that
  these do not tell apart are moved.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annofold.llm._shared import broadcast_if_small, durable, tidy, utf8_column
from annofold.llm.components import components

WORDS = 5
PERCENT = 75
SMALL = 32
#: A shingle is common when at least this share of the texts has it.
COMMON = 0.0005
#: Texts at most among which shingles are counted at once, before the counts are summed.
COUNTED = 10_000
#: 64-bit words of the short parity sketch that documents of large groups carry.
SKETCH_WORDS = 8
#: Families in a block's group above which they carry it.
LARGE = 16
#: Smallest keys of a family by which groups tell that they are not the first to pair it with another.
FIRST_KEYS = 4
_MASK = (1 << 64) - 1


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Odd factors without linear relations: one for each place in a shingle, one for its length.
_STEPS = _mix(np.arange(1, WORDS + 2, dtype=np.uint64)) | np.uint64(1)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(n, WORDS)
    total = np.full(n - k + 1, int(_STEPS[WORDS]) * k & _MASK, np.uint64)
    for j in range(k):
        total += h[j : n - k + 1 + j] * _STEPS[j]
    return np.unique(_mix(total))


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """``SKETCH_WORDS`` words; a shingle flips one bit, so sketches differ in at most as many bits as sets."""
    bits = SKETCH_WORDS * 64
    flips = np.bincount((_mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64), minlength=bits) % 2
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


class Bands:
    """Size bands with a ratio of 1 / similarity: a partner is in the same band or a neighbour."""

    def __init__(self, percent: int = PERCENT) -> None:
        self.percent = percent
        self._lows = [0, SMALL]

    def at_least(self, n: int) -> int:
        """The smallest size that can be similar to size n."""
        return -(-n * self.percent // 100)

    def _grow(self, n: int) -> None:
        while self._lows[-1] <= n:
            self._lows.append(-(-self._lows[-1] * 100 // self.percent))

    def of(self, n: int) -> list[int]:
        """The bands in which a set of size n takes part: its own, and the one below if a partner can be there."""
        self._grow(n)
        own = bisect_right(self._lows, n) - 1
        return [own, own - 1] if own and self.at_least(n) < self._lows[own] else [own]

    def blocks(self, band: int) -> int:
        """Blocks of a band above the first: enough that few sets have to write empty ones."""
        self._grow(max(self._lows[band : band + 1], default=self._lows[-1]))
        while len(self._lows) <= band + 1:
            self._grow(self._lows[-1])
        return (3 * (self.differ(self._lows[band + 1] - 1, None) + 1)) // 2 + 24

    def differ(self, n: int, most: int | None) -> int:
        """The most by which a set of size n differs from a similar one of at most ``most``."""
        partner = n * 100 // self.percent
        if most is not None:
            partner = min(partner, most)
        return (n + partner) * (100 - self.percent) // (100 + self.percent)

    def written(self, n: int, band: int) -> int:
        """Blocks that a set of size n writes in a band above the first."""
        own = bisect_right(self._lows, n) - 1
        return self.differ(n, None if band == own else self._lows[own] - 1) + 1


def block_keys(shingles: np.ndarray, common: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the blocks by which this set meets every set that may be similar, and their
    places in the order (0 for all in the first band)."""
    n = len(shingles)
    if common.size:
        at = np.searchsorted(common, shingles)
        frequent = common[np.minimum(at, common.size - 1)] == shingles
    else:
        frequent = np.zeros(n, bool)
    positions = _mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    out, places = [], []
    for band in bands.of(n):
        salt = np.uint64((band + 1) * 0xD6E8FEB86659FD93 & _MASK)
        if band == 0:
            keys = _mix(positions + salt)
            rank = (keys >> np.uint64(24)) + (frequent.astype(np.uint64) << np.uint64(42))
            need = n - bands.at_least(n) + 1
        else:
            parts, need = bands.blocks(band), bands.written(n, band)
            block = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
            size = np.diff(np.append(first, n))
            content = np.bitwise_xor.reduceat(positions, first)
            every = np.logical_and.reduceat(frequent, first)
            ids = block[first]
            keys = _mix(content + _mix(ids * np.uint64(2) + salt))
            few = (np.uint64(255) - np.minimum(size, 255).astype(np.uint64)) << np.uint64(34)
            rank = (keys >> np.uint64(31)) + few + (every.astype(np.uint64) << np.uint64(43))
            if len(keys) < need:
                empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), ids, assume_unique=True)
                more = _mix(_mix(empty * np.uint64(2) + salt) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
                rank = np.concatenate((rank, (more >> np.uint64(31)) + np.uint64(1 << 44)))
                keys = np.concatenate((keys, more))
        chosen = np.argsort(rank, kind="stable")[:need]
        out.append(keys[chosen])
        places.append(np.arange(len(chosen), dtype=np.int32) if band else np.zeros(len(chosen), np.int32))
    return np.concatenate(out).view(np.int64), np.concatenate(places)


def _features(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: (doc_id, row, n, set_key) for each text; (shingle, n) for each shingle
    that is common among the texts of one slice of a batch."""
    names = ["doc_id", "row", "n", "set_key", "shingle"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            m = batch.num_rows
            sets = [shingle_set(t) for t in utf8_column(batch, 2)]
            marks = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            sizes = [len(s) for s in sets]
            empty = [pa.nulls(m, t) for t in types]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), empty[4]], names
            )
            one = {k: s for k, s in zip(marks, sets, strict=True)}
            values, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *one.values()]), return_counts=True)
            often = counts >= max(3, COMMON * len(one))
            k = int(often.sum())
            nothing = [pa.nulls(k, t) for t in types]
            found, times = pa.array(values[often].view(np.int64)), pa.array(counts[often], pa.int64())
            yield pa.RecordBatch.from_arrays([nothing[0], nothing[1], times, nothing[3], found], names)

    return docs.mapInArrow(tidy(run, COUNTED), "doc_id long, row long, n long, set_key binary, shingle long")


def _keys(texts: DataFrame, common: np.ndarray, percent: int) -> DataFrame:
    """(key, doc, n, place) of all blocks that the sets of ``texts`` (doc, text) write."""
    held = texts.sparkSession.sparkContext.broadcast(common)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in it:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                sets = [shingle_set(t) for t in utf8_column(some, 1)]
                made = [block_keys(s, held.value, bands) for s in sets]
                times = [len(k) for k, _ in made]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([k for k, _ in made])),
                        pa.array(np.repeat(some.column(0).to_numpy(), times)),
                        pa.array(np.repeat(np.array([len(s) for s in sets], np.int32), times)),
                        pa.array(np.concatenate([p for _, p in made])),
                    ],
                    ["key", "doc", "n", "place"],
                )

    return texts.mapInArrow(tidy(run), "key long, doc long, n int, place int")


def _met(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, doc): each later row of a key with the key's first document."""
    last: list[np.ndarray] | None = None
    for batch in it:
        rows = [batch.column(k).to_numpy() for k in range(4)]
        key = rows[0]
        if not len(key):
            continue
        new = np.concatenate(([last is None or key[0] != last[0][-1]], key[1:] != key[:-1]))
        group = np.cumsum(new) - new[0]
        firsts = [column[new] for column in rows]
        if not new[0]:
            firsts = [np.append(old[-1:], column) for old, column in zip(last, firsts, strict=True)]
        later = ~new
        out = [column[later] for column in rows] + [column[group[later]] for column in firsts[1:]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["key", "doc", "n", "place", "pivot", "pivot_n", "pivot_place"])
        last = [column[-1:] for column in firsts]


_SKETCH = [f"s{k}" for k in range(SKETCH_WORDS)]


def _set_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, n, h, s0, s1, ...) from (doc, text): size, shingle hashes and sketch."""
    for batch in it:
        sets = [shingle_set(t) for t in utf8_column(batch, 1)]
        words = np.array([parity_sketch(s) for s in sets], np.int64).reshape(len(sets), SKETCH_WORDS)
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        hashes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(ends).astype(np.int64)), hashes, *(pa.array(words[:, k]) for k in range(SKETCH_WORDS))],
            ["doc", "n", "h", *_SKETCH],
        )


def _sketches_within(one: str, two: str, most: Column) -> Column:
    """The sketches of two sides differ in at most ``most`` bits."""
    bits = [F.bit_count(F.col(f"{one}.{s}").bitwiseXOR(F.col(f"{two}.{s}"))) for s in _SKETCH]
    return reduce(lambda a, b: a + b, bits) <= most


def _differ(a: Column, b: Column, percent: int) -> Column:
    return F.floor((a + b) * (100 - percent) / (100 + percent))


def _may_link(a: Column, b: Column, place_a: Column, place_b: Column, percent: int) -> Column:
    """Sizes are near enough, and the meeting is early enough in the order."""
    near = F.greatest(a, b) * percent <= F.least(a, b) * 100
    return near & (F.greatest(place_a, place_b) <= _differ(a, b, percent))


def _near_by_sketch(pairs: DataFrame, sets: DataFrame, most: Column) -> DataFrame:
    """Of ``pairs`` (x, y, ...) those whose sketches differ in at most ``most`` bits, of their columns and one.n, two.n.

    Sets that differ in at most that many shingles are never lost; and of the pairs that go only sketches were moved.
    """
    sketches = sets.select("doc", "n", *_SKETCH)
    met = pairs.join(sketches.alias("one"), F.col("x") == F.col("one.doc")).join(sketches.alias("two"), F.col("y") == F.col("two.doc"))
    return met.filter(_sketches_within("one", "two", most)).select(*pairs.columns).distinct()


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(x, y, a, b, shared) of ``pairs`` (x, y), exactly. Few pairs go to the sets, not the sets to them; of these only those named move."""
    pairs = broadcast_if_small(pairs)
    named = broadcast_if_small(pairs.select("y").distinct())
    left = sets.select(F.col("doc").alias("x"), F.col("h").alias("hx"))
    right = sets.select(F.col("doc").alias("y"), F.col("h").alias("hy")).join(named, "y", "left_semi")
    # Pair by pair in the JVM: a batch of rows with two very long sets each would not fit a Python worker.
    return pairs.join(left, "x").join(right, "y").select(
        "x",
        "y",
        F.size("hx").cast("long").alias("a"),
        F.size("hy").cast("long").alias("b"),
        F.size(F.array_intersect("hx", "hy")).cast("long").alias("shared"),
    )


def _linked(percent: int) -> Column:
    return F.col("shared") * 100 >= (F.col("a") + F.col("b") - F.col("shared")) * percent


def _with_first_keys(families: DataFrame) -> DataFrame:
    """Families of large groups, with what holds for a family in all of its groups, and its first keys.

    Near copies share hundreds of keys, and two families would be paired in each of them. With
    bounds that are the same in every group, and the ``FIRST_KEYS`` smallest keys of both at
    hand, a group can tell that an earlier one pairs them (``_not_met_before``).
    """
    order = Window.partitionBy("centre").orderBy("key")
    first = families.select("centre", "key").withColumn("at", F.row_number().over(order)).filter(F.col("at") <= FIRST_KEYS)
    first = first.groupBy(F.col("centre").alias("f_centre")).agg(F.collect_list("key").alias("first_keys"))
    spans = families.groupBy(F.col("centre").alias("s_centre")).agg(
        F.max("radius").alias("radius"), F.min("least").alias("least"), F.max("most").alias("most"), F.min("place").alias("place")
    )
    of_family = broadcast_if_small(spans.join(first, F.col("s_centre") == F.col("f_centre")).drop("f_centre"))
    return families.select("key", "component", "centre").join(of_family, F.col("centre") == F.col("s_centre")).drop("s_centre")


def _not_met_before() -> Column:
    """No earlier key is among the first ones of both sides; so the first common key of two families always pairs them."""
    both = F.array_intersect(F.col("one.first_keys"), F.col("two.first_keys"))
    return F.coalesce(F.array_min(both) >= F.col("one.key"), F.lit(True))


def similarity_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) for each row of ``docs`` (doc_id, text).

    class_id is the smallest doc_id with an equal set, component_id the smallest one that
    links reach. Null and empty texts, and texts without words, have an empty set, and are
    their own class and component; so are rows without a doc_id (null ids). Rows that share a
    doc_id with different texts are joined by either text. An empty table gives none; only
    doc_id and text are read. Long texts are read whole.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = chosen.select("doc_id", F.xxhash64("text").alias("row"), "text")
    features = durable(_features(texts))
    rows = features.filter("set_key IS NOT NULL").select("doc_id", "row", "n", "set_key")
    classes = durable(
        rows.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "row", "n")).alias("first"))
        .select("set_key", F.col("first.doc_id").alias("doc"), F.col("first.row").alias("row"), F.col("first.n").alias("n"))
    )
    total = classes.count()
    # At most (mean size of a set) / COMMON shingles, whatever the number of texts.
    common = (
        features.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(16, COMMON * total))
    ).select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    common = np.sort(common.view(np.uint64))

    own = classes.select(F.col("doc").alias("c_doc"), F.col("row").alias("c_row"))
    is_own = (F.col("doc_id") == F.col("c_doc")) & (F.col("row") == F.col("c_row"))
    # Copies are few beside the texts, and texts without words write no keys: so texts stay where they are.
    copies = rows.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "row").join(own, is_own, "left_anti").distinct()
    copies = broadcast_if_small(copies.select(F.col("doc_id").alias("o_doc"), F.col("row").alias("o_row")))
    is_copy = (F.col("doc_id") == F.col("o_doc")) & (F.col("row") == F.col("o_row"))
    firsts = texts.filter("doc_id IS NOT NULL").join(copies, is_copy, "left_anti").select(F.col("doc_id").alias("doc"), "text")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = _keys(firsts, common, percent).repartition(parts, "key").sortWithinPartitions("key", "doc")
    met_type = "key long, doc long, n int, place int, pivot long, pivot_n int, pivot_place int"
    met = durable(keys.mapInArrow(_met, met_type).filter("doc != pivot"))

    # First round: each document with the pivot it meets most often.
    may = _may_link(F.col("n"), F.col("pivot_n"), F.col("place"), F.col("pivot_place"), percent)
    stars = met.filter(may).groupBy("doc", "pivot").agg(F.count(F.lit(1)).alias("times"))
    best = stars.groupBy("doc").agg(F.max_by("pivot", F.struct("times", -F.col("pivot"))).alias("pivot"))
    inside = met.select("doc").union(met.select("pivot")).distinct()
    own_inside = broadcast_if_small(own.join(inside, F.col("c_doc") == F.col("doc"), "left_semi"))
    sets = durable(
        texts.join(own_inside, is_own, "left_semi")
        .select(F.col("doc_id").alias("doc"), "text")
        .mapInArrow(tidy(_set_batches, 200), ", ".join(["doc long, n long, h array<long>", *(f"{s} long" for s in _SKETCH)]))
    )
    apart = F.col("a") + F.col("b") - 2 * F.col("shared")
    starts = _near_by_sketch(best.select(F.col("doc").alias("x"), F.col("pivot").alias("y")), sets, _differ(F.col("one.n"), F.col("two.n"), percent))
    family = durable(
        _measured(starts, sets)
        .filter(_linked(percent))
        .select(F.col("x").alias("doc"), F.col("y").alias("centre"), apart.alias("radius"))
    )
    edges = family.select(F.col("doc").alias("u"), F.col("centre").alias("v"))
    near = components(edges)

    # Second round: groups that still hold several components.
    pivots = met.select("key", F.col("pivot").alias("doc"), F.col("pivot_n").alias("n"), F.col("pivot_place").alias("place"))
    members = met.select("key", "doc", "n", "place").union(pivots.distinct())
    placed = (
        members.join(near, members.doc == near.node, "left")
        .join(family.select(F.col("doc").alias("f_doc"), "centre", "radius"), F.col("doc") == F.col("f_doc"), "left")
        .select(
            "key",
            "doc",
            "n",
            "place",
            F.coalesce("component", "doc").alias("component"),
            F.coalesce("centre", "doc").alias("centre"),
            F.coalesce("radius", F.lit(0)).alias("radius"),
        )
    )
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi")
    open_groups = durable(placed.join(mixed.select("key"), "key", "left_semi"))
    by_family = open_groups.groupBy("key", "component", "centre").agg(
        F.max("radius").alias("radius"), F.min("n").alias("least"), F.max("n").alias("most"), F.min("place").alias("place")
    )
    large_keys = durable(by_family.groupBy("key").agg(F.count(F.lit(1)).alias("families")).filter(F.col("families") > LARGE).select("key"))
    sketches = sets.select("doc", *_SKETCH)
    small = by_family.join(large_keys, "key", "left_anti")
    large = _with_first_keys(durable(by_family.join(large_keys, "key", "left_semi"))).join(sketches, F.col("centre") == F.col("doc")).drop("doc")
    most_apart = _differ(F.col("one.most"), F.col("two.most"), percent)
    can_meet = (
        (F.col("one.key") == F.col("two.key"))
        & (F.col("one.centre") < F.col("two.centre"))
        & (F.col("one.component") != F.col("two.component"))
        & (F.greatest("one.least", "two.least") * percent <= F.least("one.most", "two.most") * 100)
        & (F.greatest("one.place", "two.place") <= most_apart)
    )
    # Triangle: centres differ by at most the radii and what their members may differ by.
    sketched = can_meet & _sketches_within("one", "two", F.col("one.radius") + F.col("two.radius") + most_apart) & _not_met_before()
    found = [
        side.alias("one")
        .join(side.alias("two"), condition)
        .select(
            F.col("one.centre").alias("x"),
            F.col("two.centre").alias("y"),
            F.col("one.radius").alias("rx"),
            F.col("two.radius").alias("ry"),
            F.col("one.most").alias("mx"),
            F.col("two.most").alias("my"),
        )
        for side, condition in ((small, can_meet), (durable(large), sketched))
    ]
    wide = found[0].union(found[1]).groupBy("x", "y").agg(*(F.max(c).alias(c) for c in ("rx", "ry", "mx", "my")))
    # No link of the centres, nor of members by the triangle inequality, is beyond this.
    within_reach = F.col("rx") + F.col("ry") + _differ(F.greatest("mx", "one.n"), F.greatest("my", "two.n"), percent)
    wide = durable(_near_by_sketch(wide, sets, within_reach))
    centres = durable(_measured(wide.select("x", "y"), sets))
    linked_centres = centres.filter(_linked(percent)).select(F.col("x").alias("u"), F.col("y").alias("v"))
    far = F.col("apart") > F.col("rx") + F.col("ry") + _differ(F.col("mx"), F.col("my"), percent)
    unlinked = wide.join(centres.withColumn("apart", apart), ["x", "y"]).filter(~far & ~_linked(percent) & (F.col("rx") + F.col("ry") > 0))
    close = durable(
        unlinked.join(sketches, F.col("y") == F.col("doc")).select(
            F.col("x").alias("cx"), F.col("y").alias("cy"), "apart", "ry", "my", *_SKETCH
        )
    )
    # Members of two near families are compared inside the joins: first those of one with the
    # centre of the other, then with its members. By the triangle inequality x and a member of
    # the other family differ by at least |x - cy| - ry.
    alone = close.select(F.col("cx").alias("doc")).union(close.select("cy")).distinct()
    own_family = family.select("doc", "centre", "radius").union(alone.select("doc", F.col("doc").alias("centre"), F.lit(0).cast("long")))
    members = durable(own_family.join(sets.select("doc", "n", *_SKETCH), "doc"))
    p, q, c = members.alias("p"), members.alias("q"), close.alias("c")
    reach = F.col("c.ry") + _differ(F.col("p.n"), F.greatest("p.n", "c.my"), percent)
    near_centre = (
        (F.col("p.centre") == F.col("c.cx")) & (F.col("c.apart") <= F.col("p.radius") + reach) & _sketches_within("p", "c", reach)
    )
    may_differ = _differ(F.col("p.n"), F.col("q.n"), percent)
    sizes = F.greatest("p.n", "q.n") * percent <= F.least("p.n", "q.n") * 100
    within = F.col("apart") <= F.col("p.radius") + F.col("q.radius") + may_differ
    member_pairs = (
        p.join(c, near_centre)
        .select(*(F.col(f"p.{k}").alias(k) for k in ("doc", "n", "radius", *_SKETCH)), "cy", "apart")
        .alias("p")
        .join(q, (F.col("p.cy") == F.col("q.centre")) & sizes & within & _sketches_within("p", "q", may_differ))
        .select(F.col("p.doc").alias("x"), F.col("q.doc").alias("y"))
        .distinct()
    )
    linked_members = _measured(member_pairs, sets).filter(_linked(percent)).select(F.col("x").alias("u"), F.col("y").alias("v"))
    new_edges = durable(linked_centres.union(linked_members))
    joined = components(edges.union(new_edges)) if not new_edges.isEmpty() else near

    classed = (
        rows.join(classes.select("set_key", F.col("doc").alias("class_id")), "set_key", "left")
        .join(joined, F.col("class_id") == F.col("node"), "left")
        .select("doc_id", F.col("n").alias("n_shingles"), "class_id", "component")
    )
    has = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return classed.select(
        "doc_id",
        "n_shingles",
        F.when(has, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(has, F.coalesce("component", "class_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
