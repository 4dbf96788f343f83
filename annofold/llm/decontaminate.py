"""Benchmark decontamination by a prefix-filtered set join on word shingles.

A window is ``window`` consecutive words of a benchmark item (the whole item where it has
fewer). Its set is its ``shingle``-word shingles (the whole window where that is shorter).
A document holds a window exactly when all shingles of the window lie in it, each at its
own distance from the window's start. So:

1. every place in the corpus whose shingle has a benchmark shingle's hash is found once and
   written as numbers (document, place, hash), with a row for each document and its number
   of words. Texts are split and hashed in place; a word array never goes through a shuffle;
2. those places give each shingle's corpus frequency, the order of rarity;
3. containment 1 of a set of s shingles needs its s - s + 1 = 1 rarest shingle: only the
   places of this prefix are joined to windows;
4. length and position bounds drop candidates whose window would leave the document;
5. the candidates of a document, as one row of numbers, go back to its text; the words of the
   whole window are hashed, and what agrees is compared word by word with the windows.

DataFrame functions only. Nothing but counts and the distinct shingle lengths (at most
``shingle``) reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annofold.llm._shared import durable

WINDOW = 10
SHINGLE = 5
#: Items of a narrow side (hashes of benchmark shingles; candidates, 24 bytes each) up to
#: which it is broadcast; beyond it the join is a shuffled one with the same rows.
BROADCAST_ROWS = 200_000
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of digits, small letters and non-ASCII."""
    low = F.translate(text, _CAPITALS, _CAPITALS.lower())
    return F.coalesce(F.array_remove(F.split(low, _NOT_WORD), ""), F.array().cast("array<string>"))


def _joined(array: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(array, start, length), " ")


def _starts(count: Column) -> Column:
    """1..count, empty below 1."""
    return F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct (window_text, length, item_id) of all items; items without words give none."""
    w = benchmark.select(F.col("item_id").alias("item_id"), words(F.col("text").cast("string")).alias("w"))
    w = w.withColumn("length", F.least(F.size("w"), F.lit(window))).filter("length > 0")
    w = w.withColumn("start", F.explode(_starts(F.size("w") - F.col("length") + 1)))
    return w.select(_joined(F.col("w"), F.col("start"), F.col("length")).alias("window_text"), "length", "item_id").distinct()


def _shingle_hashes(hashes: Column, k: int) -> Column:
    """Hashes of all shingles of ``k`` words, in order, from the hashes of single words."""
    return F.transform(_starts(F.size(hashes) - k + 1), lambda i: F.xxhash64(*(F.get(hashes, i + (j - 1)) for j in range(k))))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(window_text, length, k, h, offset): each distinct shingle's hash at its first offset."""
    w = windows.select("window_text", "length").distinct().withColumn("k", F.least(F.col("length"), F.lit(shingle)))
    hashed = w.withColumn("hw", _word_hashes(F.split("window_text", " ")))
    of_k = [
        hashed.filter(F.col("k") == k).select(
            "window_text", "length", "k", F.posexplode(_shingle_hashes(F.col("hw"), k)).alias("offset", "h")
        )
        for k in range(1, shingle + 1)
    ]
    return reduce(DataFrame.unionByName, of_k).groupBy("window_text", "length", "k", "h").agg(F.min("offset").alias("offset"))


def shingle_places(docs: DataFrame, shingles: DataFrame, k: int, few: bool, with_sizes: bool) -> DataFrame:
    """(doc_id, row, n_words, at, k, h): places of ``docs`` (doc_id, row, t) with the hash of a ``shingles`` of k words.

    ``with_sizes`` adds a row for each document, with at = -1: it is found by a mark put before
    the places' hashes, so that one reading of the texts gives both.
    """
    wanted = shingles.filter(F.col("k") == k).select("h").distinct()
    # Functions over array items stay in projections of their own, so that the explosion and
    # the join compile to one loop that copies no array. The outer form spares a filter on
    # the arrays' sizes, which would be pushed to the texts and hash everything once more.
    hashed = docs.select("doc_id", "row", _word_hashes(words(F.col("t"))).alias("hw"))
    hashes = _shingle_hashes(F.col("hw"), k)
    if with_sizes:
        mark = F.lit(0).cast("long")
        wanted = wanted.union(docs.sparkSession.range(1).select(mark.alias("h"))).distinct()
        hashes = F.concat(F.array(mark), hashes)
    spots = hashed.select("doc_id", "row", F.size("hw").alias("n_words"), hashes.alias("hs")).select(
        "doc_id", "row", "n_words", F.posexplode_outer("hs").alias("at", "h")
    )
    found = spots.join(F.broadcast(wanted) if few else wanted, "h")
    return found.select("doc_id", "row", "n_words", (F.col("at") - int(with_sizes)).alias("at"), F.lit(k).alias("k"), "h")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans).

    documents: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, one row per row of
    ``docs`` (doc_id, text). spans: doc_id, row, start, length of every occurrence of a window
    (0-based words), for removal. Null and empty texts have no words and no hits; items
    without words match nothing; rows that share a doc_id are judged by their own text
    (``row`` is its hash); empty tables give empty results or no hits; only doc_id, text and
    item_id are read.
    """
    text = F.col("text").cast("string")
    keyed = docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("t"))
    windows = durable(benchmark_windows(benchmark, window))
    shingles = durable(window_shingles(windows, shingle))
    few = shingles.count() <= broadcast_rows
    lengths = sorted(r["k"] for r in shingles.select("k").distinct().collect()) or [shingle]
    found = durable(
        reduce(DataFrame.unionByName, [shingle_places(keyed, shingles, k, few, few and k == lengths[0]) for k in lengths])
    )
    places = found.filter("at >= 0")
    if few:
        sizes = found.filter("at < 0")
    else:
        # In a shuffled join the mark would be one key of all documents.
        sizes = durable(keyed.select("doc_id", "row", F.size(words(F.col("t"))).alias("n_words")))

    rarity = places.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n"))
    by_rarity = Window.partitionBy("window_text").orderBy("n", "h")
    prefix = (
        shingles.join(rarity, ["k", "h"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("rank", F.row_number().over(by_rarity))
        .filter("rank = 1 AND n > 0")
        .select("k", "h", "offset", "length", "window_text")
    )
    candidates = (
        places.join(F.broadcast(prefix) if few else prefix, ["k", "h"])
        .withColumn("start", F.col("at") - F.col("offset"))
        .filter("start >= 0 AND start + length <= n_words")
        .groupBy(F.col("doc_id").alias("c_doc"), F.col("row").alias("c_row"))
        .agg(F.collect_set(F.struct("start", "length", F.xxhash64("window_text").alias("wh"))).alias("tried"))
    )
    candidates = durable(candidates)
    if (candidates.agg(F.sum(F.size("tried"))).first()[0] or 0) <= broadcast_rows:
        candidates = F.broadcast(candidates)
    at_text = F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("row") == F.col("c_row"))
    # Words first, then the explosion, in two projections: a text is split once, not once for each candidate.
    split = keyed.join(candidates, at_text).select("doc_id", "row", words(F.col("t")).alias("w"), "tried")
    tried = split.select("doc_id", "row", "w", F.explode("tried").alias("c"))
    stood = tried.select(
        "doc_id", "row", "c.start", "c.length", "c.wh", _joined(F.col("w"), F.col("c.start") + 1, F.col("c.length")).alias("window_text")
    )
    known = windows.select("window_text").distinct()
    agreed = stood.filter(F.xxhash64("window_text") == F.col("wh")).drop("wh").distinct()
    spans = durable(agreed.join(F.broadcast(known) if few else known, "window_text", "left_semi"))
    end = F.col("start") + F.col("length")
    earlier = Window.partitionBy("doc_id", "row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(end).over(earlier), F.lit(0))
    covered = (
        spans.select("doc_id", "row", F.greatest(F.lit(0), end - F.greatest(F.col("start"), reached)).alias("new"))
        .groupBy("doc_id", "row")
        .agg(F.sum("new").alias("n_hit"))
    )
    items = (
        spans.join(windows.select("window_text", "item_id"), "window_text")
        .select("doc_id", "row", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("doc_id", "row")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    hits = covered.join(items, (covered.doc_id.eqNullSafe(items.doc_id)) & (covered.row == items.row), "left").select(
        covered.doc_id.alias("hit_doc"), covered.row.alias("hit_row"), "n_hit", "items"
    )
    none = F.array().cast("array<string>")
    result = sizes.join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit_doc")) & (F.col("row") == F.col("hit_row")), "left"
    ).select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
    return result, spans.select("doc_id", "row", "start", "length")
