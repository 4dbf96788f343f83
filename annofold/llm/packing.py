"""Shortest-pack-first packing over the length histogram.

1. Every text is tokenized once, in place, and cut into pieces of ``capacity`` ids; the last
   piece of a document is shorter. Only the pieces' lengths and checksums go on (or their
   ids, where asked for), written to the shared folder.
2. The histogram of piece lengths, at most ``capacity`` rows at any input size, comes to the
   driver. Lengths are placed longest first; each goes into the open pattern with the
   shortest total, and the counts of the patterns change with it.
3. Every slot of a pattern is a run of ranks within its length. Pieces get a dense rank
   within their length, across any number of tasks, and look their slot up.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annofold.llm._shared import batches, dense_rank_in, durable, row_mark, tidy

CAPACITY = 2048
END_ID = 1
#: Words in each of the two generations of a worker's table.
CACHED_WORDS = 300_000
TEXTS_AT_ONCE = 500
WORDS_AT_ONCE = 256
#: Texts by which a tokenizer shows whether it works word by word.
PROBES = (
    "Plain words, and THE Same Words again. the same words",
    "tabs\tand\nlines  with   blanks ",
    "3.14 a.b,c e-mail@x.org #1 it's (so) \u201cquoted\u201d!",
    "\u00c4rger stra\u00dfe d\u00e9j\u00e0 vu ni\u00f1o \u6cb3\u8fb9\u3002\u0928\u0926\u0940",
    "",
)
_WORD_END = re.compile("(?<=[A-Za-z0-9])(?=[.,])")


class WordIds:
    """Ids (uint32 bytes) of whole texts, by a bounded table of word strings.

    The tokenizer lower-cases, drops white space, and always cuts between a letter or digit
    and a full stop or comma; so a text's ids are those of the strings between such places,
    in order. Strings met for the first time are encoded many at a time. The table has two
    generations: when the younger one is full the older one goes, so common words stay.

    A tokenizer of another kind (one that keeps case, or marks spaces, say) encodes whole
    texts instead: whether the short way is right is tried on ``PROBES``.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._by_words = True
        self._by_words = self.of_texts(list(PROBES)) == self._whole(PROBES)

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        made = self._tokenizer.encode_batch(list(texts), add_special_tokens=False)
        return [np.array(m.ids, "<u4").tobytes() for m in made]

    def _split(self, text: str) -> list[str]:
        if "<|" not in text:  # a special token's name is matched before lower-casing
            text = text.encode().lower().decode()
        return _WORD_END.sub(" ", text.replace("\n", " ")).split(" ")

    def of_texts(self, texts: list[str]) -> list[bytes]:
        if not self._by_words:
            return self._whole(texts)
        split = [self._split(t) for t in texts]
        if len(self._known) > CACHED_WORDS:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        absent = set().union(*split).difference(known)
        again = absent & older.keys()
        known.update((w, older[w]) for w in again)
        new = list(absent - again)
        for at in range(0, len(new), WORDS_AT_ONCE):
            words = new[at : at + WORDS_AT_ONCE]
            made = self._tokenizer.encode(" ".join(words), add_special_tokens=False)
            raw = np.array(made.ids, "<u4").tobytes()
            ends = np.cumsum([len(w) + 1 for w in words])
            cuts = np.searchsorted([o[0] for o in made.offsets], ends).tolist()
            first = 0
            for word, cut in zip(words, cuts, strict=True):
                known[word] = raw[4 * first : 4 * cut]
                first = cut
        return [b"".join(map(known.__getitem__, words)) for words in split]


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The table of this worker process."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every text plus the end id."""
    end = np.asarray([END_ID], "<u4").tobytes()
    fields = [pa.field(k, pa.int64()) for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    if with_ids:
        fields.append(pa.field("ids", pa.binary()))
    schema = pa.schema(fields)

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        table = word_ids(tokenizer_path)
        for batch in it:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(at, TEXTS_AT_ONCE)
                texts = [t or "" for t in some.column(1).to_pylist()]
                for doc, ids in zip(some.column(0).to_pylist(), table.of_texts(texts), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        piece = ids[4 * start : 4 * (start + capacity)]
                        row = (doc, start, len(piece) // 4, zlib.crc32(piece), n)
                        yield (*row, piece) if with_ids else row

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if with_ids else "")
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(tidy(lambda it: batches(rows(it), schema)), ddl)


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in place order, count) from the counts of lengths, longest first.

    A length enters the open pattern with the shortest total; if it does not fit there it
    fits nowhere and opens patterns of its own.
    """
    done: list[tuple[tuple[int, ...], int]] = []
    held: list[tuple[int, int, tuple[int, ...], int]] = []
    made = 0

    def put(pattern: tuple[int, ...], total: int, count: int) -> None:
        nonlocal made
        if total == capacity:
            done.append((pattern, count))
        else:
            made += 1
            heapq.heappush(held, (total, made, pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not held or held[0][0] + length > capacity:
                put((length,), length, left)
                break
            total, _, pattern, count = heapq.heappop(held)
            used = min(left, count)
            if count > used:
                put(pattern, total, count - used)
            put((*pattern, length), total + length, used)
            left -= used
    return done + [(pattern, count) for _, _, pattern, count in sorted(held)]


def slots_by_length(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the runs of ranks that its slots take: rows (first rank, first sequence, offset)."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            at = used.get(length, 0)
            runs.setdefault(length, []).append((at, base, offset))
            used[length] = at + count
            offset += length
        base += count
    return {k: np.array(v, np.int64) for k, v in runs.items()}


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with ``sequence_id`` and ``offset`` in it.

    Null text counts as empty; an empty text is the end id alone; a very long text takes
    whole sequences and one remainder; equal rows are packed one by one; an empty table gives
    none. Only doc_id and text are read. ``with_ids`` adds the ids (uint32, little-endian).
    """
    made = tokenized_pieces(docs, tokenizer_path, capacity, with_ids)
    pieces = durable(made.withColumn("mark", row_mark()))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = slots_by_length(pack_histogram(histogram, capacity))
    ranked = dense_rank_in(pieces, ["length"], ["doc_id", "start", "ids_crc32", "mark"], sum(histogram.values()), "rank")

    def place(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in it:
            sequence = np.empty(len(rows), np.int64)
            offset = np.empty(len(rows), np.int64)
            ranks = rows["rank"].to_numpy()
            for length, at in rows.groupby("length").indices.items():
                run = slots[length]
                k = np.searchsorted(run[:, 0], ranks[at], side="right") - 1
                sequence[at] = run[k, 1] + ranks[at] - run[k, 0]
                offset[at] = run[k, 2]
            yield rows.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema)
    return ranked.select(*made.columns, "rank").mapInPandas(place, f"{ddl}, sequence_id long, offset long")
