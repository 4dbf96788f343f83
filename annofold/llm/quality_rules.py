"""Line-first quality rules: judge every line, drop the bad ones, then judge what is left.

A line (``\\n``-separated) with at least one word fails when one of these holds:

* punctuation: it neither ends in closing punctuation of any script nor holds a sentence end
  (one of ``.!?`` and a space, or a full stop of a script that writes none);
* navigation: it holds three or more ``|`` separators;
* symbols: more than one character of ``[#*$%&|<>]`` for every four words;
* shouting: more ASCII capitals than ASCII small letters;
* boilerplate: it contains one of ``BOILERPLATE``, phrases of page furniture in English,
  Spanish, French and German (ASCII case ignored).

A document is rejected when the base filter rejects it or when its failed lines hold more
than half of its non-blank characters (code points).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annofold.llm._shared import tidy, utf8_column

# Closing punctuation, full stops that need no space, and phrases of page furniture.
CLOSING = (
    ".", "!", "?", ":", ";", '"', "'", ")", "…", "”", "’", "»", "›", "“", "。", "．", "！", "？", "：", "；", "」", "』", "）", "】",
    "।", "॥", "؟", "؛", "۔", "።", "፧", "։", "။", "។", "༎",
)
FULL_STOPS = ("。", "！", "？", "।", "۔", "؟", "።", "։", "။", "។")
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "enable javascript",
    "licensed under",
    "lorem ipsum",
    "privacy policy",
    "spdx-license-identifier",
    "terms of service",
    "terms of use",
    "todos los derechos reservados",
    "política de privacidad",
    "política de cookies",
    "aviso legal",
    "tous droits réservés",
    "politique de confidentialité",
    "mentions légales",
    "conditions d'utilisation",
    "alle rechte vorbehalten",
    "datenschutzerklärung",
    "nutzungsbedingungen",
    "impressum",
)
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
_CLOSING = tuple(c.encode() for c in CLOSING)
_BOILERPLATE = tuple(p.encode() for p in BOILERPLATE)
_SENTENCE_ENDS = (b". ", b"! ", b"? ", *(c.encode() for c in FULL_STOPS))
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the document verdict."""

    max_separators: int = 2
    symbol_words: int = 4
    max_lost_percent: int = 50
    min_words: int = 50
    max_repeat_percent: int = 50


def _points(b: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(b) if b.isascii() else len(b.decode("utf-8", "replace"))


def _without(b: bytes, drop: bytes) -> bytes:
    return b.translate(None, drop)


def line_fails(line: bytes, words: int, rules: LineRules) -> bool:
    """Whether a line (blanks stripped) with ``words`` words breaks a rule."""
    if line.count(b"|") > rules.max_separators:
        return True
    if not line.endswith(_CLOSING) and not any(e in line for e in _SENTENCE_ENDS):
        return True
    if rules.symbol_words * (len(line) - len(_without(line, SYMBOLS))) > words:
        return True
    if len(_without(line, _CAPITALS)) < len(_without(line, _SMALL)):
        return True
    low = line.lower()
    return any(p in low for p in _BOILERPLATE)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    w = (h[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F))
    w = w * np.uint64(0x165667B19E3779F9) + h[2:]
    order = np.argsort(w, kind="stable")
    s = w[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k : n - 2 + k] |= twice
    return int(hit.sum())


def judge(text: bytes | None, rules: LineRules) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_lines, n_bad_lines, clean text) of one text."""
    b = text or b""
    words = b.split()
    n = len(words)
    word_chars = _points(_without(b, BLANKS))
    symbols = len(b) - len(_without(b, SYMBOLS))
    repeats = repeated_words(words)
    base_failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    lines = b.split(b"\n")
    good: list[bytes] = []
    seen: set[bytes] = set()
    worded = dups = bad = lost = whole = 0
    for line in lines:
        bare = line.strip(BLANKS)
        if not bare:
            good.append(line)
            continue
        worded += 1
        dups += line in seen
        seen.add(line)
        size = _points(_without(bare, BLANKS))
        whole += size
        if line_fails(bare, len(bare.split()), rules):
            bad += 1
            lost += size
        else:
            good.append(line)
    kept = not base_failed and 100 * lost <= rules.max_lost_percent * whole
    return n, word_chars, symbols, dups, repeats, base_failed, kept, worded, bad, b"\n".join(good)


_FIELDS = (
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()),
    ("kept", pa.bool_()),
    ("n_lines", pa.int64()),
    ("n_bad_lines", pa.int64()),
)


def line_first_quality(docs: DataFrame, rules: LineRules = LineRules(), with_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, base verdict, verdict, line counts.

    ``with_text`` adds ``clean_text``, the text without its failed lines (null stays null).
    No shuffle: every text is judged alone. Null and empty texts have no words, so the base
    filter rejects them; an empty table gives none; repeated rows are judged one by one; only
    doc_id and text are read, so further columns can have any name.
    """
    fields = [pa.field(k, t) for k, t in _FIELDS]
    if with_text:
        fields.append(pa.field("clean_text", pa.string()))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = utf8_column(batch, 1)
            rows = [judge(t, rules) for t in texts]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 10
            out = [pa.array(cols[k], f.type) for k, f in enumerate(fields[:9])]
            if with_text:
                clean = [None if t is None else c for t, c in zip(texts, cols[9], strict=True)]
                out.append(pa.array(clean, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *out], names=["doc_id", *(f.name for f in fields)]
            )

    ddl = ", ".join(
        [f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"]
        + [f"{k} {'boolean' if t == pa.bool_() else 'long'}" for k, t in _FIELDS]
        + (["clean_text string"] if with_text else [])
    )
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(tidy(run), ddl)


def keep_clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns, without their failed lines.

    text loses its failed lines and n_chars, where present, counts what is left (code points);
    a row without failed lines is unchanged. Judged row by row, like ``line_first_quality``.
    """
    names = docs.columns
    # By place, since a column may have any name (a dot in it, say).
    inner = [f"c{k}" for k in range(len(names))]
    placed = docs.toDF(*inner)
    at = names.index("text")
    size_at = names.index("n_chars") if "n_chars" in names else None

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = [judge(t, rules) for t in utf8_column(batch, at)]
            kept = [k for k, r in enumerate(rows) if r[6]]
            some = batch.take(pa.array(kept, pa.int64()))
            texts = [rows[k][9] for k in kept]
            columns = list(some.columns)
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            if size_at is not None:
                columns[size_at] = pa.array([_points(t) for t in texts], columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=inner)

    return placed.mapInArrow(tidy(run), placed.schema).toDF(*names)
