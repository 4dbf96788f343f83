"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe it and both neighbours; the chain adds a
weight for each pair of labels of neighbouring lines. Forward-backward gives each line's
marginal of being good; a document's score is their mean weighted by line length.

Only documents are labelled, so the labels of lines are hidden. Training holds the score of
a good document in ``GOOD`` and that of a bad one in ``BAD`` and charges the squared distance
to that range, weighted so that both kinds count alike (a generalized expectation
criterion). A document inside its range says nothing about its lines: a good one may hold
some bad lines, a bad one some good lines, and what a line is follows from its features.

The gradient of a document's score is the covariance of its weighted mean label with the
features, taken as the change of the expectations under a small push of all lines. Each step
sums losses and gradients in tasks over the sample; the driver sees one vector per task.

Forward and backward messages are prefix products of 2 x 2 matrices, made by doubling over
all lines of a block of documents: a text of n lines takes log2(n) array steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annofold.llm._labels import fit_sample, fold_of
from annofold.llm._shared import durable, tidy, utf8_column

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
#: Ranges of the score of good and of bad documents.
GOOD, BAD = (0.85, 1.0), (0.0, 0.15)
#: Lines that a fit uses at most, about (besides the bound on rows): a documented bound.
FIT_LINES = 2_000_000
#: Lines of one block of documents, but for a single longer text.
BLOCK_LINES = 20_000
STEPS = 40
#: Strength of the Gaussian prior of a line's own features, and of what its neighbours say
#: about it (their features and the label pairs), which has to be surer.
L2, NEAR_L2 = 3e-5, 1e-3
PUSH = 1e-3
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
_DIGITS = b"0123456789"
# Marks that close a sentence, a quotation or a bracket.
CLOSING = (".", "!", "?", ":", '"', "'", ")", "…", "”", "’", "»", "。", "！", "？", "：", "」", "』", "）", "।", "॥", "؟", "۔", "።", "։", "။", "។")
_CLOSING = tuple(c.encode() for c in CLOSING)
#: Names of a line's own features, in order; each also counts for the previous and next line.
OWN = (
    "some symbols",
    "many symbols",
    "separators",
    "shouting",
    "repeats a little",
    "repeats",
    "repeats a lot",
    "no closing mark",
    "very short",
    "long words",
    "digits",
    "exclamations",
    "seen before",
)
WIDTH = 3 * len(OWN) + 3


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines x WIDTH features, line weights) of the lines with words; one empty line if none."""
    own: list[list[bool]] = []
    weights: list[int] = []
    seen: set[bytes] = set()
    for line in text.split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        size = len(line)
        marks = size - len(line.translate(None, _SYMBOLS))
        distinct = len(set(words)) / n
        own.append(
            [
                20 * marks > n,
                2 * marks > n,
                line.count(b"|") > 2,
                len(line.translate(None, _CAPITALS)) < len(line.translate(None, _SMALL)),
                n >= 10 and distinct < 0.6,
                n >= 10 and distinct < 0.35,
                n >= 10 and distinct < 0.15,
                not line.rstrip().endswith(_CLOSING),
                n < 3,
                size > 12 * n,
                8 * (size - len(line.translate(None, _DIGITS))) > size,
                3 * line.count(b"!") > n,
                line in seen,
            ]
        )
        seen.add(line)
        weights.append(size)
    k = len(own)
    if not k:
        out = np.zeros((1, WIDTH), bool)
        out[0, -3:] = True
        return out, np.ones(1)
    base = np.array(own, bool)
    out = np.zeros((k, WIDTH), bool)
    m = len(OWN)
    out[:, :m] = base
    out[1:, m : 2 * m] = base[:-1]
    out[:-1, 2 * m : 3 * m] = base[1:]
    out[:, -3] = True
    out[0, -2] = True
    out[-1, -1] = True
    return out, np.array(weights, float)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices [2, 2, n], scaled to a largest entry of 1."""
    out = np.stack([np.stack([a[i, 0] * b[0, j] + a[i, 1] * b[1, j] for j in (0, 1)]) for i in (0, 1)])
    return out / out.max(axis=(0, 1))


class Chains:
    """The lines of several documents in a row, as chains; ``lengths`` are all positive."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths
        self.first = np.cumsum(lengths) - lengths
        self.document = np.repeat(np.arange(len(lengths)), lengths)
        self._place = np.arange(len(self.document)) - self.first[self.document]
        self._rest = lengths[self.document] - 1 - self._place

    def marginals(self, logit: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(good) of each line, P(labels of the line before, and of this one) [2, 2, lines], 0 at a document's first line)."""
        n = len(logit)
        own = np.stack([np.exp(-np.maximum(logit, 0)), np.exp(np.minimum(logit, 0))])
        step = np.exp(pair - pair.max())[:, :, None] * own[None]
        starts = self._place == 0
        forward = np.where(starts, own[None], step)
        after = np.ones((2, 2, n))
        inner = np.flatnonzero(self._rest > 0)
        after[:, :, inner] = step[:, :, inner + 1]
        for steps, room, ahead in ((forward, self._place, False), (after, self._rest, True)):
            width = 1
            while True:
                at = np.flatnonzero(room >= width)
                if not len(at):
                    break
                steps[:, :, at] = _products(steps[:, :, at], steps[:, :, at + width]) if ahead else _products(steps[:, :, at - width], steps[:, :, at])
                width *= 2
        # Before: rows of a prefix that begins a document are equal. After: a suffix ends in ones.
        before, behind = forward[0], after[:, 0]
        good = before * behind
        good = good[1] / good.sum(axis=0)
        both = np.zeros((2, 2, n))
        later = np.flatnonzero(~starts)
        held = before[:, later - 1][:, None] * step[:, :, later] * behind[:, later][None]
        both[:, :, later] = held / held.sum(axis=(0, 1))
        return good, both

    def mean(self, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Weighted mean of each document's lines."""
        return np.add.reduceat(values * weights, self.first) / np.add.reduceat(weights, self.first)


@dataclass(frozen=True)
class LineCrf:
    """Weights of a good line's features, and of neighbouring label pairs."""

    weights: np.ndarray
    pair: np.ndarray

    def line_marginals(self, made: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(P(good) of all lines, score of each text) of texts given by ``line_features``."""
        chains = Chains(np.array([len(w) for _, w in made]))
        logit = np.concatenate([f @ self.weights for f, _ in made])
        good, _ = chains.marginals(logit, self.pair)
        return good, np.clip(chains.mean(good, np.concatenate([w for _, w in made])), 0, 1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Length-weighted mean marginal of each text."""
        out = []
        for block in _blocks(map(line_features, texts)):
            out.append(self.line_marginals(block)[1])
        return np.concatenate(out) if out else np.empty(0)


def _blocks(made: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Texts in blocks of about ``BLOCK_LINES`` lines; the second item of each has one entry a line."""
    held: list[tuple] = []
    lines = 0
    for one in made:
        held.append(one)
        lines += len(one[1])
        if lines >= BLOCK_LINES:
            yield held
            held, lines = [], 0
    if held:
        yield held


def loss_and_gradient(
    features: np.ndarray, weights: np.ndarray, lengths: np.ndarray, labels: np.ndarray, costs: np.ndarray, model: LineCrf
) -> tuple[float, np.ndarray]:
    """Summed loss of some documents and its gradient (weights, then pairs); ``costs`` by label."""
    chains = Chains(lengths)
    logit = features @ model.weights
    good, _ = chains.marginals(logit, model.pair)
    score = chains.mean(good, weights)
    low, high = np.where(labels == 1, GOOD[0], BAD[0]), np.where(labels == 1, GOOD[1], BAD[1])
    off = np.where(score < low, score - low, np.where(score > high, score - high, 0.0))
    cost = costs[labels]
    share = weights / np.add.reduceat(weights, chains.first)[chains.document]
    push = PUSH * share * lengths[chains.document]
    up, up_pairs = chains.marginals(logit + push, model.pair)
    down, down_pairs = chains.marginals(logit - push, model.pair)
    # Each document's change of expectations, times what its score is off.
    turn = (cost * off / (2 * PUSH * lengths))[chains.document]
    gradient = np.append((turn * (up - down)) @ features, (turn * (up_pairs - down_pairs)).sum(axis=2).ravel())
    return float((0.5 * cost * off**2).sum()), gradient


def _packed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lines, sizes, n, y) from (text, y): features of all lines as bits, and line weights."""
    for batch in it:
        made = [line_features(t or b"") for t in utf8_column(batch, 0)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([np.packbits(f, axis=1).tobytes() for f, _ in made], pa.binary()),
                pa.array([w.astype("<f8").tobytes() for _, w in made], pa.binary()),
                pa.array([len(w) for _, w in made], pa.int64()),
                batch.column(1),
            ],
            ["lines", "sizes", "n", "y"],
        )


def fit_line_crf(sample: DataFrame, steps: int = STEPS, max_lines: int = FIT_LINES) -> LineCrf:
    """Fit on ``sample`` (text, y), a bounded set of rows; no rows give scores of 0.5.

    Beyond ``max_lines`` lines in all, the texts with the lowest hash of their features stay.
    """
    spread = max(1, int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    held = durable(sample.repartition(spread).mapInArrow(tidy(_packed), "lines binary, sizes binary, n long, y int"))
    total = held.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total > max_lines:
        held = durable(held.filter(F.pmod(F.xxhash64("lines", "sizes"), F.lit(1_000_000)) < int(1_000_000 * max_lines / total)))
    counts = {r["y"]: r["rows"] for r in held.groupBy("y").agg(F.count(F.lit(1)).alias("rows")).collect()}
    rows = sum(counts.values())
    costs = np.array([rows / (2 * counts[k]) if counts.get(k) else 0.0 for k in (0, 1)]) / max(1, rows)
    row_bytes = -(-WIDTH // 8)
    prior = np.full(WIDTH + 4, NEAR_L2)
    prior[: len(OWN)] = prior[WIDTH - 3 : WIDTH] = L2

    def objective(at: np.ndarray) -> tuple[float, np.ndarray]:
        model = LineCrf(at[:WIDTH], at[WIDTH:].reshape(2, 2))

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, gradient = 0.0, np.zeros(WIDTH + 4)
            texts = (
                (lines, np.frombuffer(sizes, "<f8"), y)
                for batch in it
                for lines, sizes, y in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True)
            )
            for block in _blocks(texts):
                bits = np.frombuffer(b"".join(lines for lines, _, _ in block), np.uint8).reshape(-1, row_bytes)
                features = np.unpackbits(bits, axis=1)[:, :WIDTH].astype(float)
                lengths = np.array([len(w) for _, w, _ in block])
                labels = np.array([y for _, _, y in block])
                more, turn = loss_and_gradient(features, np.concatenate([w for _, w, _ in block]), lengths, labels, costs, model)
                loss, gradient = loss + more, gradient + turn
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([gradient.tolist()], pa.list_(pa.float64()))], ["loss", "g"])

        parts = held.select("lines", "sizes", "y").mapInArrow(run, "loss double, g array<double>").collect()
        parts.sort(key=lambda r: (r["loss"], r["g"]))  # one order of summing, whichever task ends first
        return sum(r["loss"] for r in parts) + 0.5 * float(prior @ at**2), np.sum([r["g"] for r in parts], axis=0) + prior * at

    at = descend(objective, np.zeros(WIDTH + 4), steps) if rows else np.zeros(WIDTH + 4)
    return LineCrf(at[:WIDTH], at[WIDTH:].reshape(2, 2))


def descend(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], at: np.ndarray, steps: int, history: int = 8) -> np.ndarray:
    """L-BFGS with at most ``steps`` evaluations; a move that does not lower the objective is shortened."""
    f, g = objective(at)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    direction, rate = -g / max(1e-12, np.abs(g).max()), 0.5
    for _ in range(steps - 1):
        tried = at + rate * direction
        new_f, new_g = objective(tried)
        if new_f > f + 1e-4 * rate * float(g @ direction):
            rate /= 4
            if rate < 1e-4:
                break
            continue
        if float((tried - at) @ (new_g - g)) > 1e-12:
            moves = [*moves[1 - history :], (tried - at, new_g - g)]
        gain = f - new_f
        at, f, g = tried, new_f, new_g
        if gain < 1e-5 * f:
            break
        q, kept = -g, []
        for s, t in reversed(moves):
            a = float(s @ q) / float(s @ t)
            q = q - a * t
            kept.append((s, t, a))
        if moves:
            s, t = moves[-1]
            q = q * float(s @ t) / float(t @ t)
        for s, t, a in reversed(kept):
            q = q + s * (a - float(t @ q) / float(s @ t))
        direction, rate = (q, 1.0) if float(q @ g) < 0 else (-g, 1.0)
    return at


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text).

    Fits on ``labels`` (doc_id, quality) outside the held-out fold. Null, empty and blank
    texts are one empty line; repeated rows get equal scores; an empty table gives none;
    further columns are not read. Every line of a text counts, however many it has.
    """
    model = fit_line_crf(fit_sample(docs, labels, "quality", FOLDS, HELD_OUT))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            scores = model.scores([t or b"" for t in utf8_column(batch, 2)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string"))
    return chosen.mapInArrow(tidy(run, 500), f"doc_id {kind}, held_out boolean, score double, predicted int")
