"""Toxicity: a logistic classifier with counterfactual regularisation.

A text is the set of its words and of their stems (the first 3 to 6 letters). The features are
the names of groups (``IDENTITY_TERMS``) and their stems, which other words share, and of all
other words and stems those whose share of toxic texts is significantly raised or lowered
(log-likelihood ratio over all fitted texts, names left out).

Counterfactuals of a labelled text, which must not change its score:

* a name put into it, against the text without names;
* that name swapped for another one of its list;
* where the text has names itself: all of them taken out, and each swapped.

The loss charges the squared change of the logit, over all features that the text with and the
text without the name do not share. So naming a group can neither raise nor lower a score,
whoever is named, however the names are spread over the labels, and whatever words that begin
like a name have taught their stems:

    sum log-loss + l2 / 2 |w|^2 + swap / 2 * sum (w . (x_counterfactual - x))^2

The loss is convex and solved by Newton steps (conjugate gradients over sparse rows) on the
driver, over at most about ``FIT_ROWS`` labelled rows; scoring is one narrow pass.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annofold.llm._labels import fit_sample, fold_of
from annofold.llm._shared import durable, tidy

#: Least log-likelihood ratio of a feature (chi-square with one degree of freedom): chance
#: reaches it once in some two million features.
LEAST_EVIDENCE = 25.0
#: Letters of the stems.
STEMS = (3, 4, 5, 6)
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")

# Neutral names of groups, swapped within their list.
IDENTITY_TERMS = (
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "native", "refugee", "foreigner"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("deaf", "blind", "disabled", "autistic"),
    ("femme", "homme", "fille", "garçon"),
    ("femmes", "hommes", "filles", "garçons"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée"),
    ("immigré", "réfugié", "étranger"),
    ("mujer", "hombre", "niña", "niño"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("cristiano", "musulmán", "judío", "hindú", "budista", "ateo"),
    ("inmigrante", "refugiado", "extranjero"),
    ("frau", "mann", "mädchen", "junge"),
    ("frauen", "männer", "jungen"),
    ("christ", "moslem", "jude", "buddhist", "atheist"),
    ("einwanderer", "flüchtling", "ausländer"),
)
_SWAP: dict[str, str] = {}
for _terms in IDENTITY_TERMS:
    for _at, _term in enumerate(_terms):
        _SWAP.setdefault(_term, _terms[(_at + 1) % len(_terms)])
_NAMES = sorted(_SWAP)


def features_of(words: set[str]) -> set[str]:
    """Whole words (marked ``$``) and stems."""
    return {w + "$" for w in words} | {w[:k] for w in words for k in STEMS if len(w) >= k}


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def counterfactuals(words: set[str], choice: int) -> list[tuple[set[str], set[str]]]:
    """Pairs (words before, words after) of the text's counterfactuals; ``choice`` picks the name put in."""
    own = words & _SWAP.keys()
    plain = words - own
    name = _NAMES[choice % len(_NAMES)]
    pairs = [(plain, plain | {name}), (plain | {name}, plain | {_SWAP[name]})]
    if own:
        pairs += [(words, plain), (words, plain | {_SWAP[w] for w in own})]
    return pairs


def evidence(n: Column, pos: Column, rows: int, toxic: int) -> Column:
    """Log-likelihood ratio of a feature's share of toxic texts against the overall share."""
    share = toxic / rows
    neg = n - pos
    a = F.when(pos > 0, pos * F.log(pos / n / share)).otherwise(0.0)
    b = F.when(neg > 0, neg * F.log(neg / n / (1 - share))).otherwise(0.0)
    return 2 * (a + b)


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by feature, and the intercept."""

    weights: dict[str, float]
    intercept: float

    def by_start(self) -> dict[str, list[str]]:
        """Features by their first three letters, for a quick look-up."""
        out: dict[str, list[str]] = {}
        for f in self.weights:
            out.setdefault(f.rstrip("$")[: STEMS[0]], []).append(f)
        return out

    def score(self, words: set[str], starts: dict[str, list[str]]) -> float:
        hit: set[str] = set()
        for w in words:
            for f in starts.get(w[: STEMS[0]], ()):
                if (w + "$" == f) if f[-1] == "$" else w.startswith(f):
                    hit.add(f)
        z = self.intercept + sum(self.weights[f] for f in sorted(hit))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, n, pos) of each batch of (text, y)."""
    for batch in it:
        n: Counter[str] = Counter()
        pos: Counter[str] = Counter()
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = features_of(words_of(text) - _SWAP.keys())
            n.update(found)
            if y:
                pos.update(found)
        names = list(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([n[f] for f in names], pa.int64()), pa.array([pos[f] for f in names], pa.int64())],
            ["feature", "n", "pos"],
        )


class Sparse:
    """Rows of a sparse matrix from lists of (column, value)."""

    def __init__(self, rows: list[list[tuple[int, float]]], width: int) -> None:
        self.shape = len(rows), width
        self._row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self._column = np.array([c for r in rows for c, _ in r], np.int64)
        self._value = np.array([v for r in rows for _, v in r], float)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self._row, self._value * w[self._column], self.shape[0])

    def back(self, z: np.ndarray) -> np.ndarray:
        return np.bincount(self._column, self._value * z[self._row], self.shape[1])


def loss_and_gradient(w: np.ndarray, x: Sparse, y: np.ndarray, change: Sparse, l2: np.ndarray, swap: float) -> tuple[float, np.ndarray]:
    """The regularised loss at ``w`` and its gradient; ``l2`` holds each weight's own factor."""
    z, moved = x.times(w), change.times(w)
    p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    loss = (np.logaddexp(0, z) - y * z).sum() + 0.5 * (l2 * w * w).sum() + 0.5 * swap * (moved**2).sum()
    return float(loss), x.back(p - y) + l2 * w + swap * change.back(moved)


def solve(
    x: Sparse, y: np.ndarray, change: Sparse, l2: np.ndarray, swap: float = 10.0, steps: int = 30
) -> np.ndarray:
    """Newton steps until the gradient is below 1e-6 of a row; a step that does not lower the loss is halved."""
    w = np.zeros(x.shape[1])
    loss, g = loss_and_gradient(w, x, y, change, l2, swap)
    for _ in range(steps):
        if np.abs(g).max() < 1e-6 * max(1, len(y)):
            break
        p = 1 / (1 + np.exp(-np.clip(x.times(w), -40, 40)))
        curve = p * (1 - p)
        step, left = np.zeros_like(w), -g
        direction, norm = left.copy(), float(left @ left)
        goal = 1e-12 * norm
        for _ in range(4 * len(w)):
            bent = x.back(curve * x.times(direction)) + l2 * direction + swap * change.back(change.times(direction))
            rate = norm / float(direction @ bent)
            step += rate * direction
            left -= rate * bent
            last, norm = norm, float(left @ left)
            if norm <= goal:
                break
            direction = left + norm / last * direction
        rate = 1.0
        while rate > 1e-6:
            new_loss, new_g = loss_and_gradient(w + rate * step, x, y, change, l2, swap)
            if new_loss <= loss:
                break
            rate /= 2
        w, loss, g = w + rate * step, new_loss, new_g
    return w


@dataclass(frozen=True)
class Fitted:
    """A model with the numbers of rows and of counterfactual pairs that it was fitted on."""

    model: ToxicityModel
    rows: int
    pairs: int


def fit_counterfactual(sample: DataFrame, l2: float = 0.3, swap: float = 10.0) -> Fitted:
    """Fit on ``sample`` (text, y), a bounded set of rows. Without both classes the score is
    the (smoothed) share of toxic rows."""
    rows = durable(sample)
    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if toxic in (0, n):
        return Fitted(ToxicityModel({}, float(np.log((toxic + 0.5) / (n - toxic + 0.5)))), n, 0)
    counted = rows.mapInArrow(_counts, "feature string, n long, pos long").groupBy("feature")
    counted = counted.agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    telling = counted.filter(evidence(F.col("n"), F.col("pos"), n, toxic) >= LEAST_EVIDENCE).select("feature")
    names = sorted({r["feature"] for r in telling.collect()} | features_of(set(_NAMES)))
    place = {f: k for k, f in enumerate(names)}

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = batch.column(0).to_pylist()
            words = [words_of(t) for t in texts]
            found = [sorted(place[f] for f in features_of(w) & place.keys()) for w in words]
            pairs = [
                [
                    [sorted(place[f] for f in one & place.keys()) for one in (before - after, after - before)]
                    for before, after in ((features_of(b), features_of(a)) for b, a in counterfactuals(w, zlib.crc32(t.encode())))
                ]
                for w, t in zip(words, texts, strict=True)
            ]
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, ints), pa.array(pairs, pa.list_(pa.list_(ints)))], ["y", "found", "pairs"])

    # Sparse rows of small numbers, at most about FIT_ROWS.
    coded = rows.mapInArrow(encode, "y int, found array<int>, pairs array<array<array<int>>>").collect()
    coded.sort(key=lambda r: (r["y"], r["found"], r["pairs"]))
    bias = len(names)
    x = Sparse([[*((c, 1.0) for c in r["found"]), (bias, 1.0)] for r in coded], bias + 1)
    moved = [[*((c, -1.0) for c in before), *((c, 1.0) for c in after)] for r in coded for before, after in r["pairs"]]
    w = solve(x, np.array([r["y"] for r in coded], float), Sparse(moved, bias + 1), np.append(np.full(bias, l2), 1e-3), swap)
    return Fitted(ToxicityModel(dict(zip(names, w[:-1].tolist(), strict=True)), float(w[-1])), n, len(moved))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text).

    Fits on ``labels`` (doc_id, toxic) outside the held-out fold. Null and empty texts have
    no features and get the intercept's score; long texts are read whole; repeated rows get
    equal scores; without labels all scores are 0.5; an empty table gives none; further
    columns are not read.
    """
    model = fit_counterfactual(fit_sample(docs, labels, "toxic", FOLDS, HELD_OUT)).model

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = model.by_start()
        for batch in it:
            scores = [model.score(words_of(t or ""), starts) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string"))
    return chosen.mapInArrow(tidy(run), f"doc_id {kind}, held_out boolean, score double, predicted int")
