"""One-vs-rest logistic heads, fitted by data-parallel L-BFGS.

Ids: ML-01..06, SNK-09.

For each label: mean of the class-balanced log-loss plus alpha / 2 |w|^2 on standardised
features, intercept free. A step evaluates losses and gradients of a block of labels, all of
their folds at once, in one pass over the rows. The gradient is reduced in levels: the tasks
of a pass are as many as the cores, each of which sums all partitions that fall to it; the
sums of ``FAN_IN`` tasks are added at a time, until the driver adds the last ones. So a pass shuffles by the number of cores, however many partitions the rows have.
No task or driver ever holds the rows; the driver's memory is ``block`` x features x (history + ``FAN_IN``).

Vectors lie in one folder a fold. A fit that leaves a fold out and the scoring of a fold read
the folders that they need, and one scan of a fold scores all branches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as pa_ds
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annofold.schemas import PREDICTIONS
from annofold.sinks import arrow_store
from annofold.storage import settled

ALPHA = 1e-4
#: Labels times folds that are fitted together.
BLOCK = 512
#: Partial sums that one group of the reduction adds.
FAN_IN = 16


@dataclass(frozen=True)
class Heads:
    """Linear heads of one branch and fold: scores are sigmoid(standardised vector @ coef + intercept)."""

    branch: str
    held_fold: int
    terms: tuple[str, ...]
    coef: np.ndarray
    intercept: np.ndarray
    mean: np.ndarray
    std: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.std) @ self.coef + self.intercept
        return np.clip(1 / (1 + np.exp(-np.clip(z, -60, 60))), 0, 1).astype(np.float32)


#: Mean and standard deviation of each feature, by the fold held out (-1: none).
Scalers = dict[int, tuple[np.ndarray, np.ndarray]]


def one_task_a_core(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` in at most as many tasks as the application has cores, and that number; nothing is shuffled."""
    cores = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.coalesce(cores), cores


def tree_sum(partials: DataFrame, tasks: int, fan_in: int = FAN_IN) -> dict[int, np.ndarray]:
    """Element-wise sums of ``partials`` (key, slot, v) by key.

    ``slot`` is the number of the task, below ``tasks``, that made a row. Shuffles add
    ``fan_in`` rows of a key at a time; the driver adds the last ``fan_in``.
    """

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": parts["key"].iloc[:1], "slot": parts["slot"].iloc[:1], "v": [np.sum(parts["v"].to_list(), axis=0)]})

    while tasks > fan_in:
        tasks = -(-tasks // fan_in)
        partials = partials.withColumn("slot", F.pmod("slot", F.lit(tasks))).groupBy("key", "slot").applyInPandas(add, "key long, slot int, v array<double>")
    last = partials.toPandas().sort_values(["key", "slot"])
    return {int(k): np.sum(some["v"].to_list(), axis=0) for k, some in last.groupby("key")}


def _partials(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Rows (key, slot, v) of what this task has summed."""
    keys = sorted(sums)
    slot = TaskContext.get().partitionId()
    values = pa.array([sums[k] for k in keys], pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([slot] * len(keys), pa.int32()), values], ["key", "slot", "v"])


def _times(rows: DataFrame) -> Column:
    """How often a row counts: ``times`` of ``combined_rows``, else once."""
    return F.col("times") if "times" in rows.columns else F.lit(1).cast("long").alias("times")


def combined_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (embedding, fold, pos) with equal ones as one row and their number, times.

    A fit reads its rows in every step, and equal rows add equal terms to its sums. One pass
    estimates the different rows; where there are more than half as many as rows, combining them
    would save little, and ``rows`` stay as they are.
    """
    alike = rows.select("embedding", F.array_sort("pos").alias("pos"), "fold")
    n, different = alike.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64("embedding", "pos", "fold"))).first()
    if 2 * different > n:
        return rows
    return settled(alike.groupBy("embedding", "pos", "fold").agg(F.count(F.lit(1)).alias("times")), "fold")


def scalers(vectors: DataFrame) -> Scalers:
    """Mean and population standard deviation (1 where it is 0) of each feature over the rows
    of all folds but one, for each fold of ``vectors`` (embedding, fold, perhaps times), and over all rows.

    One pass sums every fold by itself; a held fold's sums are taken from the total.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in it:
            if not batch.num_rows:
                continue
            x, fold, times = _matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for k in np.unique(fold).tolist():
                own, often = x[fold == k], times[fold == k][:, None]
                part = np.concatenate([[often.sum()], (own * often).sum(axis=0), (own * own * often).sum(axis=0)])
                sums[k] = sums[k] + part if k in sums else part
        yield _partials(sums)

    rows, tasks = one_task_a_core(vectors.select("embedding", "fold", _times(vectors)))
    by_fold = tree_sum(rows.mapInArrow(run, "key long, slot int, v array<double>"), tasks)
    if not by_fold:
        raise ValueError("there are no vectors")
    whole = np.sum([by_fold[k] for k in sorted(by_fold)], axis=0)
    out = {}
    for held in (-1, *by_fold):
        total = whole - by_fold[held] if held in by_fold else whole
        n, (s, q) = total[0], np.split(total[1:], 2)
        mean = s / max(1, n)
        std = np.sqrt(np.maximum(q / max(1, n) - mean**2, 0))
        out[held] = mean, np.where(std > 1e-12, std, 1.0)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def gradient_partials(rows: DataFrame, w: np.ndarray, columns: pd.DataFrame, weights: np.ndarray, scale: Scalers) -> tuple[DataFrame, int]:
    """Rows (key, slot, v) that a pass makes, and the number of its tasks.

    ``rows`` (embedding, fold, pos, perhaps times): pos lists the labels for which the row is positive.
    ``columns`` (label, held_fold): what each column of ``w`` [features + 1, columns] is for;
    ``weights`` [2, columns]: what a negative and a positive row count. Each column sees the
    rows as ``scale`` standardises them for its held fold. v is a column's loss and gradient.
    """
    label, held = columns["label"].to_numpy(), columns["held_fold"].to_numpy()
    of_fold = {}
    for k in np.unique(held).tolist():
        own = np.flatnonzero(held == k)
        place = np.full(int(label.max()) + 1, -1)
        place[label[own]] = np.arange(len(own))
        of_fold[k] = own, place

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, loss = np.zeros_like(w), np.zeros(w.shape[1])
        for batch in it:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                raw, fold, times = _matrix(some.column(0)), some.column(1).to_numpy(), some.column(3).to_numpy()
                row = np.repeat(np.arange(len(raw)), some.column(2).value_lengths().to_numpy())
                positive = some.column(2).flatten().to_numpy()
                row, positive = row[positive <= label.max()], positive[positive <= label.max()]
                for k, (own, place) in of_fold.items():
                    used = fold != k
                    if not used.any():
                        continue
                    mean, std = scale[k]
                    x = np.concatenate([(raw[used] - mean) / std, np.ones((int(used.sum()), 1))], axis=1)
                    mine = np.zeros((len(raw), len(own)))
                    known = place[positive] >= 0
                    mine[row[known], place[positive[known]]] = 1
                    mine = mine[used]
                    cost = np.where(mine > 0, weights[1, own], weights[0, own]) * times[used][:, None]
                    z = x @ w[:, own]
                    loss[own] += (cost * (np.logaddexp(0, z) - mine * z)).sum(axis=0)
                    gradient[:, own] += x.T @ (cost * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - mine))
        yield _partials({k: np.append(loss[k], gradient[:, k]) for k in range(w.shape[1])})

    few, tasks = one_task_a_core(rows.select("embedding", "fold", "pos", _times(rows)))
    return few.mapInArrow(run, "key long, slot int, v array<double>"), tasks


def _gradients(
    rows: DataFrame, w: np.ndarray, columns: pd.DataFrame, weights: np.ndarray, scale: Scalers, fan_in: int = FAN_IN
) -> tuple[np.ndarray, np.ndarray]:
    """(loss of each column, gradient [features + 1, columns]) of the data term."""
    summed = tree_sum(*gradient_partials(rows, w, columns, weights, scale), fan_in)
    both = np.stack([summed[k] for k in range(w.shape[1])], axis=1)
    return both[0], both[1:]


def _direction(g: np.ndarray, moves: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """The L-BFGS direction of every column."""
    q = g.copy()
    kept = []
    for s, t in zip(reversed(moves), reversed(turns), strict=True):
        st = (s * t).sum(axis=0)
        rho = np.where(st > 1e-12, 1 / np.where(st > 1e-12, st, 1), 0.0)
        a = rho * (s * q).sum(axis=0)
        q -= a * t
        kept.append((s, t, rho, a))
    if moves:
        s, t = moves[-1], turns[-1]
        tt = (t * t).sum(axis=0)
        q *= np.where(tt > 1e-12, np.maximum((s * t).sum(axis=0), 1e-12) / np.where(tt > 1e-12, tt, 1), 1.0)
    for s, t, rho, a in reversed(kept):
        q += s * (a - rho * (t * q).sum(axis=0))
    return -q


def _solve(
    rows: DataFrame, columns: pd.DataFrame, scale: Scalers, alpha: float, steps: int, tolerance: float, history: int = 8
) -> np.ndarray:
    """Weights [features + 1, columns] of ``columns`` (label, held_fold, n_pos, n_rows); a column whose step raises its objective halves it."""
    n, n_pos = columns["n_rows"].to_numpy(), columns["n_pos"].to_numpy()
    width = len(scale[-1][0]) + 1
    weights = np.stack([n / (2.0 * np.maximum(n - n_pos, 1)), n / (2.0 * np.maximum(n_pos, 1))])
    penalty = np.append(np.full(width - 1, alpha), 0.0)[:, None]

    def objective(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        loss, g = _gradients(rows, w, columns, weights, scale)
        return loss / n + 0.5 * (penalty * w * w).sum(axis=0), g / n + penalty * w

    w = np.zeros((width, len(columns)))
    f, g = objective(w)
    moves: list[np.ndarray] = []
    turns: list[np.ndarray] = []
    rate = np.ones(len(columns))
    direction = -g
    for _ in range(steps):
        if np.abs(g).max() < tolerance:
            break
        tried = w + rate * direction
        new_f, new_g = objective(tried)
        # The last term is what sums of the same numbers in another order may differ by.
        good = new_f <= f + 1e-4 * rate * (g * direction).sum(axis=0) + 1e-13 * np.abs(f)
        move, turn = np.where(good, tried - w, 0.0), np.where(good, new_g - g, 0.0)
        w, f, g = np.where(good, tried, w), np.where(good, new_f, f), np.where(good, new_g, g)
        if good.any():
            moves, turns = [*moves[-history + 1 :], move], [*turns[-history + 1 :], turn]
        fresh = _direction(g, moves, turns)
        down = (fresh * g).sum(axis=0) < 0
        direction = np.where(good, np.where(down, fresh, -g), direction)
        rate = np.where(good, 1.0, rate / 2)
    return w


def vectors_by_fold(vectors: DataFrame, folds: DataFrame, *more: str) -> DataFrame:
    """(entry_id, embedding, more, fold) of the entries that have a fold, written in one folder a fold.

    Filters on fold are partition filters of the scan: other folds are not read.
    """
    fold_of = folds.select(F.col("entry_id").cast("string").alias("entry_id"), F.col("fold").cast("int").alias("fold")).filter("fold IS NOT NULL")
    ids = vectors.select(F.col("entry_id").cast("string").alias("entry_id"), "embedding", *more)
    return settled(ids.join(fold_of, "entry_id"), "fold")


def training_rows(vectors: DataFrame, folds: DataFrame, pairs: DataFrame, trainable: DataFrame) -> tuple[DataFrame, pd.DataFrame]:
    """``vectors_by_fold`` with pos, the numbers of the labels for which a row is positive, and
    the list (branch, term, held_fold, n_pos, n_rows, label) of what is to be fitted."""
    wanted = trainable.toPandas().sort_values(["held_fold", "branch", "term"], ignore_index=True)
    if wanted.empty:
        raise ValueError("no label can be fitted; lower the number of entries that a label needs")
    wanted["label"] = wanted.groupby(["branch", "term"]).ngroup()
    names = wanted.drop_duplicates("label")[["branch", "term", "label"]]
    # At most the capped number of labels.
    numbers = vectors.sparkSession.createDataFrame(list(names.itertuples(index=False, name=None)), "branch string, term string, label int")
    positive = pairs.join(F.broadcast(numbers), ["branch", "term"]).groupBy(F.col("entry_id").cast("string").alias("p_id")).agg(F.collect_set("label").alias("pos"))
    labelled = vectors.join(positive, F.col("entry_id").cast("string") == F.col("p_id"), "left")
    return vectors_by_fold(labelled.select("entry_id", "embedding", F.coalesce("pos", F.array().cast("array<int>")).alias("pos")), folds, "pos"), wanted


def fit_blocks(
    rows: DataFrame, wanted: pd.DataFrame, alpha: float = ALPHA, steps: int = 40, block: int = BLOCK, tolerance: float = 1e-4
) -> Iterator[list[Heads]]:
    """Heads of every (branch, held fold) of ``training_rows``, in pieces of at most ``block`` labels.

    The labels of a row are in the layout once, as numbers; a block picks its own.
    """
    rows = combined_rows(rows)
    scale = scalers(rows)
    for at in range(0, len(wanted), block):
        part = wanted.iloc[at : at + block].reset_index(drop=True)
        held = part["held_fold"].unique().tolist()
        # A block of one held fold does not read it.
        seen = rows.filter(F.col("fold") != held[0]) if len(held) == 1 and held[0] != -1 else rows
        w = _solve(seen, part, scale, alpha, steps, tolerance)
        yield [
            Heads(str(branch), int(fold), tuple(some["term"]), w[:-1, some.index], w[-1, some.index], *scale[int(fold)])
            for (branch, fold), some in part.groupby(["branch", "held_fold"], sort=True)
        ]


def _joined(pieces: list[Heads]) -> list[Heads]:
    """One head for each branch and fold, its labels in order."""
    out = []
    for key in sorted({(h.branch, h.held_fold) for h in pieces}):
        own = [h for h in pieces if (h.branch, h.held_fold) == key]
        terms = [t for h in own for t in h.terms]
        order = np.argsort(np.array(terms, object), kind="stable")
        coef, intercept = np.concatenate([h.coef for h in own], axis=1), np.concatenate([h.intercept for h in own])
        out.append(Heads(*key, tuple(terms[k] for k in order), coef[:, order], intercept[order], own[0].mean, own[0].std))
    return out


def fit_heads(
    vectors: DataFrame,
    folds: DataFrame,
    pairs: DataFrame,
    trainable: DataFrame,
    alpha: float = ALPHA,
    steps: int = 40,
    block: int = BLOCK,
    tolerance: float = 1e-4,
) -> list[Heads]:
    """Heads of every (branch, held fold) of ``trainable`` (branch, term, held_fold, n_pos, n_rows).

    ``vectors`` (entry_id, embedding), ``folds`` (entry_id, fold), ``pairs`` the positives
    (entry_id, branch, term). ``trainable`` is the bounded list of selected labels, which
    reaches the driver like the heads themselves. A head's scaler leaves its held fold out.
    A fit ends after ``steps`` steps, or when no partial derivative exceeds ``tolerance``.
    """
    pieces = fit_blocks(*training_rows(vectors, folds, pairs, trainable), alpha, steps, block, tolerance)
    return _joined([head for piece in pieces for head in piece])


def predict_top_k(vectors: DataFrame, heads: list[Heads], top_k: int | None = 100, min_score: float = 0.0) -> DataFrame:
    """(entry_id, term, branch, score): the best ``top_k`` labels per entry and head.

    ``vectors`` (entry_id, embedding) and, for heads with a held fold, ``fold``: such a head
    scores only the rows of its fold, a head with fold -1 scores all. No shuffle: one pass for
    each fold scores all branches; of ``vectors_by_fold`` it reads that fold only. A task holds
    the heads of one fold (whose labels their caps bound), sent as a broadcast of its own.
    """
    context = vectors.sparkSession.sparkContext
    by_fold = {k: context.broadcast([h for h in heads if h.held_fold == k]) for k in sorted({h.held_fold for h in heads})}
    return _passes(vectors, {k: (lambda sent: lambda: sent.value)(sent) for k, sent in by_fold.items()}, top_k, min_score)


def predict_stored(vectors: DataFrame, path: str, folds: list[int], top_k: int | None = 100, min_score: float = 0.0) -> DataFrame:
    """``predict_top_k`` with the heads of ``folds`` that ``store_heads`` wrote at ``path``.

    Each task reads the heads of its fold from the store; they don't pass the driver.
    """
    return _passes(vectors, {k: (lambda k: lambda: stored_heads(path, k))(k) for k in folds}, top_k, min_score)


def _passes(vectors: DataFrame, load: dict[int, Callable[[], list[Heads]]], top_k: int | None, min_score: float) -> DataFrame:
    fold = F.col("fold").cast("int") if "fold" in vectors.columns else F.lit(-1)
    chosen = vectors.select(F.col("entry_id").cast("string").alias("entry_id"), "embedding", fold.alias("fold"))
    rows = {k: chosen if k == -1 else chosen.filter(F.col("fold") == k) for k in load}
    scored = [_scored(rows[k], load[k], top_k, min_score) for k in load]
    return reduce(DataFrame.union, scored) if scored else chosen.sparkSession.createDataFrame([], PREDICTIONS)


def _scored(vectors: DataFrame, load: Callable[[], list[Heads]], top_k: int | None, min_score: float) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = None
        for batch in it:
            heads = load() if heads is None else heads
            for at in range(0, batch.num_rows, 2048):
                some = batch.slice(at, 2048)
                x = _matrix(some.column(1))
                for mine in heads:
                    scores = mine.scores(x)
                    order = np.argsort(-scores, axis=1, kind="stable")
                    order = order[:, :top_k] if top_k and top_k > 0 else order
                    best = np.take_along_axis(scores, order, axis=1)
                    row, column = np.nonzero(best >= min_score)
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column(0).take(pa.array(row)),
                            pa.array(np.array(mine.terms, object)[order[row, column]], pa.string()),
                            pa.array([mine.branch] * len(row), pa.string()),
                            pa.array(best[row, column].astype(float)),
                        ],
                        ["entry_id", "term", "branch", "score"],
                    )

    return vectors.select("entry_id", "embedding").mapInArrow(run, "entry_id string, term string, branch string, score double")


def cross_validate(
    vectors: DataFrame, folds: DataFrame, pairs: DataFrame, trainable: DataFrame, top_k: int | None = 100,
    min_score: float = 0.0, alpha: float = ALPHA, steps: int = 40, tolerance: float = 1e-4,
) -> tuple[DataFrame, list[Heads]]:
    """(out-of-fold predictions, all heads): each fold is scored by heads fitted without it; heads of fold -1 are the final ones."""
    rows, wanted = training_rows(vectors, folds, pairs, trainable)
    heads = _joined([head for piece in fit_blocks(rows, wanted, alpha, steps, tolerance=tolerance) for head in piece])
    return predict_top_k(rows, [h for h in heads if h.held_fold >= 0], top_k, min_score), heads


def cross_validate_stored(
    vectors: DataFrame, folds: DataFrame, pairs: DataFrame, trainable: DataFrame, path: str, top_k: int | None = 100,
    min_score: float = 0.0, alpha: float = ALPHA, steps: int = 40, tolerance: float = 1e-4,
) -> DataFrame:
    """Out-of-fold predictions as ``cross_validate``, with the heads stored at ``path``: the driver holds one block of labels at a time."""
    rows, wanted = training_rows(vectors, folds, pairs, trainable)
    done: set[int] = set()
    for piece in fit_blocks(rows, wanted, alpha, steps, tolerance=tolerance):
        store_heads(rows.sparkSession, piece, path, append=bool(done), known_folds=done)
        done |= {h.held_fold for h in piece}
    return predict_stored(rows, path, sorted(done - {-1}), top_k, min_score)


def heads_tables(spark: SparkSession, heads: list[Heads]) -> tuple[DataFrame, DataFrame]:
    """Heads as two tables to write: (branch, held_fold, term, coef, intercept), one row a label,
    and (held_fold, mean, std), one row a scaler."""
    columns = [(h.branch, h.held_fold, t, h.coef[:, k], float(h.intercept[k])) for h in heads for k, t in enumerate(h.terms)]
    scale = sorted({h.held_fold: (h.held_fold, h.mean, h.std) for h in heads}.values(), key=lambda r: r[0])
    return (
        spark.createDataFrame(_arrow(columns, "branch held_fold term coef intercept"), "branch string, held_fold int, term string, coef array<double>, intercept double"),
        spark.createDataFrame(_arrow(scale, "held_fold mean std"), "held_fold int, mean array<double>, std array<double>"),
    )


def _arrow(rows: list[tuple], names: str) -> pa.Table:
    return pa.table(dict(zip(names.split(), map(pa.array, map(list, zip(*rows, strict=True))), strict=True)))


def store_heads(spark: SparkSession, heads: list[Heads], path: str, append: bool = False, known_folds: set[int] = frozenset()) -> str:
    """Write the tables of ``heads`` at ``path``, in one folder a fold and branch; ``append`` keeps
    what is there. Scalers of ``known_folds`` are there already."""
    labels, scale = heads_tables(spark, heads)
    mode = "append" if append else "overwrite"
    labels.write.mode(mode).partitionBy("held_fold", "branch").parquet(f"{path}/labels")
    scale.filter(~F.col("held_fold").isin(list(known_folds))).write.mode(mode).partitionBy("held_fold").parquet(f"{path}/scalers")
    return path


def stored_heads(path: str, fold: int) -> list[Heads]:
    """The heads of one fold that ``store_heads`` wrote, read from the store in whatever process asks."""
    store, inner = arrow_store(path)

    def rows(table: str, columns: list[str]) -> pd.DataFrame:
        kind = pa_ds.partitioning(pa.schema([("held_fold", pa.int32()), ("branch", pa.string())]), flavor="hive")
        found = pa_ds.dataset(f"{inner}/{table}", filesystem=store, format="parquet", partitioning=kind)
        return found.to_table(columns=columns, filter=pa_ds.field("held_fold") == fold).to_pandas()

    scale = rows("scalers", ["mean", "std"]).iloc[0]
    labels = rows("labels", ["branch", "term", "coef", "intercept"]).sort_values(["branch", "term"], ignore_index=True)
    return [
        Heads(str(branch), fold, tuple(some["term"]), np.stack(some["coef"].to_list(), axis=1), some["intercept"].to_numpy(), scale["mean"], scale["std"])
        for branch, some in labels.groupby("branch", sort=True)
    ]
