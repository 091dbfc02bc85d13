"""Several linear models fitted together: one scan of the rows serves all of them.

Rows are stored once, as sparse blocks of a few thousand. A problem is a strength, a penalty, class weights and the
columns it may use; the coefficients of all problems travel together, and each scan returns all their losses and
gradients, summed by Spark per (problem, column). The driver holds coefficients only. Every problem is stepped by its
own optimiser; those that have converged drop out of later scans.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from tandem.operators.sparse import BLOCK_ROWS, PAYLOAD, Block, dealt, flat_vector, from_vectors, read, summed
from tandem.session import local_rows, stage

#: Columns in the dense part of the starting curvature, and rows that are filled in for it at once.
CURVATURE_COLUMNS, CURVATURE_ROWS = 1024, 512
#: Newton decrement at which a problem has converged, and the most scans.
TOLERANCE, MOST_SCANS = 1e-10, 500
_BLOCK = ", ".join(["split string", "ids array<long>", *[f"{c} binary" for c in PAYLOAD]])


@dataclass(frozen=True)
class Problem:
    """One model to fit; ``columns`` is a mask over the stored columns, or None for all."""

    C: float = 1.0
    penalty: str = "l2"
    balanced: bool = False
    columns: tuple[bool, ...] | None = field(default=None, repr=False)


def _writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = batch.column("split").to_pylist()
        for name in sorted(set(parts)):
            at = np.flatnonzero([p == name for p in parts])
            for k in range(0, len(at), BLOCK_ROWS):
                some = batch.take(pa.array(at[k : k + BLOCK_ROWS]))
                block = Block.of(some.column("target").to_numpy(zero_copy_only=False), *from_vectors(some.column("v")))
                ids = pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), some.column("id"))
                yield pa.RecordBatch.from_arrays([pa.array([name]), ids, *block.stored()], ["split", "ids", *PAYLOAD])


@dataclass
class Rows:
    """Stored sparse blocks of labelled rows, in files by split."""

    blocks: DataFrame
    width: int

    def part(self, *splits: str) -> DataFrame:
        return self.blocks.where(F.col("split").isin(*splits))


def store(rows: DataFrame, width: int | None = None, vector: str = "features") -> Rows:
    """Write (id, split, target, vector) rows as blocks, once for all fits and predictions over them.

    Rows without a label are left out: they can neither teach nor be scored. Without ``width`` it is the first vector's.
    """
    if width is None:
        first = rows.select(vector).first()
        width = first[0].size if first else 0
    flat = rows.where("target is not null").select(
        F.col("id").cast("long").alias("id"), "split", F.col("target").cast("double").alias("target"), flat_vector(vector).alias("v"))
    return Rows(stage(dealt(flat).mapInArrow(_writer, _BLOCK), "blocks", ("split",)), width)


# --- one scan ---------------------------------------------------------------

def row_weights(labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """rows x problems; ``weights`` holds each problem's weight of a negative and of a positive row."""
    return np.where(labels[:, None] == 1, weights[1], weights[0])


def _gradients(spark: SparkSession, train: DataFrame, width: int, coefficients: np.ndarray, weights: np.ndarray, kind: str = "error") -> np.ndarray:
    """(width + 2) x problems: sums over rows of the weighted error times each cell, of the error (intercept), and the loss.

    With ``kind`` "expected" or "seen" the first are sums of the probability, or of the label, instead of the error.
    """
    shared = spark.sparkContext.broadcast((coefficients, weights))

    def run(block: Block, total: np.ndarray) -> None:
        w, balance = shared.value
        m, y = block.margins(w), block.labels[:, None]
        each = row_weights(block.labels, balance)
        p = 0.5 * (1.0 + np.tanh(0.5 * m))
        factor = {"error": p - y, "expected": p, "seen": np.broadcast_to(y, p.shape)}[kind]
        block.add_sums(each * factor, total[:-1])
        total[-1] += (each * (np.logaddexp(0.0, m) - y * m)).sum(axis=0)

    out = summed(train, run, (width + 2, coefficients.shape[1]))
    shared.unpersist()
    return out


def _totals(train: DataFrame, width: int) -> tuple[float, float, np.ndarray]:
    """(rows, positives, second moment sums of the columns and the intercept)."""

    def run(block: Block, total: np.ndarray) -> None:
        block.add_sums(np.ones((len(block.labels), 1)), total[:-1], power=2)
        total[-1] += block.labels.sum()

    found = summed(train, run, (width + 2, 1))[:, 0]
    return found[-2], found[-1], found[:-1]


def _curvature(train: DataFrame, width: int, n: float, moments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(columns, their mean products) of the CURVATURE_COLUMNS columns with the largest moments, and the intercept: one scan.

    A starting point for the optimisers' own curvature: it decides how many scans they take, not what they find. It
    counts all rows, since columns that add up to one another must do so here as well.
    """
    chosen = np.sort(np.argsort(-moments[:width], kind="stable")[:CURVATURE_COLUMNS])
    chosen = np.append(chosen[moments[chosen] > 0], width)
    place = np.full(width + 1, -1, np.int64)
    place[chosen] = np.arange(len(chosen))

    def run(block: Block, total: np.ndarray) -> None:
        kept = place[block.column] >= 0
        row, column, cell = block.row[kept], place[block.column[kept]], block.cell[kept]
        for first in range(0, len(block.labels), CURVATURE_ROWS):
            some = slice(*np.searchsorted(row, (first, first + CURVATURE_ROWS)))
            filled = np.zeros((min(CURVATURE_ROWS, len(block.labels) - first), len(chosen)))
            filled[row[some] - first, column[some]] = cell[some]
            filled[:, -1] = 1.0
            total += filled.T @ filled

    return chosen, summed(train, run, (len(chosen), len(chosen))) / n


# --- optimisers: each yields a point and is sent its mean loss and gradient ---

Steps = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


class Curvature:
    """share * products + penalty over a problem's columns: dense for the chosen ones, squares alone for the others."""

    def __init__(self, chosen: np.ndarray, products: np.ndarray, moments: np.ndarray, mask: np.ndarray, share: float = 0.2) -> None:
        self.inside = np.flatnonzero(mask[chosen])
        self.at = chosen[self.inside]
        self.products = share * products[np.ix_(self.inside, self.inside)]
        self.values, self.vectors = np.linalg.eigh(self.products) if len(self.at) else (np.zeros(0), np.zeros((0, 0)))
        self.rest = share * moments
        self.mask = mask

    def solve(self, g: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        strength = penalty[:-1].max(initial=0.0)
        out = np.where(self.mask, g / np.maximum(self.rest + penalty, 1e-12), 0.0)
        if len(self.at):
            out[self.at] = self.vectors @ ((self.vectors.T @ g[self.at]) / np.maximum(self.values + strength, 1e-12))
        return out


def smooth_steps(curvature: Curvature, penalty: np.ndarray, tolerance: float = TOLERANCE, kept: int = 12) -> Steps:
    """L-BFGS from the given curvature, for a squared penalty."""
    w = np.zeros(len(penalty))
    penalised = lambda w, found: (found[0] + 0.5 * (penalty * w * w).sum(), np.where(curvature.mask, found[1] + penalty * w, 0.0))
    f, g = penalised(w, (yield w))
    past: deque = deque(maxlen=kept)
    while True:
        d, factors = g.copy(), []
        for s, y, sy in reversed(past):
            factors.append((s @ d) / sy)
            d -= factors[-1] * y
        d = curvature.solve(d, penalty)
        for (s, y, sy), a in zip(past, reversed(factors)):
            d += (a - (y @ d) / sy) * s
        slope = g @ d
        if slope <= tolerance**2:
            return w
        step = 1.0
        while True:
            new = w - step * d
            f_new, g_new = penalised(new, (yield new))
            if f_new <= f - 1e-4 * step * slope + 1e-14 * abs(f) or step < 1e-8:
                break
            step *= 0.5
        s, y = new - w, g_new - g
        if s @ y > 1e-16 * (s @ s) and (s @ y) > 0:
            past.append((s, y, s @ y))
        if step < 1e-8:
            return w
        w, f, g = new, f_new, g_new


def sparse_steps(curvature: Curvature, penalty: np.ndarray, tolerance: float = TOLERANCE) -> Steps:
    """Proximal steps for an absolute penalty: each minimises a quadratic model plus the penalty, coordinate by coordinate.

    The model's curvature is an upper bound, raised where a step does not gain what it promised.
    """
    w = np.zeros(len(penalty))
    f, g = yield w
    raised = 1.25  # from the share of 0.2 to the bound of a quarter
    columns = np.flatnonzero(curvature.mask)
    place = np.full(len(penalty), -1)
    place[curvature.at] = np.arange(len(curvature.at))
    while True:
        square = np.maximum(raised * curvature.rest, 1e-12)
        dense = raised * curvature.products
        if len(curvature.at):
            square[curvature.at] = np.maximum(np.diag(dense), 1e-12)
        d, pull, live = np.zeros(len(w)), np.zeros(len(curvature.at)), columns
        for sweep in range(400):
            largest = 0.0
            for j in live:
                k = place[j]
                slope = g[j] + (pull[k] if k >= 0 else square[j] * d[j])
                target = w[j] + d[j] - slope / square[j]
                target = np.sign(target) * max(abs(target) - penalty[j] / square[j], 0.0)
                move = target - w[j] - d[j]
                if move:
                    d[j] += move
                    if k >= 0:
                        pull += dense[:, k] * move
                    largest = max(largest, abs(move) * square[j] ** 0.5)
            if largest < 0.01 * tolerance:
                if len(live) == len(columns):
                    break
                live = columns
            else:  # between full sweeps, only what is not zero
                live = columns[(w + d)[columns] != 0] if sweep % 10 else columns
        if (square * d * d).sum() <= tolerance**2:
            return w
        new = w + d
        gain = (penalty * (np.abs(w) - np.abs(new))).sum() - g @ d
        found = yield new
        if f - found[0] + (penalty * (np.abs(w) - np.abs(new))).sum() < 1e-4 * gain - 1e-14 * abs(f):
            raised *= 2.0
            if raised > 1e6:
                return w
            continue
        w, (f, g) = new, found


@dataclass
class Fitted:
    """Coefficients (problems x columns) and intercepts, and how many scans were made."""

    problems: list[Problem]
    coefficients: np.ndarray
    intercepts: np.ndarray
    scans: int
    n: int

    def some(self, chosen) -> Fitted:
        chosen = list(chosen)
        return Fitted([self.problems[k] for k in chosen], self.coefficients[chosen], self.intercepts[chosen], self.scans, self.n)

    @property
    def points(self) -> np.ndarray:
        return np.vstack([self.coefficients.T, self.intercepts])


def class_weights(problem: Problem, n: float, positives: float) -> tuple[float, float]:
    """Weights of a negative and a positive row; balanced ones are n / (2 * rows of the class) and sum to n."""
    if not problem.balanced:
        return 1.0, 1.0
    return n / (2.0 * max(n - positives, 1)), n / (2.0 * max(positives, 1))


def fit(rows: Rows, problems: list[Problem], splits: tuple[str, ...] = ("train",), tolerance: float = TOLERANCE, most_scans: int = MOST_SCANS) -> Fitted:
    """Fit all problems on the given splits. A larger ``C`` penalises less; the intercept is free.

    The loss is a mean over rows and the strength 1 / (C * rows), as in a single fit.
    """
    if any(p.penalty not in ("l1", "l2") for p in problems):
        raise ValueError("a penalty is l1 or l2")
    spark, train, width = rows.blocks.sparkSession, rows.part(*splits), rows.width
    n, positives, moments = _totals(train, width)
    if not n:
        raise ValueError("there are no rows to learn from")
    chosen, products = _curvature(train, width, n, moments)
    weights = np.array([class_weights(p, n, positives) for p in problems]).T
    shapes: dict[tuple, Curvature] = {}
    steps, points = [], []
    for p in problems:
        mask = np.append(np.ones(width, bool) if p.columns is None else np.array(p.columns, bool), True)
        mask[:-1] &= moments[:-1] > 0
        if mask.tobytes() not in shapes:
            shapes[mask.tobytes()] = Curvature(chosen, products, moments / n, mask)
        penalty = np.append(np.full(width, 1.0 / (p.C * n)), 0.0)
        steps.append((smooth_steps if p.penalty == "l2" else sparse_steps)(shapes[mask.tobytes()], penalty, tolerance))
        points.append(next(steps[-1]))
    active, scans = list(range(len(problems))), 0
    while active and scans < most_scans:
        found = _gradients(spark, train, width, np.stack([points[k] for k in active], axis=1), weights[:, active]) / n
        scans += 1
        still = []
        for at, k in enumerate(active):
            try:
                points[k] = steps[k].send((found[-1, at], found[:-1, at]))
                still.append(k)
            except StopIteration as done:
                points[k] = done.value
        active = still
    whole = np.stack(points)
    return Fitted(list(problems), whole[:, :-1], whole[:, -1], scans, int(n))


# --- using what was fitted --------------------------------------------------

def predict(rows: Rows, fitted: Fitted, names: list[str], splits: tuple[str, ...] = ("val", "test")) -> DataFrame:
    """(id, split, model, label, proba) of every row for every model, from one scan."""
    spark = rows.blocks.sparkSession
    shared = spark.sparkContext.broadcast(fitted.points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = read(batch, k)
                p = 0.5 * (1.0 + np.tanh(0.5 * block.margins(shared.value)))
                n = len(block.labels)
                ids, split = batch.column("ids")[k].values, pa.array([batch.column("split")[k].as_py()] * n, pa.string())
                label = pa.array(block.labels.astype(np.int32))
                for j, name in enumerate(names):
                    yield pa.RecordBatch.from_arrays([ids, split, pa.array([name] * n, pa.string()), label, pa.array(np.ascontiguousarray(p[:, j]))], ["id", "split", "model", "label", "proba"])

    return rows.part(*splits).mapInArrow(run, "id long, split string, model string, label int, proba double")


def sums(rows: Rows, fitted: Fitted, kind: str, splits: tuple[str, ...] = ("train",)) -> np.ndarray:
    """problems x (columns + 1): weighted sums over rows of the probability ("expected") or label ("seen") times each cell;
    the last is the intercept's. At an L2 optimum, seen - expected = coefficient / C."""
    spark = rows.blocks.sparkSession
    n, positives, _ = _totals(rows.part(*splits), rows.width)
    weights = np.array([class_weights(p, n, positives) for p in fitted.problems]).T
    return _gradients(spark, rows.part(*splits), rows.width, fitted.points, weights, kind)[:-1].T


def balance(rows: Rows, fitted: Fitted, names: list[str], features: list[str]) -> DataFrame:
    """(model, feature, balance): expected sum over train plus the penalty's pull, for the columns a model uses.

    At the optimum of an L2 problem it is the sum over the positive rows, whatever the coefficients are; the
    intercept's has no pull.
    """
    spark = rows.blocks.sparkSession
    found = sums(rows, fitted, "expected")
    present = _totals(rows.part("train"), rows.width)[2][:-1] > 0
    out: dict[str, list] = {"model": [], "feature": [], "balance": []}
    for k, (name, p) in enumerate(zip(names, fitted.problems)):
        mask = present if p.columns is None else present & np.array(p.columns, bool)
        at = np.flatnonzero(mask)
        out["model"] += [name] * (len(at) + 1)
        out["feature"] += [features[j] for j in at] + ["intercept"]
        out["balance"] += (found[k, at] + fitted.coefficients[k, at] / p.C).tolist() + [float(found[k, -1])]
    return local_rows(spark, out, "model string, feature string, balance double")


def spark_model(spark: SparkSession, coefficients: np.ndarray, intercept: float) -> LogisticRegressionModel:
    """The same model for ML pipelines and their files; its feature column is ``features``."""
    sc = spark.sparkContext
    made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(LogisticRegressionModel._randomUID(), _py2java(sc, Vectors.dense(coefficients)), float(intercept))
    return LogisticRegressionModel(made)
