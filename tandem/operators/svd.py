"""Uncentred truncated SVD of a sparse vector column.

The leading directions are found by a randomised range finder: a block of a few more directions than asked is multiplied
by the rows and back, and turned towards the leading ones by polynomials of that product. Up to PRODUCT_COLUMNS columns
their products by each other are summed in one scan and every multiplication reads those; wider rows are scanned each
time, and the driver holds columns x directions only. Rows never leave the executors.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

from tandem import config as cfg
from tandem.operators.sparse import Block, store_vectors, summed
from tandem.operators.textblock import TextBlock, vector_array

#: Columns whose products by each other are summed at once, rows that are filled in for it together, and columns of a strip.
PRODUCT_COLUMNS, PRODUCT_ROWS, PRODUCT_STRIP = 4096, 512, 256


@dataclass
class Basis:
    """Right singular vectors (columns x rank) and singular values."""

    vectors: np.ndarray
    values: np.ndarray

    @property
    def rank(self) -> int:
        return len(self.values)


def gramian(df: DataFrame, vector: str) -> np.ndarray:
    """Sum of x xT over all rows, columns x columns: what the range finder is tested against.

    Each task holds one packed triangle, so tasks are kept to a few per core
    rather than one per file split.
    """
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    rows = MLUtils.convertVectorColumnsFromML(df.select(vector), vector).coalesce(tasks)
    return RowMatrix(rows).computeGramianMatrix().toArray()


def gramian_table(df: DataFrame, vector: str, block: TextBlock) -> DataFrame:
    """(term_a, term_b, dot) for term_a <= term_b with a non-zero product, summed from the rows' own pairs."""
    rows = df.select(F.explode(F.array(vector_array(vector))).alias("cells"))
    later = lambda k: F.slice("cells", k + 1, F.size("cells"))
    pairs = F.flatten(F.transform("cells", lambda a, k: F.transform(later(k), lambda c: F.struct(
        a["idx"].alias("i"), c["idx"].alias("j"), (a["weight"] * c["weight"]).alias("dot")))))
    sums = (rows.select(F.explode(pairs).alias("p")).select("p.*").groupBy("i", "j")
            .agg(F.sum("dot").alias("dot")).where("dot <> 0"))
    terms = block.table.select("idx", "term")
    return (sums.join(terms.toDF("i", "term_a"), "i").join(terms.toDF("j", "term_b"), "j")
            .select("term_a", "term_b", "dot"))


def _products(blocks: DataFrame, width: int) -> np.ndarray:
    """Sum over rows of x xT: one scan. Tasks add up strips of the upper triangle, the driver mirrors them."""
    edges = [*range(0, width, PRODUCT_STRIP), width]
    strips = list(zip(edges, edges[1:]))
    ends = np.cumsum([0] + [(b - a) * (width - a) for a, b in strips])

    def run(block: Block, total: np.ndarray) -> None:
        for first in range(0, len(block.labels), PRODUCT_ROWS):
            some = slice(*np.searchsorted(block.row, (first, first + PRODUCT_ROWS)))
            filled = np.zeros((min(PRODUCT_ROWS, len(block.labels) - first), width))
            filled[block.row[some] - first, block.column[some]] = block.cell[some]
            for (a, b), at in zip(strips, ends):
                part = total[at : at + (b - a) * (width - a)].reshape(b - a, width - a)
                part += filled[:, a:b].T @ filled[:, a:]

    found = summed(blocks, run, (int(ends[-1]),))
    out = np.zeros((width, width))
    for (a, b), at in zip(strips, ends):
        out[a:b, a:] = found[at : at + (b - a) * (width - a)].reshape(b - a, width - a)
        out[a:, a:b] = out[a:b, a:].T
    return out


def _times_gramian(blocks: DataFrame, directions: np.ndarray) -> np.ndarray:
    """Sum over rows of x (x . directions): one scan."""
    shared = blocks.sparkSession.sparkContext.broadcast(directions)

    def run(block: Block, total: np.ndarray) -> None:
        block.add_times(block.times(shared.value), total)

    out = summed(blocks, run, directions.shape)
    shared.unpersist()
    return out


def fit_svd(df: DataFrame, vector: str, rank: int, spare: int | None = None, degree: int = 8, tolerance: float = 1e-8,
            most_scans: int = 200, seed: int = cfg.SEED) -> Basis:
    """Leading right singular vectors; each one's largest entry is positive.

    ``spare`` directions beyond ``rank`` (as many again, 10 at least) save scans where the values fall slowly. Between two exact
    rotations the block is filtered by a Chebyshev polynomial that holds everything below its smallest value down.
    It ends when rows, times a direction and back, leave it but for ``tolerance`` of the largest value.
    """
    blocks = store_vectors(df, vector)
    first = df.where(F.col(vector).isNotNull()).select(vector).first()
    width = first[0].size if first else 0
    if rank > width:
        warnings.warn(f"rank {rank} asked of {width} columns: the basis has {width}", stacklevel=2)
        rank = width
    if not rank:
        return Basis(np.zeros((width, 0)), np.zeros(0))
    size = min(width, rank + (max(10, rank) if spare is None else spare))
    if width <= PRODUCT_COLUMNS:
        products = _products(blocks, width)
        times = lambda directions: products @ directions
    else:
        times = lambda directions: _times_gramian(blocks, directions)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
    z, scans = times(q), 1
    while True:
        values, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
        order = np.argsort(values)[::-1]
        values, q, z = values[order], q @ turn[:, order], z @ turn[:, order]
        left = np.linalg.norm(z[:, :rank] - q[:, :rank] * values[:rank], axis=0).max()
        if size == width or left <= tolerance * max(values[0], 1e-300):
            break
        if scans >= most_scans:
            warnings.warn(f"after {scans} scans directions still move by {left / values[0]:.1e}", stacklevel=2)
            break
        half = max(values[-1], 1e-12 * values[0]) / 2
        before, now = q, (z - half * q) / half
        for _ in range(degree - 1):
            scale = np.linalg.norm(now, axis=0)
            before, now = before / scale, now / scale
            before, now = now, 2.0 / half * (times(now) - half * now) - before
            scans += 1
        q = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
        z = times(q)
        scans += 1
    v = q[:, :rank]
    lead = v[np.argmax(np.abs(v), axis=0), np.arange(rank)]
    return Basis(v * np.where(lead < 0, -1.0, 1.0), np.sqrt(np.maximum(values[:rank], 0)))


def project(df: DataFrame, vector: str, basis: Basis, out: str = "text_svd") -> DataFrame:
    """Row times basis, a bounded number of cells at once; the basis travels once per executor."""
    shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(basis.vectors))

    @F.pandas_udf("array<double>")
    def dot(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        v = shared.value
        for cells in batches:
            weights = [np.asarray(w) for w in cells["values"]]
            columns = [np.arange(len(w)) if i is None else np.asarray(i) for i, w in zip(cells["indices"], weights)]
            sizes = [len(w) for w in weights]
            row = np.repeat(np.arange(len(sizes)), sizes)
            block = Block.of(np.zeros(len(sizes)), row, np.concatenate([*columns, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*weights, np.zeros(0)]))
            yield pd.Series(list(block.times(v)))

    return df.withColumn(out, array_to_vector(dot(F.unwrap_udt(vector))))
