"""Sparse rows in blocks: how they are stored, read, multiplied and summed.

A block holds the cells of a few thousand vectors as flat arrays in order of row. Sums over rows are made per task and
then added up by Spark, cell by cell, so the driver receives one number per column and quantity.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tandem.session import stage

#: Rows of a block, its cells, about, the most rows of a task that writes them, and the columns a block is stored in.
BLOCK_ROWS, BLOCK_CELLS, TASK_ROWS = 4096, 1 << 18, 1 << 18
PAYLOAD = ("labels", "rows", "columns", "cells", "by_column")
_KINDS = ("<f8", "<i4", "<i4", "<f8", "<i4")
#: A block is a row of megabytes: the writer looks at its buffers after each one, not after a hundred, and readers get a few at once.
FILES = {"parquet.block.size": str(1 << 24), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "4", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "4"}
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 24
#: Cells that are multiplied at once, and numbers that are sent together.
STRIP, PIECE = 1 << 16, 1 << 13


def _add_runs(out: np.ndarray, key: np.ndarray, starts: np.ndarray, factors: np.ndarray, other: np.ndarray, cells: np.ndarray) -> None:
    """Add to the rows of ``out`` named by sorted keys: the sum over a key's run of cell times the factors of ``other``.

    Runs are taken a strip at a time, so the products held at once are few whatever the block's size.
    """
    edges = np.append(starts, len(key))
    wide, first = max(64, STRIP // max(1, out.shape[1])), 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(edges, edges[first] + wide, side="right")) - 1)
        a, b = edges[first], edges[last]
        products = factors[other[a:b]]
        products *= cells[a:b, None]
        out[key[edges[first:last]]] += np.add.reduceat(products, edges[first:last] - a, axis=0)
        first = last


@dataclass
class Block:
    """Sparse rows in order of row, and the order of their cells by column."""

    labels: np.ndarray
    row: np.ndarray
    column: np.ndarray
    cell: np.ndarray
    by_column: np.ndarray

    def __post_init__(self) -> None:
        self.row_starts = np.flatnonzero(np.diff(self.row, prepend=-1))
        self.column_starts = np.flatnonzero(np.diff(self.column[self.by_column], prepend=-1))

    @classmethod
    def of(cls, labels: np.ndarray, row: np.ndarray, column: np.ndarray, cell: np.ndarray) -> Block:
        return cls(labels, row, column, cell, np.argsort(column, kind="stable"))

    def stored(self) -> list[pa.Array]:
        parts = (self.labels, self.row, self.column, self.cell, self.by_column)
        return [pa.array([p.astype(t).tobytes()], pa.binary()) for p, t in zip(parts, _KINDS)]

    def times(self, weights: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """rows x k: each row's cells times weights of columns x k, added to ``out`` if given."""
        if out is None:
            out = np.zeros((len(self.labels), weights.shape[1]))
        _add_runs(out, self.row, self.row_starts, weights, self.column, self.cell)
        return out

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """rows x problems, for weights of columns x problems; the last row of weights is the intercepts."""
        return self.times(weights[:-1], np.tile(weights[-1], (len(self.labels), 1)))

    def add_sums(self, factors: np.ndarray, total: np.ndarray, power: int = 1) -> None:
        """Add to columns x problems: each column's sum of a row's factor times its cell."""
        self.add_times(factors, total, power)
        total[-1] += factors.sum(axis=0)

    def add_times(self, factors: np.ndarray, total: np.ndarray, power: int = 1) -> None:
        """The same without an intercept."""
        cells = (self.cell**power if power != 1 else self.cell)[self.by_column]
        _add_runs(total, self.column[self.by_column], self.column_starts, factors, self.row[self.by_column], cells)


def from_vectors(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, cell) of the non-zeros of stored vectors, sparse or dense."""
    values, indices = vectors.field("values"), vectors.field("indices")
    sizes = np.diff(values.offsets.to_numpy())
    first = values.offsets.to_numpy()[:-1]
    cell = values.values.to_numpy(zero_copy_only=False)[first[0] if len(first) else 0 :][: sizes.sum()]
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(cell)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    named = indices.values.to_numpy(zero_copy_only=False)[indices.offsets.to_numpy()[0] : indices.offsets.to_numpy()[-1]]
    column[sparse[row]] = named
    kept = cell != 0
    return row[kept], column[kept], cell[kept]


def flat_vector(vector: str) -> Column:
    """A vector as (type, indices, values), without nulls."""
    v = F.unwrap_udt(vector)
    return F.struct(v["type"].alias("type"), F.coalesce(v["indices"], F.array().cast("array<int>")).alias("indices"), v["values"].alias("values"))


def read(batch: pa.RecordBatch, k: int) -> Block:
    return Block(*[np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in zip(PAYLOAD, _KINDS)])


def _unlabelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(np.diff(batch.column("v").field("values").offsets.to_numpy()))
        k = 0
        while k < batch.num_rows:
            end = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + BLOCK_CELLS, side="right")))
            some = batch.slice(k, min(BLOCK_ROWS, end - k))
            k += some.num_rows
            yield pa.RecordBatch.from_arrays(Block.of(np.zeros(some.num_rows), *from_vectors(some.column("v"))).stored(), list(PAYLOAD))


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt evenly, over the cores at least: they are scanned again and again, and each scan waits for its slowest task.

    A task gets TASK_ROWS rows at most, so what it reads doesn't grow with the table.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS)))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands rows to Python in batches of BATCH_BYTES, about."""
    before = spark.conf.get(BATCH_KEY, None)
    spark.conf.set(BATCH_KEY, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_KEY)
        else:
            spark.conf.set(BATCH_KEY, before)


def store_vectors(df: DataFrame, vector: str) -> DataFrame:
    """The vectors of a column as stored blocks; null vectors are left out."""
    flat = dealt(df.where(F.col(vector).isNotNull()).select(flat_vector(vector).alias("v")))
    with small_batches(df.sparkSession):
        return stage(flat.mapInArrow(_unlabelled, ", ".join(f"{c} binary" for c in PAYLOAD)), "vectors", options=FILES)


def summed(df: DataFrame, run, shape: tuple[int, ...]) -> np.ndarray:
    """What ``run(block, total)`` adds up over all blocks, in an array of the given shape.

    Each task keeps one array. Its pieces, those that are not zero, are dealt out by their number and added up by
    other tasks, so no task and no message but the result holds more than one task's share.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for k in range(batch.num_rows):
                total = np.zeros(shape) if total is None else total
                run(read(batch, k), total)
        if total is not None:
            flat = total.ravel()
            for k in range(0, len(flat), PIECE):
                if flat[k : k + PIECE].any():
                    yield pa.RecordBatch.from_arrays([pa.array([k // PIECE], pa.int32()), pa.array([flat[k : k + PIECE].tobytes()], pa.binary())], ["piece", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch.column("piece").to_pylist(), batch.column("data")):
                values = np.frombuffer(data.as_buffer())
                held[piece] = held[piece] + values if piece in held else values
        for piece, values in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([values.tobytes()], pa.binary())], ["piece", "data"])

    kind = "piece int, data binary"
    with small_batches(df.sparkSession):
        table = df.select(*PAYLOAD).mapInArrow(each, kind).repartition("piece").mapInArrow(add, kind).toArrow()
    out = np.zeros(int(np.prod(shape)))
    for piece, data in zip(table["piece"].to_pylist(), table["data"]):
        out[piece * PIECE : (piece + 1) * PIECE] = np.frombuffer(data.as_buffer())
    return out.reshape(shape)
