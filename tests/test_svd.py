"""The randomised range finder against plain decompositions."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tandem.catalog import base
from tandem.operators import sparse, svd


def frame(spark, x, sparse_rows=True):
    make = (lambda r: Vectors.sparse(len(r), [(int(j), float(r[j])) for j in np.flatnonzero(r)])) if sparse_rows else (lambda r: Vectors.dense(r))
    return spark.createDataFrame([(k, make(r)) for k, r in enumerate(x)], ["id", "v"])


def angle(a, b):
    """Sine of the largest angle between two subspaces."""
    return np.linalg.norm(a - b @ (b.T @ a), 2)


def test_leading_subspace_of_a_slowly_falling_spectrum(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 150)) * (rng.random((400, 150)) < 0.1) * 0.97 ** np.arange(150)
    basis = svd.fit_svd(frame(spark, x), "v", 12)
    _, values, vectors = np.linalg.svd(x, full_matrices=False)
    np.testing.assert_allclose(basis.values, values[:12], rtol=1e-9)
    assert angle(basis.vectors, vectors[:12].T) < 1e-6
    assert (basis.vectors[np.abs(basis.vectors).argmax(axis=0), np.arange(12)] > 0).all()


def test_post_text_agrees_with_the_gramians_eigenvectors(spark, folder):
    block = base.post_block(spark, folder)
    rows = block.transform(base.post_tokens(spark, folder))
    basis = svd.fit_svd(rows, "text_vec", 10)
    values, vectors = np.linalg.eigh(svd.gramian(rows, "text_vec"))
    np.testing.assert_allclose(basis.values ** 2, values[::-1][:10], rtol=1e-9)
    assert angle(basis.vectors, vectors[:, ::-1][:, :10]) < 1e-6


def test_no_matrix_of_columns_by_columns(spark):
    """A hundred thousand columns: their Gramian would take 80 GB."""
    import resource

    rng = np.random.default_rng(4)
    width, rows = 100_000, []
    for k in range(300):
        at = np.sort(rng.choice(width, 40, replace=False))
        cells = rng.normal(size=40)
        rows.append((k, Vectors.sparse(width, [0, *(at[at > 0]).tolist()], [5.0, *cells[at > 0].tolist()])))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    basis = svd.fit_svd(spark.createDataFrame(rows, ["id", "v"]), "v", 3, tolerance=1e-6)
    assert basis.vectors.shape == (width, 3) and basis.vectors[0, 0] > 0.99
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 2_000_000
    np.testing.assert_allclose(basis.vectors.T @ basis.vectors, np.eye(3), atol=1e-9)


def test_projection_of_empty_dense_and_sparse_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(30, 6))
    x[::4] = 0.0
    for kind in (True, False):
        df = frame(spark, x, kind)
        basis = svd.fit_svd(df, "v", 6)
        got = {r["id"]: r["text_svd"].toArray() for r in svd.project(df, "v", basis).collect()}
        np.testing.assert_allclose(np.array([got[k] for k in range(30)]), x @ basis.vectors, atol=1e-12)


def test_more_rank_than_columns_and_no_rows(spark):
    df = frame(spark, np.eye(3))
    with pytest.warns(UserWarning, match="rank 7"):
        assert svd.fit_svd(df, "v", 7).rank == 3
    with pytest.warns(UserWarning):
        assert svd.fit_svd(df.limit(0), "v", 2).rank == 0


def test_blocks_multiply_like_matrices():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(50, 9)) * (rng.random((50, 9)) < 0.3)
    x[7] = 0
    row, column = np.nonzero(x)
    block = sparse.Block.of(np.zeros(50), row, column, x[row, column])
    for k in (1, 3, 200):
        w = rng.normal(size=(9, k))
        np.testing.assert_allclose(block.times(w), x @ w, atol=1e-12)
        total, factors = np.zeros((9, k)), rng.normal(size=(50, k))
        block.add_times(factors, total)
        np.testing.assert_allclose(total, x.T @ factors, atol=1e-12)


def test_narrow_rows_are_scanned_once(spark, monkeypatch):
    """Products of the columns, summed in one scan, give what multiplying the rows each time gives."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 70)) * (rng.random((300, 70)) < 0.2) * 0.95 ** np.arange(70)
    scans = []
    counted = svd.summed
    monkeypatch.setattr(svd, "summed", lambda *a: (scans.append(1), counted(*a))[1])
    monkeypatch.setattr(svd, "PRODUCT_STRIP", 32)
    monkeypatch.setattr(svd, "PRODUCT_ROWS", 128)
    once = svd.fit_svd(frame(spark, x), "v", 5)
    assert len(scans) == 1
    monkeypatch.setattr(svd, "PRODUCT_COLUMNS", 0)
    each = svd.fit_svd(frame(spark, x), "v", 5)
    assert len(scans) > 2
    np.testing.assert_allclose(once.values, np.linalg.svd(x)[1][:5], rtol=1e-9)
    np.testing.assert_allclose(once.vectors, each.vectors, atol=1e-6)


def test_stored_blocks_are_small_whatever_the_rows(spark, monkeypatch):
    """A block of long rows was megabytes, and a file's buffers were looked at after a hundred blocks."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(sparse, "dealt", lambda df: df.repartition(1))
    x = np.random.default_rng(8).normal(size=(12_000, 200))
    blocks = sparse.store_vectors(frame(spark, x, sparse_rows=False), "v")
    sizes = [len(r["cells"]) // 8 for r in blocks.select("cells").collect()]
    assert sum(sizes) == x.size and max(sizes) <= sparse.BLOCK_CELLS
    metas = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in blocks.inputFiles()]
    groups = [m.row_group(k).total_byte_size for m in metas for k in range(m.num_row_groups)]
    assert len(groups) > 1 and max(groups) < 4 * int(sparse.FILES["parquet.block.size"])
    assert spark.conf.get(sparse.BATCH_KEY) == "67108864b"
