import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.operators import ordering, tabular as tab

rng = np.random.default_rng(5)
SHAPES = {
    "uniform": rng.uniform(size=3000),
    "skewed": rng.lognormal(8, 3, size=3000),
    "a third share one value": np.concatenate([np.full(1000, 0.5), rng.uniform(size=2000)]),
    "constant": np.full(200, 7.0),
    "two rows": np.array([1.0, 2.0]),
    "one row": np.array([4.0]),
    "integers": rng.integers(0, 9, size=2000).astype(float),
    "narrow": 1.0 + rng.uniform(size=1500) * 1e-9,
}


@pytest.mark.parametrize("name", SHAPES)
def test_quantiles_are_exact(spark, name):
    x = SHAPES[name]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = ordering.quantile_values(df, "x", probs)
    np.testing.assert_allclose(got, np.quantile(x, probs), rtol=1e-12)


def test_quantiles_skip_nulls_and_take_many_columns(spark):
    df = spark.createDataFrame([(1.0, 10), (None, 20), (3.0, None), (5.0, 40)], "a double, b int")
    rows = {(r["column"], r["prob"]): r["value"] for r in
            ordering.exact_quantiles(df, ["a", "b"], [0.25, 0.5]).collect()}
    assert rows == {("a", 0.25): 2.0, ("a", 0.5): 3.0, ("b", 0.25): 15.0, ("b", 0.5): 20.0}


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("name", ["uniform", "a third share one value", "integers", "constant"])
def test_running_totals(spark, name, descending):
    x = SHAPES[name]
    g = np.arange(len(x)) % 2
    df = spark.createDataFrame([(int(k), float(v)) for k, v in zip(g, x)], "g int, x double")
    rows = ordering.running_totals(df, "x", {"n": F.lit(1)}, ("g",), descending=descending).collect()
    seen = {(r["g"], r["x"]): (r["n"], r["n_before"]) for r in rows}
    want = {}
    for k in (0, 1):
        part = x[g == k]
        for v in set(part.tolist()):
            before = (part > v) if descending else (part < v)
            want[k, v] = (int((part == v).sum()), int(before.sum()))
    assert seen == want


def test_edges_merge_repeated_quantiles(spark):
    x = np.concatenate([np.zeros(60), np.arange(40.0)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    edges = tab.quantile_edges(df, "x", 10)
    raw = np.quantile(x, np.linspace(0, 1, 11))
    assert edges == pytest.approx(sorted(set(raw.tolist())))
    bins = tab.bin_index(df, "x", edges)
    want = np.searchsorted(edges[1:-1], x, side="right")
    assert sorted(r["bin"] for r in bins.collect()) == sorted(want.tolist())


def test_bins_clamp_values_outside_the_fitted_range(spark):
    df = spark.createDataFrame([(-100.0,), (0.5,), (100.0,)], "x double")
    assert [r["bin"] for r in tab.bin_index(df, "x", [0.0, 0.5, 1.0]).collect()] == [0, 1, 1]
