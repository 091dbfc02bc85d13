"""Several models from the same scans: each as if it were fitted alone."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tandem.operators import learn, metrics as met, multifit as mf
from tandem.operators.multifit import Problem
from tandem.plans import ablation, training


def plain_rows(spark, n=700, width=6, seed=1):
    """Rows of mixed scale, one column never used, some rows without any cell."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)) * np.array([1.0, 30.0, 0.1, 1.0, 1.0, 0.0])[:width]
    x[rng.random(x.shape) < 0.5] = 0.0
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ rng.normal(size=width) * 0.3 + 0.4)))).astype(int)
    parts = np.where(np.arange(n) % 5 < 3, "train", np.where(np.arange(n) % 5 == 3, "val", "test"))
    vector = lambda v, k: Vectors.dense(v) if k % 3 else Vectors.sparse(width, [(int(j), float(v[j])) for j in np.flatnonzero(v)])
    rows = [(k, str(parts[k]), int(y[k]), vector(x[k], k)) for k in range(n)]
    return spark.createDataFrame(rows, ["id", "split", "target", "features"]), x, y, parts


def newton(x, y, C, weight=None, rounds=60):
    """The optimum by full Newton steps on plain arrays."""
    n = len(y)
    weight = np.ones(n) if weight is None else weight
    z = np.hstack([x, np.ones((n, 1))])
    penalty = np.append(np.full(x.shape[1], 1 / (C * n)), 0.0)
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(z @ w)))
        gradient = z.T @ (weight * (p - y)) / n + penalty * w
        w -= np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z / n + np.diag(penalty) + 1e-14 * np.eye(len(w)), gradient)
    return w


@pytest.fixture(scope="module")
def plain(spark):
    return plain_rows(spark)


@pytest.fixture(scope="module")
def rows(plain):
    return mf.store(plain[0])


def test_every_problem_reaches_its_own_optimum(plain, rows):
    _, x, y, parts = plain
    x, y = x[parts == "train"], y[parts == "train"]
    mask = (True, True, False, True, False, False)
    problems = [Problem(C) for C in (0.01, 1.0, 100.0)] + [Problem(1.0, balanced=True), Problem(10.0, columns=mask)]
    fitted = mf.fit(rows, problems)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    for k, C in enumerate((0.01, 1.0, 100.0)):
        want = newton(x[:, :5], y, C)
        np.testing.assert_allclose(np.append(fitted.coefficients[k, :5], fitted.intercepts[k]), want, atol=1e-6)
    np.testing.assert_allclose(fitted.coefficients[3, :5], newton(x[:, :5], y, 1.0, weight)[:-1], atol=1e-6)
    np.testing.assert_allclose(fitted.coefficients[4][list(mask)], newton(x[:, list(mask)], y, 10.0)[:-1], atol=1e-6)
    assert not fitted.coefficients[4][[2, 4, 5]].any() and not fitted.coefficients[:, 5].any()


def test_joint_scans_are_about_those_of_one_fit(rows):
    alone = [mf.fit(rows, [Problem(C)]).scans for C in (0.01, 0.1, 1.0, 10.0)]
    together = mf.fit(rows, [Problem(C) for C in (0.01, 0.1, 1.0, 10.0)]).scans
    assert together <= max(alone) + 1 and together < sum(alone)


def test_absolute_penalty_meets_its_conditions(plain, rows):
    fitted = mf.fit(rows, [Problem(0.02, "l1"), Problem(1.0, "l1")])
    gaps = mf.sums(rows, fitted, "seen") - mf.sums(rows, fitted, "expected")
    for gap, w, C in zip(gaps, fitted.coefficients, (0.02, 1.0)):
        used = w != 0
        np.testing.assert_allclose(gap[:-1][used], np.sign(w[used]) / C, atol=1e-5)
        assert (np.abs(gap[:-1][~used]) <= 1 / C + 1e-5).all() and abs(gap[-1]) < 1e-5
    assert (fitted.coefficients[0] == 0).sum() > 1
    with pytest.raises(ValueError):
        mf.fit(rows, [Problem(1.0, "l3")])


def test_predictions_and_spark_models_agree(spark, plain, rows, tmp_path):
    df, x, y, _ = plain
    fitted = mf.fit(rows, [Problem(1.0), Problem(0.1)])
    preds = mf.predict(rows, fitted, ["a", "b"], ("train", "val", "test"))
    assert preds.count() == 2 * len(y)
    for k, name in enumerate("ab"):
        model = mf.spark_model(spark, fitted.coefficients[k], fitted.intercepts[k])
        model.write().save(str(tmp_path / name))
        alone = {r["id"]: r["proba"] for r in learn.predict(type(model).load(str(tmp_path / name)), df, name).collect()}
        for r in preds.where(F.col("model") == name).collect():
            assert abs(alone[r["id"]] - r["proba"]) < 1e-12 and r["label"] == y[r["id"]]


def test_null_labels_and_empty_tables(spark, plain):
    df = plain[0]
    some = mf.store(df.withColumn("target", F.when(F.col("id") % 2 == 0, F.col("target"))))
    assert sum(len(r["ids"]) for r in some.blocks.collect()) == 350
    with pytest.raises(ValueError, match="no rows"):
        mf.fit(mf.store(df.limit(0), 6), [Problem()])
    empty = mf.store(df.where("split <> 'val'"), 6)
    assert mf.predict(empty, mf.fit(empty, [Problem()]), ["m"], ("val",)).collect() == []


def test_one_class_alone_keeps_its_intercept_finite(spark, plain):
    ones = mf.store(plain[0].withColumn("target", F.lit(1)), 6)
    fitted = mf.fit(ones, [Problem(1.0)], most_scans=60)
    assert np.isfinite(fitted.coefficients).all() and mf.predict(ones, fitted, ["m"]).agg(F.min("proba")).first()[0] > 0.99


def test_sweep_and_single_fit_agree(prepared):
    rows = training.stored_blocks(prepared)[1]
    fitted = mf.fit(rows, [Problem(1.0)])
    single = learn.fit_logistic(prepared.train, 1.0, tol=1e-12, max_iter=2000)
    alone = {r["id"]: r["proba"] for r in learn.predict(single, prepared.rows.where("split <> 'train'"), "m").collect()}
    assert max(abs(alone[r["id"]] - r["proba"]) for r in mf.predict(rows, fitted, ["m"]).collect()) < 1e-6


def test_thirteen_variants_are_stored_once(prepared, monkeypatch):
    """All variants are masks over one table: one write of feature rows, however many variants."""
    from tandem.operators import multifit

    written = []
    real = multifit.stage
    monkeypatch.setattr(multifit, "stage", lambda df, label, *a: written.append(label) or real(df, label, *a))
    data = training.Prepared(prepared.records, prepared.model, prepared.rows)
    first, second = ablation.feature_groups(data), ablation.interactions(data)
    assert first.count() == 12 and second.count() == 14 and written == ["blocks"]
    widths = {r["variant"]: (r["n_features"], r["n_extra"]) for r in first.union(second.select(*first.columns)).collect()}
    assert widths["everything"] == (prepared.model.width, 0) == widths["none"]
    levels = {c: len(v) for c, v in prepared.model.tabular.levels.items()}
    assert widths["goal by category"][1] == levels["category"] and widths["25 goal bins"][1] == 25
    assert widths["goal bin by main category"][1] == 10 * levels["main_category"]


def test_variants_equal_fits_on_their_own_tables(prepared):
    from tandem.plans.ablation import INTERACTIONS
    from tandem.operators.fusion import fit_features, tidy

    name = "goal bin by main category"
    spec = ablation.adapted(INTERACTIONS[name], prepared)
    own = fit_features(prepared.records.where("split = 'train'"), spec, text=prepared.model.text, tabular=prepared.model.tabular)
    alone = mf.store(tidy(own.transform(prepared.records)), own.width)
    want = met.score(mf.predict(alone, mf.fit(alone, [Problem(10.0)]), [name]), 0.5, ("split",))
    got = ablation._variants(prepared, {name: INTERACTIONS[name]}, 10.0)
    want, got = ({r["split"]: [round(r[m], 9) for m in met.METRICS] for r in t.collect()} for t in (want, got))
    assert want == got
