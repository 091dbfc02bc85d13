import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.operators import learn, metrics as met, scorecard as sc
from tandem.plans import ablation, export, training
from tandem.sources import tables as t


def matrix(rows):
    got = rows.select("id", "features", "target").orderBy("id").collect()
    return (np.array([r["features"].toArray() for r in got]), np.array([r["target"] for r in got]),
            [r["id"] for r in got])


@pytest.fixture(scope="module")
def linear(prepared):
    return learn.fit_logistic(prepared.train, 1.0)


def test_gradient_vanishes_at_the_optimum(prepared, linear):
    x, y, _ = matrix(prepared.train)
    w = linear.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + linear.intercept)))
    n = len(y)
    gradient = x.T @ (p - y) / n + w / n  # C = 1
    assert np.abs(gradient).max() < 1e-4
    assert abs((p - y).mean()) < 1e-4


def test_balanced_weights_balance(prepared):
    model = learn.fit_logistic(prepared.train, 1.0, balanced=True)
    x, y, _ = matrix(prepared.train)
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    assert abs((weight * (p - y)).mean()) < 1e-4


def test_l1_drops_columns(prepared):
    strong = learn.fit_logistic(prepared.train, 0.05, penalty="l1")
    weak = learn.fit_logistic(prepared.train, 0.05)
    assert strong.coefficients.numNonzeros() < weak.coefficients.numNonzeros()
    with pytest.raises(ValueError):
        learn.fit_logistic(prepared.train, penalty="l3")


def test_probabilities_follow_from_coefficients(prepared, linear):
    x, _, ids = matrix(prepared.rows)
    want = 1 / (1 + np.exp(-(x @ linear.coefficients.toArray() + linear.intercept)))
    got = {r["id"]: r["proba"] for r in learn.predict(linear, prepared.rows, "m").collect()}
    np.testing.assert_allclose([got[i] for i in ids], want, atol=1e-9)


def test_coefficient_table_is_complete(spark, prepared, linear):
    table = learn.coefficient_table(linear, prepared.model, spark)
    assert table.count() == prepared.model.width
    assert {r["block"] for r in table.select("block").distinct().collect()} == {"text", "tabular"}


def test_strength_is_chosen_on_validation(prepared):
    found = learn.sweep_strength(prepared.rows, (0.01, 1.0))
    rows = found.table.collect()
    assert [r["split"] for r in rows] == ["val", "val"]
    best = max(rows, key=lambda r: (r["f1"], -r["grid_index"]))
    assert found.best_C == best["C"]


def test_scorecard_agrees_with_the_model_on_every_record(spark, prepared, linear, tmp_path):
    card = export.from_logistic(prepared.model, linear)
    assert card.width == prepared.model.width
    preds = learn.predict(linear, prepared.rows, "m")
    path = str(tmp_path / "card")
    assert export.export(card, prepared.records, preds, path) <= 1e-6
    again = export.load(spark, path)
    assert sc.stale_rows(again.table(spark), card.table(spark)).count() == 0
    wrong = sc.Scorecard(card.terms, card.numeric, card.levels, card.intercept + 0.01)
    with pytest.raises(AssertionError, match="differs"):
        sc.assert_parity(preds, sc.score_records(wrong, prepared.records))


def test_boosting_loss_falls_until_it_stops(spark, prepared):
    pack = learn.fit_dense(prepared.train, prepared.model, 5)
    dense = pack.transform(prepared.rows).select("id", "split", "target", "dense").cache()
    train = dense.where("split = 'train'")
    model = learn.fit_boosting(train, rounds=8, tol=0.0)
    rows = train.select("dense", F.col("target").cast("double").alias("label"))
    losses = model.evaluateEachIteration(rows)
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))
    preds = learn.predict(model, dense.where("split = 'test'"), "trees", "dense")
    assert preds.where("proba < 0 OR proba > 1").count() == 0
    dense.unpersist()


def test_feature_groups_report_both_splits(prepared):
    specs = {"everything": ablation.FEATURE_GROUPS["everything"],
             "everything, no text": ablation.FEATURE_GROUPS["everything, no text"]}
    table = ablation.with_deltas(ablation._variants(prepared, specs, 1.0), tree_value=0.7)
    rows = {(r["variant"], r["split"]): r for r in table.collect()}
    assert len(rows) == 4
    assert rows["everything", "val"]["f1_delta"] == 0.0
    n = prepared.model
    assert rows["everything, no text", "val"]["n_features"] == n.width - n.block_widths()["text"]


def test_training_job_end_to_end(spark, folder, tmp_path):
    result = training.run(t.campaigns(spark, folder), rounds=3, rank=5, grid=(0.1, 1.0))
    names = [r["model"] for r in result.comparison.collect()]
    assert names.count(training.LINEAR) == 1 and f"{training.TREES} @val-thr" in names
    assert len(names) == 5
    counts = {r["split"]: r["count"] for r in result.prepared.records.groupBy("split").count().collect()}
    assert counts["train"] == result.meta["n_train"] and sum(counts.values()) == result.prepared.records.count()
    assert "validation" in result.meta["selection"]

    path = training.save(result, str(tmp_path / "run"))
    again = training.load_pipeline(path).transform(result.prepared.records)
    first = learn.predict(result.linear, result.prepared.rows, "a")
    second = learn.predict(result.linear, again, "b")
    diff = first.join(second.select("id", F.col("proba").alias("p")), "id").agg(F.max(F.abs(F.col("proba") - F.col("p"))))
    assert diff.first()[0] < 1e-12
    meta = spark.read.json(f"{path}/meta").first()
    assert meta["n_features"] == result.prepared.model.width
    stored = spark.read.parquet(f"{path}/predictions")
    assert stored.count() == result.predictions.count()
    assert met.tune_threshold(stored.where(F.col("model") == training.LINEAR)).first()["threshold"] == \
        result.thresholds[training.LINEAR]
