import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from tandem.catalog import base
from tandem.operators import metrics as met, profile
from tandem.session import stage

PERFECT = [(0, 0.02), (1, 0.85), (0, 0.3), (1, 0.6), (0, 0.11), (1, 0.97)]


def frame(spark, rows, split="val"):
    return spark.createDataFrame([(i, int(y), float(p), split) for i, (y, p) in enumerate(rows)],
                                 "id int, label int, proba double, split string")


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def brute_ap(y, p):
    total, last = 0.0, 0.0
    for s in sorted(set(p.tolist()), reverse=True):
        yes = p >= s
        recall = (yes & (y == 1)).sum() / (y == 1).sum()
        total += (recall - last) * (yes & (y == 1)).sum() / yes.sum()
        last = recall
    return total


def brute_f1(y, p, t):
    yes = p >= t
    tp, fp, fn = (yes & (y == 1)).sum(), (yes & (y == 0)).sum(), (~yes & (y == 1)).sum()
    return 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0


def noisy(seed, n=3000, tied=False):
    """Low-lying scores that favour the positive class; optionally a third tie at 0.31."""
    rng = np.random.default_rng(seed)
    y = (rng.uniform(size=n) < 0.37).astype(int)
    p = np.where(y == 1, rng.beta(3, 6, n), rng.beta(2, 9, n))
    if tied:
        p = np.where(rng.uniform(size=n) < 1 / 3, 0.31, np.round(p, 2))
    return y, p


def test_separable_scores(spark):
    r = met.score(frame(spark, PERFECT)).first()
    assert (r["accuracy"], r["f1"], r["roc_auc"], r["average_precision"]) == (1.0, 1.0, 1.0, 1.0)


def test_threshold_above_and_below_everything(spark):
    df = frame(spark, PERFECT)
    high = met.score(df, 0.999).first()
    assert (high["precision"], high["recall"], high["f1"]) == (0.0, 0.0, 0.0)
    low = met.score(df, 0.01).first()
    assert (low["precision"], low["recall"]) == (0.5, 1.0)


def test_ranking_ignores_the_threshold(spark):
    y, p = noisy(3)
    a, b = (met.score(frame(spark, zip(y, p)), t).first() for t in (0.2, 0.8))
    for name in ("roc_auc", "average_precision"):
        assert a[name] == pytest.approx(b[name], abs=1e-12)


@pytest.mark.parametrize("tied", [False, True])
def test_ranking_matches_brute_force(spark, tied):
    y, p = noisy(1, 2000, tied)
    r = met.ranking(frame(spark, zip(y, p)).repartition(7)).first()
    assert r["roc_auc"] == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert r["average_precision"] == pytest.approx(brute_ap(y, p), abs=1e-12)


def test_one_class_has_no_auc(spark):
    r = met.ranking(frame(spark, [(1, 0.2), (1, 0.7)])).first()
    assert r["roc_auc"] is None and r["average_precision"] == 1.0


def test_sweep_matches_brute_force_on_every_grid_point(spark):
    y, p = noisy(2, 1500, tied=True)
    p = np.concatenate([p, np.arange(0, 101) / 100])  # exactly on the grid
    y = np.concatenate([y, np.arange(0, 101) % 2])
    for r in met.threshold_sweep(frame(spark, zip(y, p))).collect():
        assert r["threshold"] == r["grid_index"] / 100
        assert r["f1"] == pytest.approx(brute_f1(y, p, r["threshold"]), abs=1e-12)


def test_tuned_threshold_is_the_lowest_best(spark):
    y, p = noisy(0)
    t = met.tune_threshold(frame(spark, zip(y, p))).first()["threshold"]
    f1s = [brute_f1(y, p, k / 100) for k in range(15, 85)]
    assert t == (15 + int(np.argmax(f1s))) / 100
    assert 0.15 <= t < 0.5


def test_selection_sees_validation_rows_only(spark):
    y, p = noisy(0)
    val = frame(spark, zip(y, p))
    decoy = frame(spark, zip(1 - y, p), split="test")
    assert met.tune_threshold(val.unionByName(decoy)).first() == met.tune_threshold(val).first()
    with pytest.raises(ValueError):
        met.tune_threshold(val.drop("split"))


def test_class_report(spark):
    y, p = noisy(4, 500)
    rows = {r["class"]: r for r in met.class_report(frame(spark, zip(y, p)), 0.3).collect()}
    assert rows["1"]["f1"] == pytest.approx(brute_f1(y, p, 0.3))
    assert rows["0"]["support"] + rows["1"]["support"] == rows["macro avg"]["support"] == 500
    assert rows["macro avg"]["f1"] == pytest.approx((rows["0"]["f1"] + rows["1"]["f1"]) / 2)


@pytest.mark.parametrize("rate,want", [(0.1, 0.9), (0.75, 0.75), (0.5, 0.5), (1.0, 1.0)])
def test_majority_takes_the_larger_class(spark, rate, want):
    df = spark.createDataFrame([(int(i < rate * 1000),) for i in range(1000)], "target int")
    assert profile.prevalence(df).first()["majority_accuracy"] == pytest.approx(want)


def test_best_row_first_wins(spark):
    df = spark.createDataFrame([(0, 0.5, "a"), (1, 0.7, "b"), (2, 0.7, "c")], "i int, f1 double, m string")
    assert met.best_row(df, "f1", "i").first()["m"] == "b"
    assert met.nearest_row(df, "f1", 0.62, "i").first()["m"] == "b"


def test_gates(spark):
    facts = spark.createDataFrame([(0.7, 0.6)], "accuracy double, floor double")
    rows = {r["gate"]: r["ok"] for r in met.gates(
        facts, [("a", "accuracy", ">", "floor"), ("b", "accuracy", "<", 0.5)]).collect()}
    assert rows == {"a": True, "b": False}


def test_rows_without_score_or_label_count_nowhere(spark):
    rows = [(1, 1, 0.9, "val"), (2, 0, 0.2, "val"), (3, 1, None, "val"), (4, None, 0.8, "val"), (5, 0, float("nan"), "val"), (6, None, None, "val")]
    df = spark.createDataFrame(rows, "id int, label int, proba double, split string")
    clean = df.where("id <= 2")
    assert met.confusion(df).first() == met.confusion(clean).first()
    assert met.score(df).first() == met.score(clean).first()
    assert met.threshold_sweep(df).collect() == met.threshold_sweep(clean).collect()
    assert met.tune_threshold(df).first() == met.tune_threshold(clean).first()
    assert met.unscored(df).first()[0] == 4


# --- stored states ----------------------------------------------------------

def test_merged_states_equal_the_whole(spark, folder):
    preds = base.scores(spark, folder)
    parts = [met.stored_state(preds.where(F.col("id") % 3 == k), ("split",)) for k in range(3)]
    merged = stage(met.merge_states(*parts, groups=("split",)), "merged")
    whole = met.stored_state(preds, ("split",))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    for read in (met.state_ranking, met.state_curve, met.state_sweep, lambda s, g: met.state_score(s, 0.5, g)):
        assert sorted(map(tuple, read(merged, ("split",)).collect())) == sorted(map(tuple, read(whole, ("split",)).collect()))
    assert sorted(map(tuple, met.state_sweep(whole, ("split",)).collect())) == sorted(map(tuple, met.threshold_sweep(preds, ("split",)).collect()))


def test_new_predictions_join_a_stored_state_without_the_old_rows(spark, folder):
    preds = base.scores(spark, folder)
    old, new = met.stored_state(preds.where("id % 2 = 0")), met.score_state(preds.where("id % 2 = 1"))
    merged = met.merge_states(old, new)
    assert plan_of(merged).count("FileScan") == 2  # the old state and the new rows
    assert met.state_ranking(stage(merged, "merged")).collect() == met.ranking(preds).collect()


def test_metrics_scan_predictions_once(spark, folder):
    """The predictions are read for the state; the metric's own plan reads the state alone."""
    preds = base.scores(spark, folder)
    assert plan_of(met.score_state(preds, ("split",))).count("FileScan") == 1
    own = {f.rsplit("/", 2)[-2] for f in met.score(preds, 0.5, ("split",)).inputFiles()}
    assert len(own) == 1 and own.pop().startswith("score-state")
