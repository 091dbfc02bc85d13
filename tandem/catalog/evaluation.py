"""Queries: evaluation of tied pseudo-scores; no model is involved."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem.catalog import base as b
from tandem.catalog.base import query, r, rnd, sql
from tandem.operators import learn, metrics as met
from tandem.operators.ordering import union_all

_M = met.METRICS


def _rounded(df, columns=_M):
    return df.withColumns({c: rnd(c) for c in columns})


def _cols(names=_M) -> str:
    return ", ".join(f'{r(chr(34) + n + chr(34))} AS "{n}"' for n in names)


@query("ml_classify", sql("""
    SELECT id, label, CASE WHEN proba >= 0.5::DOUBLE THEN 1 ELSE 0 END AS pred FROM scores""", "scores"))
def ml_classify(spark, d):
    return learn.classify(b.scores(spark, d), 0.5).select("id", "label", "pred")


@query("ev_confusion", sql("SELECT split, tp, fp, tn, fn FROM conf", "conf"))
def ev_confusion(spark, d):
    return met.confusion(b.scores(spark, d), 0.5, ("split",))


@query("ev_score", sql(f"SELECT split, 0.5::DOUBLE AS threshold, {_cols()} FROM metrics", "metrics"))
def ev_score(spark, d):
    return _rounded(met.score(b.scores(spark, d), 0.5, ("split",)))


@query("ev_report", sql(f"""
    WITH c AS (SELECT tp::DOUBLE AS tp, fp::DOUBLE AS fp, tn::DOUBLE AS tn, fn::DOUBLE AS fn FROM conf WHERE split = 'test'),
    k AS (SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS rc, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS n FROM c
          UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c),
    a AS (SELECT * FROM k UNION ALL SELECT 'macro avg', avg(p), avg(rc), avg(f), sum(n) FROM k
          UNION ALL SELECT 'weighted avg', sum(p * n) / sum(n), sum(rc * n) / sum(n), sum(f * n) / sum(n), sum(n) FROM k)
    SELECT class, {r('p')} AS "precision", {r('rc')} AS recall, {r('f')} AS f1, n::BIGINT AS support FROM a""", "conf"))
def ev_report(spark, d):
    test = b.scores(spark, d).where(F.col("split") == "test")
    return _rounded(met.class_report(test), ("precision", "recall", "f1"))


@query("ev_auc", sql(f"SELECT split, {r('roc_auc')} AS roc_auc FROM rank_metrics", "rank_metrics"))
def ev_auc(spark, d):
    return met.ranking(b.scores(spark, d), ("split",)).select("split", rnd("roc_auc").alias("roc_auc"))


@query("ev_ap", sql(f"SELECT split, {r('average_precision')} AS average_precision FROM rank_metrics", "rank_metrics"))
def ev_ap(spark, d):
    return met.ranking(b.scores(spark, d), ("split",)).select(
        "split", rnd("average_precision").alias("average_precision"))


@query("ev_pr_curve", sql(f"""
    SELECT split, proba AS threshold, {r('tp::DOUBLE / (tp + fp)')} AS "precision", {r('tp::DOUBLE / P')} AS recall
    FROM cum""", "cum"))
def ev_pr_curve(spark, d):
    return _rounded(met.pr_curve(b.scores(spark, d), ("split",)), ("precision", "recall"))


@query("ev_threshold_grid", sql("""
    SELECT k::INTEGER AS grid_index, k / 100.0::DOUBLE AS threshold, count(*) FILTER (proba >= k / 100.0::DOUBLE) AS above
    FROM scores, range(15, 85) g(k) GROUP BY k""", "scores"))
def ev_threshold_grid(spark, d):
    """The grid, with how many rows each point would call positive: rows are counted once, at the last point they reach."""
    counts = met.scored(b.scores(spark, d)).groupBy(met.grid_place().alias("k")).agg(F.count("*").alias("n"))
    grid = spark.range(1).select(F.explode(met.threshold_grid()).alias("grid_index"))
    above = grid.join(F.broadcast(counts), F.col("k") >= F.col("grid_index"), "left").groupBy("grid_index").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("above"))
    return above.select("grid_index", (F.col("grid_index").cast("double") / 100.0).alias("threshold"), "above")


_RATES = ("accuracy", "precision", "recall", "f1")


@query("ev_threshold_sweep", sql(f"SELECT split, grid_index, threshold, {_cols(_RATES)} FROM sweep", "sweep"))
def ev_threshold_sweep(spark, d):
    return _rounded(met.threshold_sweep(b.scores(spark, d), ("split",)), _RATES)


@query("ev_tune_threshold", sql(f"""
    SELECT grid_index, threshold, {_cols(_RATES)} FROM sweep WHERE split = 'val'
    ORDER BY sweep.f1 DESC, grid_index LIMIT 1""", "sweep"))
def ev_tune_threshold(spark, d):
    return _rounded(met.tune_threshold(b.scores(spark, d)), _RATES)


@query("ev_transfer", sql(f"""
    SELECT v.grid_index, v.threshold, {r('v.f1')} AS val_f1, {r('t.f1')} AS test_f1,
           v.grid_index = (SELECT grid_index FROM sweep WHERE split = 'val' ORDER BY f1 DESC, grid_index LIMIT 1) AS chosen
    FROM sweep v JOIN sweep t USING (grid_index) WHERE v.split = 'val' AND t.split = 'test'""", "sweep"))
def ev_transfer(spark, d):
    return _rounded(met.transfer(b.scores(spark, d)), ("val_f1", "test_f1"))


@query("ev_model_table", sql(f"""
    WITH pick AS (SELECT threshold AS t FROM sweep WHERE split = 'val' ORDER BY f1 DESC, grid_index LIMIT 1)
    SELECT 'scores' AS model, 0.5::DOUBLE AS threshold, {_cols()} FROM metrics WHERE split = 'test'
    UNION ALL
    SELECT 'scores @val-thr', s.threshold, {', '.join(f'{r(f"s.{chr(34)}{n}{chr(34)}")}' for n in _RATES)},
           {r('m.roc_auc')}, {r('m.average_precision')}
    FROM sweep s JOIN metrics m USING (split) WHERE split = 'test' AND s.threshold = (SELECT t FROM pick)""",
    "sweep", "metrics"))
def ev_model_table(spark, d):
    preds = b.scores(spark, d)
    cut = met.tune_threshold(preds).first()["threshold"]
    test = preds.where(F.col("split") == "test")
    rows = [met.score(test, t).withColumn("model", F.lit(n))
            for n, t in (("scores", 0.5), ("scores @val-thr", cut))]
    return _rounded(union_all(rows)).select("model", "threshold", *_M)


@query("ev_compare", sql(" UNION ALL ".join(
    f"SELECT split AS model, '{m}' AS metric, {r(m)} AS value FROM metrics"
    for m in ("accuracy", "f1", "roc_auc", "average_precision")) + f"""
    UNION ALL SELECT split, 'majority', {r('greatest(avg(label), 1 - avg(label))')} FROM scores GROUP BY split""",
    "metrics", "scores"))
def ev_compare(spark, d):
    preds = b.scores(spark, d)
    table = met.score(preds, 0.5, ("split",)).withColumnRenamed("split", "model")
    p = F.avg("label")
    majority = preds.groupBy(F.col("split").alias("model")).agg(
        F.greatest(p, 1 - p).alias("value")).withColumn("metric", F.lit("majority"))
    long = met.compare(table, ("accuracy", "f1", "roc_auc", "average_precision"))
    return long.unionByName(majority).withColumn("value", rnd("value"))


@query("ev_ablation_delta", sql(f"""
    SELECT split, {r('f1')} AS f1, {r("f1 - (SELECT f1 FROM metrics WHERE split = 'train')")} AS f1_delta,
           {r("(f1 - (SELECT f1 FROM metrics WHERE split = 'train')) / 0.5::DOUBLE")} AS gap_share
    FROM metrics""", "metrics"))
def ev_ablation_delta(spark, d):
    table = met.score(b.scores(spark, d), 0.5, ("split",)).select("split", "f1")
    out = met.delta_to(table, F.col("split") == "train", "f1", "f1_delta")
    return out.select("split", rnd("f1").alias("f1"), rnd("f1_delta").alias("f1_delta"),
                      rnd(F.col("f1_delta") / 0.5).alias("gap_share"))


@query("ev_overfit_gap", sql(f"""
    SELECT 'scores' AS model, {r("max(f1) FILTER (split = 'train') - max(f1) FILTER (split = 'test')")} AS f1_gap,
           {r("max(roc_auc) FILTER (split = 'train') - max(roc_auc) FILTER (split = 'test')")} AS roc_auc_gap
    FROM metrics""", "metrics"))
def ev_overfit_gap(spark, d):
    table = met.score(b.scores(spark, d), 0.5, ("split",)).withColumn("model", F.lit("scores"))
    return _rounded(met.overfit_gap(table, ("f1", "roc_auc")), ("f1_gap", "roc_auc_gap"))


_RULES = (
    ("clears majority", "accuracy", ">", "majority_floor"),
    ("ranks better than chance", "roc_auc", ">", 0.5),
    ("f1 floor", "f1", ">=", 0.6),
    ("tuned recall rises", "tuned_recall", ">", "recall"),
    ("tuned accuracy falls", "tuned_accuracy", "<", "accuracy"),
    ("all rows assigned", "rows_seen", "=", "rows_labelled"),
)


@query("ev_gates", sql(f"""
    WITH m AS (SELECT * FROM metrics WHERE split = 'test'),
    pick AS (SELECT grid_index AS g FROM sweep WHERE split = 'val' ORDER BY f1 DESC, grid_index LIMIT 1),
    t AS (SELECT accuracy, recall FROM sweep WHERE split = 'test' AND grid_index = (SELECT g FROM pick)),
    p AS (SELECT greatest(avg(label), 1 - avg(label)) + 0.08::DOUBLE AS floor FROM scores WHERE split = 'test'),
    n AS (SELECT (SELECT count(*) FROM scores) AS seen,
                 (SELECT count(*) FROM campaigns WHERE state IN ('successful', 'failed')) AS labelled),
    g AS (
    SELECT 'clears majority' AS gate, accuracy AS value, '>' AS op, floor AS bound, accuracy > floor AS ok FROM m, p
    UNION ALL SELECT 'ranks better than chance', roc_auc, '>', 0.5::DOUBLE, roc_auc > 0.5 FROM m
    UNION ALL SELECT 'f1 floor', f1, '>=', 0.6::DOUBLE, f1 >= 0.6::DOUBLE FROM m
    UNION ALL SELECT 'tuned recall rises', t.recall, '>', m.recall, t.recall > m.recall FROM m, t
    UNION ALL SELECT 'tuned accuracy falls', t.accuracy, '<', m.accuracy, t.accuracy < m.accuracy FROM m, t
    UNION ALL SELECT 'all rows assigned', seen::DOUBLE, '=', labelled::DOUBLE, seen = labelled FROM n)
    SELECT gate, {r('value')} AS value, op, {r('bound')} AS bound, ok FROM g""",
    "metrics", "sweep", "scores", "campaigns"))
def ev_gates(spark, d):
    preds = b.scores(spark, d)
    cut = met.tune_threshold(preds).first()["threshold"]
    test = preds.where(F.col("split") == "test")
    from tandem.sources import tables as t
    from tandem.operators import prepare
    p = F.avg("label")
    tuned = met.score(test, cut)
    labelled = prepare.label_outcomes(t.campaigns(spark, d)).agg(F.count("*"))
    facts = met.score(test, 0.5).withColumns({
        "tuned_recall": tuned.select("recall").scalar(),
        "tuned_accuracy": tuned.select("accuracy").scalar(),
        "majority_floor": test.agg(F.greatest(p, 1 - p) + 0.08).scalar(),
        "rows_seen": preds.agg(F.count("*")).scalar(),
        "rows_labelled": labelled.scalar(),
    })
    return met.gates(facts, _RULES).withColumns({"value": rnd("value"), "bound": rnd("bound")})
