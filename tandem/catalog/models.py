"""Queries that fit models.

SQL cannot fit them, but it can say what must hold of a fitted one. At the optimum of a logistic regression with a squared
penalty every column balances: the expected sum over train plus coefficient / C is the sum over the positive rows. The
right side needs no model, so SQL gives it for every column of every variant. The metric tables of the same fits are
registered beside them as ``*_scores``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tandem import config as cfg
from tandem.catalog import base as b
from tandem.catalog.base import query, r, rnd, shared, sql
from tandem.operators import fusion, learn, metrics as met, multifit, svd
from tandem.operators.fusion import FeatureSpec
from tandem.operators.multifit import Problem
from tandem.plans import ablation, training
from tandem.session import stage
from tandem.sources import tables as t

PLACES = 3
CROSSED = FeatureSpec(slopes=((cfg.CROSS_BASE, cfg.CROSS_WITH),))


# --- SQL of the sums over positive rows -------------------------------------

def _edges(n: int) -> str:
    return f"(SELECT quantile_cont(log_goal, [{', '.join(str(i / n) for i in range(n + 1))}]) AS e FROM train)"


def _bin(n: int) -> str:
    return f"len(list_filter(e[2:{n}], lambda x: x <= log_goal))"


b.CTES |= {
    "tcells": (("cells", "train", "catlong", "levels"), f"""
        SELECT id, feature, value FROM cells WHERE split = 'train'
        UNION ALL SELECT id, 'num__usd_goal_real', (usd_goal_real - m) / s
        FROM train, (SELECT avg(usd_goal_real) AS m, stddev_pop(usd_goal_real) AS s FROM train)
        UNION ALL SELECT id, concat('inter__log_goal_x_', "column", '_', level), log_goal
        FROM train JOIN catlong USING (id) JOIN levels USING ("column", level) WHERE "column" IN ('category', 'main_category')
        """ + "".join(f"UNION ALL SELECT id, concat('inter__log_goal_bin ', {_bin(n)}, ' of {n}'), 1.0::DOUBLE FROM train, {_edges(n)} " for n in (10, 25, 50)) + f"""
        UNION ALL SELECT id, concat('inter__main_category_', main_category, '_x_log_goal_bin ', {_bin(cfg.GOAL_BINS)}, ' of {cfg.GOAL_BINS}'), 1.0::DOUBLE
        FROM train, {_edges(cfg.GOAL_BINS)}"""),
    "seen": (("tcells", "train"), """
        SELECT feature, sum(value * target) AS total FROM tcells JOIN train USING (id) WHERE value <> 0 GROUP BY feature
        UNION ALL SELECT 'intercept', sum(target)::DOUBLE FROM train"""),
}


def has_columns(spec: FeatureSpec) -> str:
    """SQL condition on a feature's name: the columns of a spec, and the intercept."""
    tests = ["feature = 'intercept'", *["starts_with(feature, 'text__')"] * spec.with_text]
    tests += [f"feature = 'num__{c}'" for c in spec.numeric] + [f"starts_with(feature, 'cat__{c}_')" for c in spec.categorical]
    tests += [f"starts_with(feature, 'inter__{x}_x_{c}_')" for x, c in spec.slopes]
    tests += [f"(starts_with(feature, 'inter__{c}_bin ') AND ends_with(feature, ' of {n}'))" for c, n in spec.bins]
    tests += [f"(starts_with(feature, 'inter__{w}_') AND contains(feature, '_x_{c}_bin ') AND ends_with(feature, ' of {n}'))" for c, n, w in spec.cells]
    return " OR ".join(tests)


def seen_sql(variants: dict[str, FeatureSpec | str]) -> str:
    """(model, feature, balance) that the variants must reach."""
    parts = [f"SELECT '{name}' AS model, feature, {r('total', PLACES)} AS balance FROM seen WHERE {has_columns(s) if isinstance(s, FeatureSpec) else s}"
             for name, s in variants.items()]
    return sql(" UNION ALL ".join(parts), "seen")


def balanced(rows, fitted, names, model):
    return multifit.balance(rows, fitted, names, model.names).withColumn("balance", rnd("balance", PLACES))


# --- fits -------------------------------------------------------------------

@shared
def blocks(spark, d):
    return training.stored_blocks(b.prepared(spark, d))


@shared
def grid_fits(spark, d):
    return multifit.fit(blocks(spark, d)[1], [Problem(C) for C in cfg.C_GRID])


@shared
def linear(spark, d):
    return learn.fit_logistic(b.prepared(spark, d).train, 1.0)


@shared
def sweep(spark, d):
    return learn.sweep_table(spark, blocks(spark, d)[1], grid_fits(spark, d))


def _held(spark, d):
    return b.prepared(spark, d).rows.where(F.col("split") != "train")


@query("ml_logreg_l2", seen_sql({"l2": FeatureSpec()}))
def ml_logreg_l2(spark, d):
    model, rows = blocks(spark, d)
    return balanced(rows, multifit.fit(rows, [Problem(1.0)]), ["l2"], model)


@query("ml_logreg_l2_scores")
def ml_logreg_l2_scores(spark, d):
    return met.score(learn.predict(linear(spark, d), _held(spark, d), "l2"), 0.5, ("split",))


@query("ml_logreg_l1", sql("SELECT feature, true AS within FROM features", "features"))
def ml_logreg_l1(spark, d):
    """With an absolute penalty a column's imbalance is at most 1 / C, and exactly that, with its sign, where it is used."""
    model, rows = blocks(spark, d)
    fitted = multifit.fit(rows, [Problem(1.0, "l1")])
    gap = (multifit.sums(rows, fitted, "seen") - multifit.sums(rows, fitted, "expected"))[0, :-1]
    w = fitted.coefficients[0]
    table = spark.createDataFrame(list(zip(model.names, gap.tolist(), w.tolist())), "feature string, gap double, coef double")
    return table.select("feature", F.when(F.col("coef") == 0, F.abs("gap") <= 1 + 1e-5).otherwise(F.abs(F.col("gap") - F.signum("coef")) <= 1e-5).alias("within"))


@query("ml_logreg_l1_coefficients")
def ml_logreg_l1_coefficients(spark, d):
    model = learn.fit_logistic(b.prepared(spark, d).train, 1.0, penalty="l1")
    return learn.coefficient_table(model, b.features(spark, d), spark)


@query("ml_class_weight", sql(f"""
    SELECT 'balanced' AS model, feature, {r('total * n / (2.0::DOUBLE * positives)', PLACES)} AS balance
    FROM seen, (SELECT count(*) AS n, sum(target) AS positives FROM train) WHERE {has_columns(FeatureSpec())}""", "seen", "train"))
def ml_class_weight(spark, d):
    model, rows = blocks(spark, d)
    return balanced(rows, multifit.fit(rows, [Problem(1.0, balanced=True)]), ["balanced"], model)


@query("ml_class_weight_scores")
def ml_class_weight_scores(spark, d):
    model = learn.fit_logistic(b.prepared(spark, d).train, 1.0, balanced=True)
    return met.score(learn.predict(model, _held(spark, d), "balanced"), 0.5, ("split",))


@query("ml_sweep_c", seen_sql({f"C={C}": FeatureSpec() for C in cfg.C_GRID}))
def ml_sweep_c(spark, d):
    """All strengths, fitted from the same scans."""
    model, rows = blocks(spark, d)
    return balanced(rows, grid_fits(spark, d), [f"C={C}" for C in cfg.C_GRID], model)


@query("ml_sweep_c_scores")
def ml_sweep_c_scores(spark, d):
    found = sweep(spark, d)
    return found.table.withColumn("best", F.col("C") == found.best_C)


_TRAIN_TEST = " UNION ALL ".join(
    f"SELECT 'C={C}' AS model, split, count(*) AS rows, sum(target)::BIGINT AS positives, "
    f"CASE WHEN split = 'train' THEN {r('sum(target)', PLACES)} END AS expected FROM rec WHERE split <> 'val' GROUP BY split" for C in cfg.C_GRID)


@query("ml_sweep_c_traintest", sql(_TRAIN_TEST, "rec"))
def ml_sweep_c_traintest(spark, d):
    """Train and test rows per strength: on train as many positives are expected as there are."""
    preds = multifit.predict(blocks(spark, d)[1], grid_fits(spark, d), [f"C={C}" for C in cfg.C_GRID], ("train", "test"))
    out = preds.groupBy("model", "split").agg(F.count("*").alias("rows"), F.sum("label").alias("positives"), F.sum("proba").alias("p"))
    return out.select("model", "split", "rows", "positives", F.when(F.col("split") == "train", rnd("p", PLACES)).alias("expected"))


@query("ml_sweep_c_traintest_scores")
def ml_sweep_c_traintest_scores(spark, d):
    """Train and test metrics per strength, for the record; nothing is chosen here."""
    preds = multifit.predict(blocks(spark, d)[1], grid_fits(spark, d), [f"C={C}" for C in cfg.C_GRID], ("train", "test"))
    return met.score(preds, 0.5, ("model", "split"))


@query("ml_predict", sql(f"""
    SELECT "column", level, count(*) AS rows, {r('sum(target)', PLACES)} AS balance
    FROM catcells JOIN train USING (id) GROUP BY "column", level""", "catcells", "train"))
def ml_predict(spark, d):
    """Predicted rows of train, added up per level: with coefficient / C they are the level's positives."""
    model, rows = blocks(spark, d)
    fitted = multifit.fit(rows, [Problem(1.0)])
    preds = multifit.predict(rows, fitted, ["l2"], ("train",)).select("id", "proba")
    cells = b.train_rows(spark, d).select("id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cfg.CATEGORICAL])).alias("c")).select("id", "c.*")
    weights = spark.createDataFrame(list(zip(model.names, fitted.coefficients[0].tolist())), "feature string, coef double")
    expected = cells.join(preds, "id").groupBy("column", "level").agg(F.count("*").alias("rows"), F.sum("proba").alias("p"))
    named = expected.withColumn("feature", F.concat(F.lit("cat__"), "column", F.lit("_"), "level"))
    return named.join(weights, "feature").select("column", "level", "rows", rnd(F.col("p") + F.col("coef"), PLACES).alias("balance"))


@query("ml_predict_rows")
def ml_predict_rows(spark, d):
    return learn.predict(linear(spark, d), _held(spark, d), "l2")


@query("ml_coef_table", sql(f"SELECT feature, block, {r('total', PLACES)} AS balance FROM features JOIN seen USING (feature)", "features", "seen"))
def ml_coef_table(spark, d):
    """The table of coefficients beside the cells they weigh: every column balances."""
    model, rows = blocks(spark, d)
    fitted = multifit.fit(rows, [Problem(1.0)])
    table = learn.coefficient_table(multifit.spark_model(spark, fitted.coefficients[0], fitted.intercepts[0]), model, spark)
    preds = multifit.predict(rows, fitted, ["l2"], ("train",)).select("id", "proba")
    cells = fusion.vector_cells(b.prepared(spark, d).train, model.feature_dict(spark))
    expected = cells.join(preds, "id").groupBy("feature").agg(F.sum(F.col("value") * F.col("proba")).alias("p"))
    return table.join(expected, "feature").select("feature", "block", rnd(F.col("p") + F.col("coef"), PLACES).alias("balance"))


@query("ml_coef_table_rows")
def ml_coef_table_rows(spark, d):
    return learn.coefficient_table(linear(spark, d), b.features(spark, d), spark)


@shared
def dense_rows(spark, d):
    data = b.prepared(spark, d)
    pack = learn.fit_dense(data.train, data.model)
    return stage(pack.transform(data.rows).select("id", "split", "target", "dense"), "dense", ("split",))


@shared
def trees(spark, d):
    dense = dense_rows(spark, d)
    most = max(len(v) for v in b.features(spark, d).tabular.levels.values())
    model = learn.fit_boosting(dense.where(F.col("split") == "train"), max_levels=most)
    return stage(learn.predict(model, dense, "boosting", "dense"), "boosted", ("split",))


@query("ml_gbt", sql("""
    SELECT split, count(*) AS rows, sum(target)::BIGINT AS positives, true AS are_probabilities, true AS beats_prevalence
    FROM rec GROUP BY split""", "rec"))
def ml_gbt(spark, d):
    """Every row is predicted, with a probability, and train rows better than by the share of positives."""
    p, y = F.col("proba"), F.col("label")
    clipped = F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-15))
    out = trees(spark, d).groupBy("split").agg(
        F.count("*").alias("rows"), F.sum("label").alias("positives"), F.bool_and((p >= 0) & (p <= 1)).alias("are_probabilities"),
        F.avg(-F.when(y == 1, F.ln(clipped)).otherwise(F.ln(1 - clipped))).alias("loss"), F.avg(y.cast("double")).alias("q"))
    prevalence = -(F.col("q") * F.ln("q") + (1 - F.col("q")) * F.ln(1 - F.col("q")))
    return out.select("split", "rows", "positives", "are_probabilities", ((F.col("split") != "train") | (F.col("loss") < prevalence)).alias("beats_prevalence"))


@query("ml_gbt_scores")
def ml_gbt_scores(spark, d):
    return met.score(trees(spark, d).where(F.col("split") != "train"), 0.5, ("split",))


_MODALITIES = {"text only": "feature = 'intercept' OR starts_with(feature, 'text__')", "tabular only": FeatureSpec(with_text=False), "fused": FeatureSpec()}


@query("ml_modality_ablation", seen_sql(_MODALITIES))
def ml_modality_ablation(spark, d):
    model, rows = blocks(spark, d)
    masks = ablation.modality_masks(model)
    return balanced(rows, multifit.fit(rows, [Problem(1.0, columns=m) for m in masks.values()]), list(masks), model)


@query("ml_modality_ablation_scores")
def ml_modality_ablation_scores(spark, d):
    return ablation.modalities(b.prepared(spark, d))


def _variants(spark, d, specs):
    model, rows, fitted = ablation.fitted_variants(b.prepared(spark, d), specs, 10.0)
    return balanced(rows, fitted, list(specs), model)


@query("ml_feature_ablation", seen_sql(ablation.FEATURE_GROUPS))
def ml_feature_ablation(spark, d):
    """All feature groups, fitted together as masks over one stored table."""
    return _variants(spark, d, ablation.FEATURE_GROUPS)


@query("ml_feature_ablation_scores")
def ml_feature_ablation_scores(spark, d):
    return ablation.with_deltas(ablation.feature_groups(b.prepared(spark, d)))


@query("ml_interaction_ablation", seen_sql(ablation.INTERACTIONS))
def ml_interaction_ablation(spark, d):
    """All interaction sets, fitted together as masks over one stored table."""
    return _variants(spark, d, ablation.INTERACTIONS)


@query("ml_interaction_ablation_scores")
def ml_interaction_ablation_scores(spark, d):
    return ablation.with_deltas(ablation.interactions(b.prepared(spark, d)), tree_value=0.5)


@query("ml_knobs", seen_sql({"l2, C=1": FeatureSpec(), "l2, C=10": FeatureSpec()}))
def ml_knobs(spark, d):
    """The L2 knobs of one joint fit of all knobs; the others have queries of their own."""
    model, rows = blocks(spark, d)
    fitted = multifit.fit(rows, list(ablation.KNOBS.values()))
    return balanced(rows, fitted.some([0, 1]), list(ablation.KNOBS)[:2], model)


@query("ml_knobs_scores")
def ml_knobs_scores(spark, d):
    return ablation.ranked(ablation.knobs(b.prepared(spark, d)).where(F.col("split") == "val"))


def _crossed(spark, d):
    data = b.prepared(spark, d)
    model, rows = training.stored_blocks(data, replace(data.model.spec, slopes=CROSSED.slopes))
    return model, rows, multifit.fit(rows, [Problem(1.0)])


@query("ml_interaction_check", seen_sql({"with slopes": CROSSED}))
def ml_interaction_check(spark, d):
    model, rows, fitted = _crossed(spark, d)
    return balanced(rows, fitted, ["with slopes"], model)


@query("ml_interaction_check_scores")
def ml_interaction_check_scores(spark, d):
    _, rows, fitted = _crossed(spark, d)
    return met.score(multifit.predict(rows, fitted, ["with slopes"]), 0.5, ("model", "split"))


@shared
def train_job(spark, d):
    return training.run(t.campaigns(spark, d))


@query("ml_train_job", sql(f"""
    SELECT count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val, count(*) FILTER (split = 'test') AS n_test,
           (SELECT count(*) FROM features)::INTEGER AS n_features, 5::BIGINT AS compared, 3 * count(*) FILTER (split <> 'train') AS predictions,
           {r("greatest(avg(target) FILTER (split = 'test'), 1.0::DOUBLE - avg(target) FILTER (split = 'test'))")} AS majority_accuracy
    FROM rec""", "rec", "features"))
def ml_train_job(spark, d):
    """What the job says about itself, and the rows it leaves."""
    result = train_job(spark, d)
    facts = training.meta_table(result).select("n_train", "n_val", "n_test", "n_features", rnd("majority_accuracy").alias("majority_accuracy"))
    return facts.withColumns({
        "compared": result.comparison.agg(F.count("*")).scalar(), "predictions": result.predictions.agg(F.count("*")).scalar()})


@query("ml_train_job_scores")
def ml_train_job_scores(spark, d):
    return train_job(spark, d).comparison


@query("fx_svd_values", sql(f"""
    SELECT {r('(SELECT sum(weight * weight) FROM cw JOIN train USING (id))')} AS energy, {r('sum(dot * dot)', PLACES)} AS squared_energy
    FROM (SELECT a.term, c.term, sum(a.weight * c.weight) AS dot FROM cw a JOIN cw c ON a.id = c.id JOIN train t ON t.id = a.id GROUP BY 1, 2)""", "cw", "train"))
def fx_svd_values(spark, d):
    """Singular values at full rank: their squares add up to the Gramian's trace, their fourth powers to its squared norm."""
    data = b.prepared(spark, d)
    values = svd.fit_svd(data.train, "text_vec", data.model.text.width).values
    rows = spark.createDataFrame([(v,) for v in values.tolist()], "v double")
    return rows.agg(rnd(F.sum(F.col("v") ** 2)).alias("energy"), rnd(F.sum(F.col("v") ** 4), PLACES).alias("squared_energy"))


@query("fx_svd_energy")
def fx_svd_energy(spark, d):
    """Singular values beside the energy their projections hold: they must agree."""
    data = b.prepared(spark, d)
    basis = svd.fit_svd(data.train, "text_vec", cfg.SVD_RANK)
    cells = svd.project(data.train, "text_vec", basis).select(
        F.posexplode(vector_to_array("text_svd")).alias("component", "value"))
    energy = cells.groupBy("component").agg(F.sum(F.col("value") * F.col("value")).alias("energy"))
    squares = spark.createDataFrame(list(enumerate((basis.values ** 2).tolist())), "component int, squared double")
    return energy.join(squares, "component")
