"""Fitting and applying the two model families."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tandem import config as cfg
from tandem.functions.numeric import unit_hash
from tandem.operators import metrics as met, multifit, svd
from tandem.operators.fusion import FusedModel
from tandem.operators.sparse import dealt
from tandem.session import enable_checkpoints, local_rows


def fit_logistic(train: DataFrame, C: float = 1.0, penalty: str = "l2", balanced: bool = False,
                 features: str = "features", max_iter: int = 500, tol: float = 1e-8) -> Model:
    """Regularised logistic regression; a larger ``C`` penalises less.

    The loss here is a mean over rows, so the strength is 1 / (C * rows). The rows are stored once as sparse blocks and
    scanned at most ``max_iter`` times, usually ten to thirty: ``multifit`` says how.
    """
    if penalty not in ("l1", "l2"):
        raise ValueError(f"unknown penalty {penalty!r}")
    rows = multifit.store(train.select(F.lit(0).alias("id"), F.lit("train").alias("split"), "target", F.col(features).alias("features")))
    fitted = multifit.fit(rows, [multifit.Problem(float(C), penalty, balanced)], tolerance=min(tol, multifit.TOLERANCE), most_scans=max_iter)
    return multifit.spark_model(train.sparkSession, fitted.coefficients[0], fitted.intercepts[0])


def predict(model: Model, df: DataFrame, name: str, features: str = "features") -> DataFrame:
    """(id, split, model, label, proba)."""
    rows = df.select("id", "split", F.col("target").cast("int").alias("label"),
                     F.col(features).alias(model.getFeaturesCol()))
    return model.transform(rows).select(
        "id", "split", F.lit(name).alias("model"), "label",
        vector_to_array("probability")[1].alias("proba"))


def classify(preds: DataFrame, threshold: float = 0.5) -> DataFrame:
    return preds.withColumn("pred", (F.col("proba") >= F.lit(float(threshold))).cast("int"))


def coefficient_table(model: Model, fused: FusedModel, spark) -> DataFrame:
    """(feature, block, coef, abs_coef), one row per fused column."""
    values = model.coefficients.toArray().tolist()
    rows = local_rows(spark, {"idx": list(range(len(values))), "coef": values}, "idx int, coef double")
    return (fused.feature_dict(spark).join(rows, "idx")
            .select("idx", "feature", "block", "coef", F.abs("coef").alias("abs_coef")))


@dataclass
class Sweep:
    table: DataFrame          # one metric row per C on validation
    best_C: float
    models: dict[float, Model]


def sweep_table(spark, rows: multifit.Rows, fitted: multifit.Fitted, columns=None, splits=("val",)) -> Sweep:
    """Score fitted strengths; choose by validation F1, the smallest C on ties.

    All models predict in one scan and are scored together. ``columns`` masks the
    stored columns that the models span.
    """
    grid = [p.C for p in fitted.problems]
    preds = multifit.predict(rows, fitted, [str(i) for i in range(len(grid))], splits)
    strength = F.element_at(F.array(*[F.lit(C) for C in grid]), F.col("grid_index") + 1)
    preds = preds.withColumn("grid_index", F.col("model").cast("int")).withColumn("C", strength)
    scored = met.score(preds, 0.5, ("grid_index", "C", "split")).orderBy("grid_index", "split")
    table = spark.createDataFrame(scored.collect(), scored.schema)
    best = met.best_row(table.where(F.col("split") == "val"), "f1", "grid_index").first()["C"]
    kept = slice(None) if columns is None else np.array(columns, bool)
    models = {C: multifit.spark_model(spark, w[kept], b) for C, w, b in zip(grid, fitted.coefficients, fitted.intercepts)}
    return Sweep(table, best, models)


def sweep_strength(rows: multifit.Rows | DataFrame, grid=cfg.C_GRID, splits=("val",)) -> Sweep:
    """Fit every strength on train, all from the same scans, and choose. Rows that are no blocks yet are stored as such."""
    if isinstance(rows, DataFrame):
        rows = multifit.store(rows)
    fitted = multifit.fit(rows, [multifit.Problem(float(C)) for C in grid])
    return sweep_table(rows.blocks.sparkSession, rows, fitted, splits=splits)


# --- trees ------------------------------------------------------------------

@dataclass
class DensePack:
    """What turns fused rows into the short dense rows trees can use."""

    basis: svd.Basis | None
    inputs: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        if self.basis is not None:
            df = svd.project(df, "text_vec", self.basis)
        return VectorAssembler(inputCols=self.inputs, outputCol="dense").transform(df)


def fit_dense(train: DataFrame, model: FusedModel, rank: int = cfg.SVD_RANK) -> DensePack:
    """Raw numerics, level codes and the text's leading singular directions.

    Code columns keep their nominal metadata, so trees split them as categories.
    ``train`` must carry the pipeline's working columns.
    """
    inputs = list(model.tabular.numeric) + [f"code__{c}" for c in model.tabular.categorical]
    if model.text is None:
        return DensePack(None, inputs)
    return DensePack(svd.fit_svd(train, "text_vec", rank), [*inputs, "text_svd"])


def fit_boosting(train: DataFrame, rounds: int = cfg.BOOSTING_ROUNDS, step: float = cfg.BOOSTING_STEP,
                 depth: int = 5, features: str = "dense", holdout: float = 0.1, max_levels: int = 0,
                 tol: float = 1e-5, seed: int = cfg.SEED) -> Model:
    """Boosted trees that stop when a held-out tenth of train no longer improves.

    Rows are dealt out first: every level of every tree reads them again, and files of few distinct values hold many in a split.
    """
    enable_checkpoints(train.sparkSession)
    held = unit_hash(F.concat(F.col("id").cast("string"), F.lit(f":{seed}:stop"))) < holdout
    rows = dealt(train.select(features, F.col("target").cast("double").alias("label"), held.alias("held")))
    return GBTClassifier(
        featuresCol=features, labelCol="label", maxIter=rounds, stepSize=step, maxDepth=depth,
        maxBins=max(256, max_levels + 1), validationIndicatorCol="held", validationTol=tol,
        seed=seed).fit(rows)
