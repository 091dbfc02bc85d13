"""The training job: split, fit, choose on validation, report on test, persist."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, functions as F

from tandem import config as cfg
from tandem.operators import learn, metrics as met, multifit, split
from tandem.operators.fusion import FeatureSpec, FusedModel, fit_features, tidy
from tandem.operators.multifit import Problem
from tandem.operators.ordering import union_all
from tandem.operators.prepare import (
    add_clean_title, add_engineered, base_table, drop_empty_titles,
)
from tandem.operators.profile import prevalence
from tandem.session import stage, stage_path
from tandem.sources import files

LINEAR, TREES, CROSSED = "linear", "boosting", "linear + goal by main category"


@dataclass
class Prepared:
    """Split records, the fitted features, and the staged feature rows."""

    records: DataFrame
    model: FusedModel
    rows: DataFrame
    blocks: dict[FeatureSpec, tuple[FusedModel, multifit.Rows]] = field(default_factory=dict, repr=False)

    def part(self, name: str) -> DataFrame:
        return self.rows.where(F.col("split") == name)

    @property
    def train(self) -> DataFrame:
        return self.part("train")


def prepare(campaigns: DataFrame, spec: FeatureSpec = FeatureSpec()) -> Prepared:
    """Raw campaigns to staged feature rows.

    Two tables are written: the modelling rows, read by every fit, and the fused
    rows, read by every model. The fused rows are partitioned by split on disk, so
    a model fit on train never reads validation or test files.
    """
    return fit_prepared(split_records(campaigns), spec)


def split_records(campaigns: DataFrame) -> DataFrame:
    """Stored modelling rows with their split.

    Titles are cleaned once, on the way into storage; the empty ones are dropped on
    reading, where the test is on a stored column. The split is a comparison per
    row against fitted cutoffs, so it is not worth a second copy of the table.
    """
    rows = add_engineered(add_clean_title(base_table(campaigns)))
    return split.three_way(drop_empty_titles(stage(rows, "modelling")))


def fit_prepared(records: DataFrame, spec: FeatureSpec, **blocks) -> Prepared:
    model = fit_features(records.where(F.col("split") == "train"), spec, **blocks)
    keep = [c for c in ("text_vec", *spec.numeric, *[f"code__{c}" for c in spec.categorical])
            if c != "text_vec" or spec.with_text]
    rows = stage(tidy(model.transform(records), keep), "features", ("split",))
    return Prepared(records, model, rows)


def stored_blocks(data: Prepared, spec: FeatureSpec | None = None) -> tuple[FusedModel, multifit.Rows]:
    """Sparse blocks of the prepared rows, or of those of a wider spec on the blocks already fitted; written once each."""
    spec = spec or data.model.spec
    if spec not in data.blocks:
        model, rows = data.model, data.rows
        if spec != model.spec:
            model = fit_features(data.records.where(F.col("split") == "train"), spec, text=model.text, tabular=model.tabular)
            rows = tidy(model.transform(data.records))
        data.blocks[spec] = model, multifit.store(rows, model.width)
    return data.blocks[spec]


@dataclass
class TrainingResult:
    prepared: Prepared
    sweep: learn.Sweep
    linear: Model
    trees: Model | None
    predictions: DataFrame
    thresholds: dict[str, float]
    comparison: DataFrame
    coefficients: DataFrame
    meta: dict = field(default_factory=dict)


def tuned(preds: DataFrame) -> float:
    return met.tune_threshold(preds).first()["threshold"]


def run(campaigns: DataFrame, rounds: int = cfg.BOOSTING_ROUNDS, rank: int = cfg.SVD_RANK,
        grid=cfg.C_GRID, with_trees: bool = True) -> TrainingResult:
    spark = campaigns.sparkSession
    data = prepare(campaigns)
    # Plain and crossed columns side by side: every strength of both is fitted from the same scans.
    spec = replace(data.model.spec, slopes=((cfg.CROSS_BASE, cfg.CROSS_WITH),))
    wide, blocks = stored_blocks(data, spec)
    plain = tuple(wide.columns_of(data.model.spec))
    grid = list(map(float, grid))
    fitted = multifit.fit(blocks, [Problem(C, columns=plain) for C in grid] + [Problem(C) for C in grid])
    sweep = learn.sweep_table(spark, blocks, fitted.some(range(len(grid))), plain)
    best = grid.index(sweep.best_C)
    linear = sweep.models[sweep.best_C]
    pair = fitted.some([best, len(grid) + best])
    preds = {LINEAR: multifit.predict(blocks, pair, [LINEAR, CROSSED])}

    trees = None
    if with_trees:
        pack = learn.fit_dense(data.train, data.model, rank)
        dense = stage(pack.transform(data.rows).select("id", "split", "target", "dense"), "dense", ("split",))
        most = max((len(v) for v in data.model.tabular.levels.values()), default=0)
        trees = learn.fit_boosting(dense.where(F.col("split") == "train"), rounds, max_levels=most)
        preds[TREES] = learn.predict(trees, dense.where(F.col("split") != "train"), TREES, "dense")

    predictions = stage(union_all(list(preds.values())), "predictions", ("split",))
    thresholds = {r["model"]: r["threshold"] for r in
                  met.tune_threshold(predictions, ("model",)).collect()}

    test = predictions.where(F.col("split") == "test")
    scored = [met.score(test, 0.5, ("model",))]
    for name in (LINEAR, *([TREES] if with_trees else [])):
        scored.append(met.score(test.where(F.col("model") == name), thresholds[name], ("model",))
                      .withColumn("model", F.concat("model", F.lit(" @val-thr"))))
    table = union_all(scored).select("model", "threshold", *met.METRICS)
    comparison = spark.createDataFrame(table.collect(), table.schema)

    counts = {r["split"]: r["n"] for r in data.records.groupBy("split").agg(F.count("*").alias("n")).collect()}
    majority = prevalence(data.records.where(F.col("split") == "test")).first()["majority_accuracy"]
    meta = {
        "n_train": counts.get("train", 0), "n_val": counts.get("val", 0), "n_test": counts.get("test", 0),
        "n_features": data.model.width, "blocks": data.model.block_widths(),
        "numeric_cols": list(cfg.NUMERIC), "categorical_cols": list(cfg.CATEGORICAL),
        "best_C": sweep.best_C, "thresholds": thresholds, "majority_accuracy": majority,
        "selection": "strength and thresholds on validation; test scored once",
    }
    return TrainingResult(data, sweep, linear, trees, predictions, thresholds, comparison,
                          learn.coefficient_table(linear, data.model, spark), meta)


def meta_table(result: TrainingResult) -> DataFrame:
    """Run metadata as a one-row typed table."""
    spark, m = result.predictions.sparkSession, result.meta
    schema = ("n_train long, n_val long, n_test long, n_features int, blocks map<string,int>, "
              "numeric_cols array<string>, categorical_cols array<string>, best_C double, "
              "thresholds map<string,double>, majority_accuracy double, selection string")
    return spark.createDataFrame([tuple(m.values())], schema)


def save(result: TrainingResult, path: str | None = None) -> str:
    """Write models, feature rows, predictions, tables and metadata under ``path``."""
    spark = result.predictions.sparkSession
    path = path or stage_path(spark, "run")
    result.prepared.model.pipeline.write().overwrite().save(f"{path}/features_model")
    result.linear.write().overwrite().save(f"{path}/linear_model")
    if result.trees is not None:
        result.trees.write().overwrite().save(f"{path}/trees_model")
    files.write_blocks(result.prepared.rows.select("id", "split", "target", "features"), f"{path}/blocks")
    files.write_blocks(result.predictions, f"{path}/predictions")
    files.write_report(result.comparison, f"{path}/comparison")
    files.write_report(result.sweep.table, f"{path}/sweep")
    files.write_report(result.coefficients, f"{path}/coefficients")
    result.prepared.model.feature_dict(spark).write.parquet(f"{path}/feature_dict")
    files.write_document(meta_table(result), f"{path}/meta")
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/features_model")
