"""Which blocks, feature groups and knobs pay: one metric row per variant.

The columns of all variants are stored once, side by side; a variant is a mask over
them. All variants are fitted together, from the same scans, and predicted in one.
Variants are scored on validation and test, and only the validation rows may be
used to choose.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from tandem import config as cfg
from tandem.operators import metrics as met, multifit
from tandem.operators.fusion import FeatureSpec, FusedModel, wider
from tandem.operators.multifit import Problem
from tandem.plans.training import Prepared, stored_blocks
from tandem.session import local_rows, stage

# What each group adds to the basic columns (raw goal, duration, four level columns).
FEATURE_GROUPS = {
    "basic columns": FeatureSpec(cfg.BASIC_NUMERIC, cfg.BASIC_CATEGORICAL),
    "log goal instead of goal": FeatureSpec(("log_goal", "duration_days"), cfg.BASIC_CATEGORICAL),
    "title length": FeatureSpec((*cfg.BASIC_NUMERIC, "name_len", "name_words"), cfg.BASIC_CATEGORICAL),
    "launch date": FeatureSpec(cfg.BASIC_NUMERIC, cfg.CATEGORICAL),
    "everything": FeatureSpec(),
    "everything, no text": FeatureSpec(with_text=False),
}

INTERACTIONS = {
    "none": FeatureSpec(),
    "goal by main category": FeatureSpec(slopes=(("log_goal", "main_category"),)),
    "goal by category": FeatureSpec(slopes=(("log_goal", "category"),)),
    "10 goal bins": FeatureSpec(bins=(("log_goal", 10),)),
    "25 goal bins": FeatureSpec(bins=(("log_goal", 25),)),
    "50 goal bins": FeatureSpec(bins=(("log_goal", 50),)),
    "goal bin by main category": FeatureSpec(cells=(("log_goal", cfg.GOAL_BINS, "main_category"),)),
}


def collected(table: DataFrame) -> DataFrame:
    """Run a report now: a few metric rows, kept as a small table."""
    return table.sparkSession.createDataFrame(table.collect(), table.schema)


def adapted(spec: FeatureSpec, data: Prepared) -> FeatureSpec:
    """The spec with the vocabulary that ``data`` was prepared with."""
    return replace(spec, max_terms=data.model.spec.max_terms, min_doc_freq=data.model.spec.min_doc_freq)


def stored_variants(data: Prepared, specs: dict[str, FeatureSpec]) -> tuple[FusedModel, multifit.Rows]:
    """The columns of all given and all standard variants, stored once for a prepared table."""
    every = [*FEATURE_GROUPS.values(), *INTERACTIONS.values()]
    every += [s for s in specs.values() if s not in every]
    return stored_blocks(data, adapted(wider(*every), data))


def fitted_variants(data: Prepared, specs: dict[str, FeatureSpec], C: float) -> tuple[FusedModel, multifit.Rows, multifit.Fitted]:
    model, rows = stored_variants(data, specs)
    masks = [tuple(model.columns_of(adapted(spec, data))) for spec in specs.values()]
    return model, rows, multifit.fit(rows, [Problem(C, columns=m) for m in masks])


def _variants(data: Prepared, specs: dict[str, FeatureSpec], C: float) -> DataFrame:
    model, rows, fitted = fitted_variants(data, specs, C)
    widths = [sum(p.columns) for p in fitted.problems]
    extra = [sum(c and b == "interaction" for c, b in zip(p.columns, model.blocks)) for p in fitted.problems]
    facts = local_rows(
        data.records.sparkSession,
        {"variant_index": list(range(len(specs))), "variant": list(specs), "n_features": widths, "n_extra": extra},
        "variant_index int, variant string, n_features int, n_extra int")
    scored = met.score(multifit.predict(rows, fitted, list(specs)), 0.5, ("model", "split")).withColumnRenamed("model", "variant")
    return collected(facts.join(scored, "variant").select(
        "variant_index", "variant", "split", "n_features", "n_extra", *met.METRICS)
        .orderBy("variant_index", "split"))


def feature_groups(data: Prepared, C: float = 10.0) -> DataFrame:
    return _variants(data, FEATURE_GROUPS, C)


def interactions(data: Prepared, C: float = 10.0) -> DataFrame:
    return _variants(data, INTERACTIONS, C)


def with_deltas(table: DataFrame, metric: str = "f1", tree_value: float | None = None) -> DataFrame:
    """Difference to the first variant on the same split, and the gap left to a tree."""
    base = table.where(F.col("variant_index") == 0).select("split", F.col(metric).alias("_base"))
    out = table.join(F.broadcast(base), "split").withColumn(
        f"{metric}_delta", F.col(metric) - F.col("_base")).drop("_base")
    if tree_value is not None:
        out = out.withColumn("gap_to_tree", F.lit(tree_value) - F.col(metric))
    return out


def modality_masks(model: FusedModel) -> dict[str, tuple[bool, ...]]:
    return {"text only": tuple(b == "text" for b in model.blocks), "tabular only": tuple(b != "text" for b in model.blocks),
            "fused": (True,) * model.width}


def modalities(data: Prepared, C: float = 1.0) -> DataFrame:
    """Text alone, tabular alone, both."""
    model, rows = stored_blocks(data)
    masks = modality_masks(model)
    fitted = multifit.fit(rows, [Problem(C, columns=m) for m in masks.values()])
    return collected(met.score(multifit.predict(rows, fitted, list(masks)), 0.5, ("model", "split")))


TUNED = "l2, C=1, tuned threshold"
KNOBS = {
    "l2, C=1": Problem(1.0), "l2, C=10": Problem(10.0),
    "l2, C=1, balanced": Problem(1.0, balanced=True),
    "l1, C=1": Problem(1.0, "l1"),
}


def knobs(data: Prepared) -> DataFrame:
    """Strength, class weights, penalty and a validation-tuned threshold, in one table."""
    _, rows = stored_blocks(data)
    preds = stage(multifit.predict(rows, multifit.fit(rows, list(KNOBS.values())), list(KNOBS)), "knobs")
    plain = preds.where(F.col("model") == next(iter(KNOBS)))
    cut = met.tune_threshold(plain).first()["threshold"]
    tuned = met.score(plain.withColumn("model", F.lit(TUNED)), cut, ("model", "split"))
    return collected(met.score(preds, 0.5, ("model", "split")).unionByName(tuned))


def ranked(table: DataFrame, metric: str = "f1", n: int = 10, key: str = "model") -> DataFrame:
    """The ``n`` best runs."""
    return table.orderBy(F.desc(metric), F.asc(key)).limit(n)
