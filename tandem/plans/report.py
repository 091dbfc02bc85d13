"""Report tables from a stored run: nothing is refitted.

These are the numbers behind every chart: model comparison, precision-recall
curves, threshold transfer, success by launch year, leading coefficients,
ablation deltas, and the quality gates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tandem.operators import metrics as met
from tandem.operators.ordering import union_all
from tandem.operators.profile import rate_by
from tandem.plans.training import CROSSED, LINEAR, TREES
from tandem.sources import files

COMPARISON_SCHEMA = "model string, threshold double, " + ", ".join(f"{m} double" for m in met.METRICS)
COEFFICIENT_SCHEMA = "idx int, feature string, block string, coef double, abs_coef double"
TUNED = f"{LINEAR} @val-thr"


def stored(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables a training run left under ``path``."""
    return {
        "comparison": files.read_report(spark, f"{path}/comparison", COMPARISON_SCHEMA),
        "coefficients": files.read_report(spark, f"{path}/coefficients", COEFFICIENT_SCHEMA),
        "predictions": files.read_blocks(spark, f"{path}/predictions"),
        "meta": spark.read.json(f"{path}/meta"),
    }


def model_comparison(run: dict[str, DataFrame], earlier: DataFrame | None = None) -> DataFrame:
    """(model, metric, value), an earlier run's models beside these, and the majority line."""
    table = run["comparison"].select("model", *met.METRICS)
    if earlier is not None:
        table = table.unionByName(earlier.select(F.concat(F.lit("earlier "), "model").alias("model"), *met.METRICS))
    majority = run["meta"].select(F.lit("majority class").alias("model"), F.lit("accuracy").alias("metric"),
                                  F.col("majority_accuracy").alias("value"))
    return met.compare(table).unionByName(majority)


def pr_curves(run: dict[str, DataFrame]) -> DataFrame:
    """Test curves per model with the no-skill precision beside them."""
    test = run["predictions"].where(F.col("split") == "test")
    curves = met.pr_curve(test, ("model",))
    return curves.withColumn("no_skill", test.agg(F.avg("label")).scalar())


def threshold_transfer(run: dict[str, DataFrame], model: str = LINEAR) -> DataFrame:
    return met.transfer(run["predictions"].where(F.col("model") == model))


def success_by_year(records: DataFrame) -> DataFrame:
    return rate_by(records.where(F.col("split") == "train"), "launch_year")


def leading_coefficients(coefficients: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` strongest on either side, with block prefixes stripped for display."""
    sides = {"success": F.desc("coef"), "failure": F.asc("coef")}
    picked = union_all([
        coefficients.orderBy(order, "feature").limit(k).withColumn("pushes", F.lit(side))
        for side, order in sides.items()])
    label = F.regexp_replace("feature", "^(text|num|cat|inter)__", "")
    return picked.select("pushes", "feature", label.alias("label"), "block", "coef")


def block_strength(coefficients: DataFrame) -> DataFrame:
    return coefficients.groupBy("block").agg(
        F.count("*").alias("n"), F.avg("abs_coef").alias("mean_abs"), F.sum("abs_coef").alias("sum_abs"))


def gap_recovered(interactions: DataFrame, tree_value: float, metric: str = "f1") -> DataFrame:
    """How much of the distance from the plain linear model to the trees each variant covers."""
    delta = F.col(f"{metric}_delta")
    return interactions.withColumn(
        "share_of_gap", F.try_divide(delta, F.lit(tree_value) - (F.col(metric) - delta)))


def quality_gates(run: dict[str, DataFrame], floors: dict[str, float] | None = None,
                  margin: float = 0.08, interaction_limit: float = 0.005) -> DataFrame:
    """Claims a run must keep: floors, margin over the majority class, trees ranking
    above the linear model, interactions not paying, and the tuned threshold's trade."""
    by_model = run["comparison"].groupBy().agg(*[
        F.max(F.when(F.col("model") == name, F.col(m))).alias(f"{short}_{m}")
        for short, name in (("linear", LINEAR), ("trees", TREES), ("tuned", TUNED), ("crossed", CROSSED))
        for m in met.METRICS])
    facts = by_model.withColumns({
        "majority": run["meta"].select("majority_accuracy").scalar(),
        "rows": run["meta"].select((F.col("n_val") + F.col("n_test")).cast("double")).scalar(),
        "predicted": run["predictions"].where(F.col("model") == LINEAR).agg(F.count("*").cast("double")).scalar(),
        "interaction_gain": F.col("crossed_f1") - F.col("linear_f1"),
    }).withColumn("majority_plus_margin", F.col("majority") + F.lit(margin))
    rules = [
        ("linear clears the majority class", "linear_accuracy", ">", "majority_plus_margin"),
        ("trees clear the majority class", "trees_accuracy", ">", "majority_plus_margin"),
        ("trees rank above linear (auc)", "trees_roc_auc", ">", "linear_roc_auc"),
        ("trees rank above linear (ap)", "trees_average_precision", ">", "linear_average_precision"),
        ("interactions do not pay", "interaction_gain", "<", interaction_limit),
        ("tuning raises recall", "tuned_recall", ">", "linear_recall"),
        ("tuning raises f1", "tuned_f1", ">", "linear_f1"),
        ("tuning costs accuracy", "tuned_accuracy", "<", "linear_accuracy"),
        ("every held-out row is predicted", "predicted", "=", "rows"),
        *[(f"floor on {name}", name, ">=", bound) for name, bound in (floors or {}).items()],
    ]
    return met.gates(facts, rules)


def all_tables(spark: SparkSession, path: str, records: DataFrame | None = None) -> dict[str, DataFrame]:
    run = stored(spark, path)
    out = {
        "model_comparison": model_comparison(run), "pr_curves": pr_curves(run),
        "threshold_transfer": threshold_transfer(run),
        "leading_coefficients": leading_coefficients(run["coefficients"]),
        "block_strength": block_strength(run["coefficients"]), "quality_gates": quality_gates(run),
    }
    if records is not None:
        out["success_by_year"] = success_by_year(records)
    return out


def write_all(spark: SparkSession, path: str, records: DataFrame | None = None) -> list[str]:
    """Write every report table under ``path``/reports. Curves can be long and stay parquet."""
    tables = all_tables(spark, path, records)
    for name, table in tables.items():
        target = f"{path}/reports/{name}"
        if name == "pr_curves":
            table.write.mode("overwrite").parquet(target)
        else:
            files.write_report(table, target)
    return sorted(tables)
