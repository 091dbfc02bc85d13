"""The scorecard export job: tables, whole-table parity check, one JSON document."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession, functions as F

from tandem.operators import scorecard as sc
from tandem.operators.fusion import FusedModel
from tandem.operators.ordering import quantile_values
from tandem.operators.profile import level_tree, modal_child

# Enough decimals that rounding alone cannot reach the parity tolerance.
EXPORT_PLACES = 8


# How the two title numbers are derived from what a user types.
TITLE_FEATURES = {"name_len": "characters of the title as typed", "name_words": "words between white space"}
FORM_COLUMNS = ("main_category", "currency", "country", "launch_month")


def facts(frame: DataFrame, width: int) -> dict[str, float]:
    """Rows per split, columns, and the accuracy of always naming test's larger class; one aggregate."""
    if not {"split", "target"} <= set(frame.columns):
        return {"n_features": float(width)}
    rows = {r["split"]: r for r in frame.groupBy("split").agg(F.count("*").alias("n"), F.avg(F.col("target").cast("double")).alias("p")).collect()}
    out = {f"n_{name}": float(rows[name]["n"]) if name in rows else 0.0 for name in ("train", "val", "test")}
    share = rows["test"]["p"] if "test" in rows else None
    return {**out, "n_features": float(width), **({} if share is None else {"majority_accuracy": max(share, 1.0 - share)})}


def first_choices(frame: DataFrame) -> dict[str, str]:
    """Most common level of each form column, the smaller one on ties."""
    columns = [c for c in FORM_COLUMNS if c in frame.columns]
    row = frame.agg(*[F.mode(F.col(c).cast("string"), True).alias(c) for c in columns]).first() if columns else {}
    return {c: row[c] for c in columns if row[c] is not None}


def defaults(frame: DataFrame) -> dict[str, object]:
    """Starting values of a scoring form: medians, latest year, most common child."""
    return {
        "goal_usd": quantile_values(frame, "usd_goal_real", [0.5])[0],
        "duration_days": quantile_values(frame, "duration_days", [0.5])[0],
        "launch_year": frame.where(F.col("launch_year") != "unknown").agg(
            F.max(F.col("launch_year").try_cast("int")).cast("string")).first()[0],
    }


def from_logistic(model: FusedModel, linear: Model, thresholds=None, metrics=None) -> sc.Scorecard:
    return sc.build(model, linear.coefficients.toArray(), linear.intercept, thresholds, metrics,
                    places=EXPORT_PLACES)


def document(card: sc.Scorecard, frame: DataFrame) -> DataFrame:
    """The nested one-row payload with its form defaults, and what it was made from."""
    spark = frame.sparkSession

    def mapped(values: dict, kind: str):
        pairs = [F.lit(x) for k, v in values.items() for x in (k, v)]
        return (F.create_map(*pairs) if pairs else F.create_map()).cast(f"map<string,{kind}>")

    tree = level_tree(frame, "main_category", "category").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("parent", "children")))).alias("t"))
    modal = modal_child(frame, "main_category", "category").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("parent", "child")))).alias("m"))
    return sc.payload(card, spark, defaults(frame)).select(
        "*", tree.select("t").scalar().alias("category_tree"),
        modal.select("m").scalar().alias("default_category"), F.lit("logistic regression, l2").alias("model"),
        mapped(TITLE_FEATURES, "string").alias("title_features"), mapped(facts(frame, card.width), "double").alias("facts"),
        mapped(first_choices(frame), "string").alias("form"))


def export(card: sc.Scorecard, records: DataFrame, expected: DataFrame, path: str,
           tol: float = 1e-6) -> float:
    """Check every expected prediction against the scorecard, then write the document."""
    scored = sc.score_records(card, records).join(expected.select("id"), "id", "left_semi")
    worst = sc.assert_parity(expected, scored, tol)
    document(card, records).coalesce(1).write.json(path)
    return worst


def load(spark: SparkSession, path: str) -> sc.Scorecard:
    return sc.from_payload(spark.read.schema(sc.PAYLOAD_SCHEMA).json(path))
