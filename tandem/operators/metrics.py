"""Evaluation of (label, proba) rows. Nothing here needs the model.

Threshold metrics are one aggregate. Ranking metrics merge equal scores first
and then use slice-wise running totals, so no task sorts the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tandem import config as cfg
from tandem.functions.numeric import ratio
from tandem.operators.ordering import totals_before, union_all
from tandem.session import stage

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")


def _rates(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    return {
        "accuracy": ratio(tp + tn, tp + fp + tn + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def scored(preds: DataFrame) -> DataFrame:
    """The rows that metrics count: a null label, and a null or NaN score, belong to neither side of any table.

    ``unscored`` counts the others."""
    return preds.where(F.col("label").isNotNull() & F.col("proba").isNotNull() & ~F.isnan("proba"))


def unscored(preds: DataFrame, groups=()) -> DataFrame:
    """Rows per group that no metric counts."""
    kept = F.col("label").isNotNull() & F.col("proba").isNotNull() & ~F.isnan("proba")
    return preds.groupBy(*groups).agg(F.count_if(~F.coalesce(kept, F.lit(False))).alias("unscored"))


def confusion(preds: DataFrame, threshold: float | Column = 0.5, groups=()) -> DataFrame:
    """tp, fp, tn, fn at ``proba >= threshold``, in one aggregate."""
    yes = F.col("proba") >= (threshold if isinstance(threshold, Column) else F.lit(float(threshold)))
    pos = F.col("label") == 1
    return scored(preds).groupBy(*groups).agg(
        F.count_if(yes & pos).alias("tp"), F.count_if(yes & ~pos).alias("fp"),
        F.count_if(~yes & ~pos).alias("tn"), F.count_if(~yes & pos).alias("fn"))


def score_state(preds: DataFrame, groups=()) -> DataFrame:
    """Positives and negatives per group and score: all that any metric reads.

    States add up: the rows of new predictions become a state of their own and are
    merged with what is stored, without the old rows.
    """
    hit = F.col("label") == 1
    return scored(preds).groupBy(*groups, "proba").agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))


def merge_states(*states: DataFrame, groups=()) -> DataFrame:
    return union_all(states).groupBy(*groups, "proba").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def stored_state(preds: DataFrame, groups=()) -> DataFrame:
    """The state of predictions, written once; every metric below reads it instead of them."""
    return stage(score_state(preds, groups), "score-state")


def state_totals(state: DataFrame, groups=()) -> DataFrame:
    """A stored state with ``tp`` and ``fp``, the positives and negatives at a score or above, and
    ``P`` and ``N``, those of the whole group."""
    rows = totals_before(state, "proba", ("pos", "neg"), tuple(groups), descending=True)
    return rows.select(*groups, "proba", "pos", "neg", (F.col("pos_before") + F.col("pos")).alias("tp"),
                       (F.col("neg_before") + F.col("neg")).alias("fp"), F.col("pos_all").alias("P"), F.col("neg_all").alias("N"))


def score_totals(preds: DataFrame, groups=()) -> DataFrame:
    """Per distinct score: its positives and negatives, and ``tp`` and ``fp``, the
    positives and negatives at that score or above."""
    return state_totals(stored_state(preds, groups), groups).drop("P", "N")


def _ranking_terms() -> dict[str, Column]:
    """Aggregates over score totals; P and N are the sums of pos and neg."""
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    all_pairs = 2.0 * F.sum(pos) * F.sum(neg)
    lost = F.sum(pos * (2.0 * fp - neg))  # ties lose half
    return {
        "roc_auc": F.try_divide(all_pairs - lost, all_pairs),
        "average_precision": ratio(F.sum(pos * tp / (tp + fp)), F.sum(pos)),
    }


def ranking(preds: DataFrame, groups=()) -> DataFrame:
    """ROC-AUC (ties count half) and step-wise average precision."""
    return state_ranking(stored_state(preds, groups), groups)


def state_ranking(state: DataFrame, groups=()) -> DataFrame:
    return state_totals(state, groups).groupBy(*groups).agg(*[v.alias(k) for k, v in _ranking_terms().items()])


def pr_curve(preds: DataFrame, groups=()) -> DataFrame:
    """(threshold, precision, recall) for every distinct score."""
    return state_curve(stored_state(preds, groups), groups)


def state_curve(state: DataFrame, groups=()) -> DataFrame:
    tp, fp = F.col("tp"), F.col("fp")
    return state_totals(state, groups).select(
        *groups, F.col("proba").alias("threshold"), ratio(tp, tp + fp).alias("precision"), ratio(tp, F.col("P")).alias("recall"))


def score(preds: DataFrame, threshold: float = 0.5, groups=()) -> DataFrame:
    """The full metric row at one threshold; all of it from the per-score counts."""
    return state_score(stored_state(preds, groups), threshold, groups)


def state_score(state: DataFrame, threshold: float = 0.5, groups=()) -> DataFrame:
    yes = F.col("proba") >= F.lit(float(threshold))

    def count(name: str, chosen: Column) -> Column:
        return F.coalesce(F.sum(F.when(chosen, F.col(name))), F.lit(0))

    cells = (count("pos", yes), count("neg", yes), count("neg", ~yes), count("pos", ~yes))
    return state_totals(state, groups).groupBy(*groups).agg(
        F.lit(float(threshold)).alias("threshold"),
        *[v.alias(k) for k, v in {**_rates(*cells), **_ranking_terms()}.items()])


def threshold_grid(first: int = cfg.THRESHOLD_FIRST, last: int = cfg.THRESHOLD_LAST) -> Column:
    return F.sequence(F.lit(first), F.lit(last))


def threshold_sweep(preds: DataFrame, groups=(), first: int = cfg.THRESHOLD_FIRST,
                    last: int = cfg.THRESHOLD_LAST) -> DataFrame:
    """Metrics at every k/100 of the grid from one pass over the rows.

    A row is counted once, under the largest k with k/100 <= proba; the grid
    then sums at most ``last - first + 2`` counts per group.
    """
    hit = F.col("label") == 1
    return _sweep(scored(preds).groupBy(*groups, grid_place(first, last).alias("k")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")), groups, first, last)


def state_sweep(state: DataFrame, groups=(), first: int = cfg.THRESHOLD_FIRST, last: int = cfg.THRESHOLD_LAST) -> DataFrame:
    """The same from a stored state."""
    return _sweep(state.groupBy(*groups, grid_place(first, last).alias("k")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), groups, first, last)


def grid_place(first: int = cfg.THRESHOLD_FIRST, last: int = cfg.THRESHOLD_LAST) -> Column:
    """The largest k of the grid with k/100 <= proba, or the one before the first."""
    p = F.col("proba")
    guess = F.floor(p * 100).cast("int")
    step = (F.when(p >= (guess + 1).cast("double") / 100.0, 1)
            .when(p < guess.cast("double") / 100.0, -1).otherwise(0))
    return F.greatest(F.least(guess + step, F.lit(last)), F.lit(first - 1))


def _sweep(counts: DataFrame, groups, first: int, last: int) -> DataFrame:
    cells = counts.groupBy(*groups).agg(
        F.collect_list(F.struct("k", "pos", "neg")).alias("cells"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    grid = cells.select(*groups, "cells", "P", "N",
                        F.explode(threshold_grid(first, last)).alias("grid_index"))

    def at_least(name: str) -> Column:
        kept = F.filter("cells", lambda c: c["k"] >= F.col("grid_index"))
        return F.aggregate(kept, F.lit(0).cast("long"), lambda a, c: a + c[name])

    tp, fp = F.col("tp"), F.col("fp")
    rates = _rates(tp, fp, F.col("N") - fp, F.col("P") - tp)
    return grid.select("*", at_least("pos").alias("tp"), at_least("neg").alias("fp")).select(
        *groups, "grid_index", (F.col("grid_index").cast("double") / 100.0).alias("threshold"),
        *[v.alias(n) for n, v in rates.items()])


def best_row(table: DataFrame, metric: str, order: str, groups=()) -> DataFrame:
    """Row with the largest ``metric``; on ties the smallest ``order`` wins."""
    whole = F.struct(*[c for c in table.columns if c not in groups])
    return table.groupBy(*groups).agg(
        F.max_by(whole, F.struct(F.col(metric), -F.col(order))).alias("r")).select(*groups, "r.*")


def nearest_row(table: DataFrame, column: str, value: float, order: str) -> DataFrame:
    """Row whose ``column`` is nearest ``value``; on ties the smallest ``order``."""
    return table.agg(F.min_by(F.struct(*table.columns), F.struct(
        F.round(F.abs(F.col(column) - F.lit(float(value))), 9), F.col(order))).alias("r")).select("r.*")


def only_validation(preds: DataFrame) -> DataFrame:
    """Selection sees validation rows only, whatever it is handed."""
    if "split" not in preds.columns:
        raise ValueError("selection needs a split column to keep to validation rows")
    return preds.where(F.col("split") == "val")


def tune_threshold(preds: DataFrame, groups=()) -> DataFrame:
    """Grid row with the best validation F1; the lowest threshold wins ties."""
    return best_row(threshold_sweep(only_validation(preds), groups), "f1", "grid_index", groups)


def transfer(preds: DataFrame) -> DataFrame:
    """Validation and test F1 per threshold, marking the one validation chose."""
    sweep = threshold_sweep(preds.where(F.col("split").isin("val", "test")), ("split",))
    f1 = {s: F.max(F.when(F.col("split") == s, F.col("f1"))) for s in ("val", "test")}
    curves = sweep.groupBy("grid_index", "threshold").agg(
        f1["val"].alias("val_f1"), f1["test"].alias("test_f1"))
    chosen = best_row(curves.select("grid_index", "val_f1"), "val_f1", "grid_index")
    pick = chosen.select("grid_index").scalar()
    return curves.withColumn("chosen", F.col("grid_index") == pick)


def class_report(preds: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per-class precision, recall, F1 and support, with macro and weighted means."""
    c = confusion(preds, threshold)
    cells = {n: F.col(n) for n in ("tp", "fp", "tn", "fn")}

    def row(name: str, hit: str, wrong: str, missed: str) -> Column:
        a, b, m = cells[hit], cells[wrong], cells[missed]
        return F.struct(F.lit(name).alias("class"), ratio(a, a + b).alias("precision"),
                        ratio(a, a + m).alias("recall"), ratio(2 * a, 2 * a + b + m).alias("f1"),
                        (a + m).alias("support"))

    classes = c.select(F.array(row("0", "tn", "fn", "fp"), row("1", "tp", "fp", "fn")).alias("c"))

    def mean(name: str, weighted: bool) -> Column:
        a, b = F.col("c")[0], F.col("c")[1]
        n = a["support"] + b["support"]

        def m(x: str) -> Column:
            if weighted:
                return ratio(a[x] * a["support"] + b[x] * b["support"], n)
            return (a[x] + b[x]) / 2.0

        return F.struct(F.lit(name).alias("class"), m("precision").alias("precision"),
                        m("recall").alias("recall"), m("f1").alias("f1"), n.alias("support"))

    return classes.select(F.explode(F.concat(
        "c", F.array(mean("macro avg", False), mean("weighted avg", True)))).alias("r")).select("r.*")


# --- tables made of metric rows ---------------------------------------------

def compare(table: DataFrame, metrics=METRICS, key: str = "model") -> DataFrame:
    """Long form (model, metric, value) for side-by-side comparison."""
    return table.unpivot([key], list(metrics), "metric", "value")


def delta_to(table: DataFrame, baseline: Column, metric: str, name: str) -> DataFrame:
    """Difference of ``metric`` to the row(s) picked by ``baseline`` (one expected)."""
    base = table.where(baseline).select(F.max(metric)).scalar()
    return table.withColumn(name, F.col(metric) - base)


def overfit_gap(table: DataFrame, metrics=("f1",), key: str = "model") -> DataFrame:
    """Train minus test per model."""
    def at(m: str, s: str) -> Column:
        return F.max(F.when(F.col("split") == s, F.col(m)))

    return table.groupBy(key).agg(
        *[(at(m, "train") - at(m, "test")).alias(f"{m}_gap") for m in metrics])


def gates(facts: DataFrame, rules) -> DataFrame:
    """Check ``(name, metric, op, bound)`` rules against one row of facts.

    ``bound`` is a number or the name of another fact.
    """
    compare_with = {">=": lambda a, b: a >= b, ">": lambda a, b: a > b,
                    "<": lambda a, b: a < b, "=": lambda a, b: F.abs(a - b) < 1e-9}

    def rule(name: str, metric: str, op: str, bound) -> Column:
        value = F.col(metric).cast("double")
        limit = F.col(bound).cast("double") if isinstance(bound, str) else F.lit(float(bound))
        return F.struct(F.lit(name).alias("gate"), value.alias("value"), F.lit(op).alias("op"),
                        limit.alias("bound"), compare_with[op](value, limit).alias("ok"))

    return facts.select(F.explode(F.array(*[rule(*r) for r in rules])).alias("g")).select("g.*")
