"""The command-line jobs, end to end on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from tandem import __main__ as jobs
from tandem.operators import metrics as met
from tandem.plans import export, report, training
from tandem.sources import files, tables as t


@pytest.fixture(scope="module")
def run(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("run") / "out")
    jobs.main(["train", "--input", folder, "--output", path, "--rounds", "3", "--rank", "5"])
    return path


def test_reports_come_from_stored_tables(spark, folder, run):
    jobs.main(["report", "--input", folder, "--output", run])
    tables = report.all_tables(spark, run)
    long = {(r["model"], r["metric"]): r["value"] for r in tables["model_comparison"].collect()}
    assert (training.TREES, "roc_auc") in long and ("majority class", "accuracy") in long
    chosen = tables["threshold_transfer"].where("chosen").collect()
    meta = spark.read.json(f"{run}/meta").first()
    assert len(chosen) == 1 and chosen[0]["threshold"] == meta["thresholds"][training.LINEAR]
    curve = spark.read.parquet(f"{run}/reports/pr_curves")
    assert curve.where("recall < 0 OR recall > 1 OR precision > 1").count() == 0
    names = {r["pushes"]: r["n"] for r in tables["leading_coefficients"].groupBy("pushes").agg(F.count("*").alias("n")).collect()}
    assert names == {"success": 15, "failure": 15}
    years = files.read_report(spark, f"{run}/reports/success_by_year", "launch_year string, n long, rate double")
    assert years.agg(F.sum("n")).first()[0] == meta["n_train"]


def test_gates_compare_the_stored_numbers(spark, run):
    stored = report.stored(spark, run)
    rows = {r["gate"]: r for r in report.quality_gates(stored, {"linear_f1": 0.0, "trees_f1": 1.1}).collect()}
    assert rows["every held-out row is predicted"]["ok"]
    assert rows["floor on linear_f1"]["ok"] and not rows["floor on trees_f1"]["ok"]
    table = {r["model"]: r for r in stored["comparison"].collect()}
    tuned = rows["tuning raises recall"]
    assert tuned["value"] == table[report.TUNED]["recall"] and tuned["bound"] == table[training.LINEAR]["recall"]


def test_earlier_run_beside_this_one(spark, run):
    stored = report.stored(spark, run)
    both = report.model_comparison(stored, stored["comparison"])
    assert both.where(F.col("model").startswith("earlier ")).count() == 5 * len(met.METRICS)


def test_export_job_checks_the_stored_model(spark, folder, run, tmp_path, capsys):
    other = str(tmp_path / "again")
    spark.read.parquet(f"{run}/feature_dict")  # the run is complete
    from pyspark.ml.classification import LogisticRegressionModel
    LogisticRegressionModel.load(f"{run}/linear_model").write().save(f"{other}/linear_model")
    jobs.main(["export", "--input", folder, "--output", other])
    assert "at most" in capsys.readouterr().out
    first, second = export.load(spark, f"{run}/scorecard"), export.load(spark, f"{other}/scorecard")
    assert first.terms == second.terms and first.levels == second.levels
    assert first.thresholds["f1_optimal"] > 0 and first.metrics


def test_score_job_streams_raw_files(spark, folder, run, tmp_path):
    raw = t.campaigns(spark, folder).select(*t.CAMPAIGN_SCHEMA.names)
    raw.write.parquet(str(tmp_path / "raw"))
    jobs.main(["score", "--input", str(tmp_path / "raw"), "--output", run])
    assert spark.read.parquet(f"{run}/scores").count() == raw.count()


def test_odd_level_names_survive_report_files(spark, tmp_path):
    df = spark.createDataFrame([('cat__country_N,0"', 0.5), (" lead, trail ", 1.0)], "feature string, coef double")
    files.write_report(df, str(tmp_path / "r"))
    back = files.read_report(spark, str(tmp_path / "r"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
