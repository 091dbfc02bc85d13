"""Jobs from the command line, or as the script of spark-submit.

    python -m tandem train  --input FOLDER --output RUN [--rounds N] [--rank K]
    python -m tandem ablate --input FOLDER --output RUN
    python -m tandem export --input FOLDER --output RUN
    python -m tandem report --input FOLDER --output RUN
    python -m tandem score  --input RAW_PARQUET --output RUN
"""

from __future__ import annotations

import argparse

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import SparkSession

from tandem import config as cfg
from tandem.plans import ablation, export, report, training
from tandem.sources import files, tables
from tandem.streaming import scoring


def train(spark, a) -> None:
    result = training.run(tables.campaigns(spark, a.input), rounds=a.rounds, rank=a.rank)
    training.save(result, a.output)
    card = export.from_logistic(
        result.prepared.model, result.linear,
        {"default": 0.5, "f1_optimal": result.thresholds[training.LINEAR]},
        {f"{r['model']}: {m}": r[m] for r in result.comparison.collect() for m in report.met.METRICS})
    linear = result.predictions.where("model = 'linear'")
    worst = export.export(card, result.prepared.records, linear, f"{a.output}/scorecard")
    result.comparison.show(truncate=False)
    print(f"scorecard differs from the model by at most {worst:.2e}")


def ablate(spark, a) -> None:
    data = training.prepare(tables.campaigns(spark, a.input))
    for name, table in (("feature_groups", ablation.feature_groups(data)),
                        ("interactions", ablation.interactions(data)),
                        ("modalities", ablation.modalities(data)), ("knobs", ablation.knobs(data))):
        if "variant_index" in table.columns:
            table = ablation.with_deltas(table)
        files.write_report(table, f"{a.output}/{name}")
        table.show(50, truncate=False)


def export_card(spark, a) -> None:
    """Rebuild the scorecard from the data, check it against the stored model, write it."""
    from tandem.operators import learn
    model = LogisticRegressionModel.load(f"{a.output}/linear_model")
    data = training.prepare(tables.campaigns(spark, a.input))
    card = export.from_logistic(data.model, model)
    worst = export.export(card, data.records, learn.predict(model, data.rows, training.LINEAR),
                          f"{a.output}/scorecard")
    print(f"scorecard differs from the model by at most {worst:.2e}")


def write_reports(spark, a) -> None:
    records = training.split_records(tables.campaigns(spark, a.input))
    print("\n".join(report.write_all(spark, a.output, records)))


def score(spark, a) -> None:
    card = export.load(spark, f"{a.output}/scorecard")
    stream = scoring.score_stream(scoring.campaign_stream(spark, a.input), card)
    scoring.write_scores(stream, f"{a.output}/scores", f"{a.output}/scores_marks").awaitTermination()


JOBS = {"train": train, "ablate": ablate, "export": export_card, "report": write_reports, "score": score}


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="tandem")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--rounds", type=int, default=cfg.BOOSTING_ROUNDS)
    parser.add_argument("--rank", type=int, default=cfg.SVD_RANK)
    a = parser.parse_args(argv)
    JOBS[a.job](SparkSession.builder.appName(f"tandem {a.job}").getOrCreate(), a)


if __name__ == "__main__":
    main()
