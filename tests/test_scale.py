"""Fits scan few times, and what a task reads doesn't grow with the table."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tandem.operators import learn, multifit, sparse


@pytest.mark.parametrize("balanced", [False, True])
def test_a_single_fit_is_spark_mls_optimum_from_few_scans(spark, prepared, monkeypatch, balanced):
    scans = []
    real = multifit._gradients
    monkeypatch.setattr(multifit, "_gradients", lambda *a, **k: (scans.append(1), real(*a, **k))[1])
    model = learn.fit_logistic(prepared.train, 1.0, balanced=balanced)
    assert 0 < len(scans) <= 40
    n, positives = prepared.train.agg(F.count("*"), F.sum("target")).first()
    weight = F.when(F.col("target") == 1, n / (2.0 * positives)).otherwise(n / (2.0 * (n - positives))) if balanced else F.lit(1.0)
    rows = prepared.train.select("features", F.col("target").cast("double").alias("label"), weight.alias("w"))
    own = LogisticRegression(regParam=1.0 / n, standardization=False, maxIter=2000, tol=1e-12, weightCol="w").fit(rows)
    np.testing.assert_allclose(model.coefficients.toArray(), own.coefficients.toArray(), atol=1e-4)
    assert abs(model.intercept - own.intercept) < 1e-3


def test_a_writing_task_gets_a_bounded_number_of_rows(spark, monkeypatch):
    df = spark.range(10_000)
    assert sparse.dealt(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(sparse, "TASK_ROWS", 500)
    dealt = sparse.dealt(df)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 600 and sum(sizes) == 10_000


def test_trees_read_dealt_rows(prepared, monkeypatch):
    given = []
    monkeypatch.setattr(learn, "dealt", lambda df: (given.append(df.columns), sparse.dealt(df))[1])
    train = prepared.train.limit(200).withColumn("dense", F.col("num_vec") if "num_vec" in prepared.train.columns else F.col("features"))
    learn.fit_boosting(train, rounds=1, depth=1)
    assert given == [["dense", "label", "held"]]
