"""Queries: every source and sink, written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem import config as cfg
from tandem.catalog import base as b
from tandem.catalog.base import query, r, rnd, sql
from tandem.operators import fusion, learn, metrics as met, prepare
from tandem.operators.textblock import explode_vector
from tandem.operators.ordering import union_all
from tandem.session import stage, stage_path
from tandem.sources import files, tables as t


@query("src_raw", sql("SELECT * FROM campaigns", "campaigns"))
def src_raw(spark, d):
    """Campaigns through CSV with a declared schema."""
    path = stage_path(spark, "raw-csv")
    files.write_campaign_csv(t.campaigns(spark, d), path)
    return files.read_campaign_csv(spark, path)


@query("src_interim", sql(f"""
    SELECT id, coalesce(name_clean, '') AS name_clean, {r('log_goal')} AS log_goal, launch_year, launch_month,
           launch_dow, name_len, name_words FROM eng""", "eng"))
def src_interim(spark, d):
    stored = stage(prepare.add_clean_title(prepare.base_table(t.campaigns(spark, d))), "interim")
    rows = prepare.add_engineered(prepare.drop_empty_titles(stored.fillna({"name_clean": ""})))
    return rows.select("id", "name_clean", rnd("log_goal").alias("log_goal"), "launch_year", "launch_month",
                       "launch_dow", "name_len", "name_words")


@query("src_splits", sql("SELECT id, split FROM split3", "split3"))
def src_splits(spark, d):
    return stage(b.records(spark, d).select("id", "split"), "splits", ("split",)).select("id", "split")


@query("src_blocks", sql(f"""
    SELECT id, split, count(*) AS cells, {r('sum(weight)')} AS total FROM cw JOIN rec USING (id)
    GROUP BY id, split""", "cw", "rec"))
def src_blocks(spark, d):
    path = stage_path(spark, "text-block")
    files.write_blocks(b.prepared(spark, d).rows.select("id", "split", "target", "text_vec"), path)
    cells = explode_vector(files.read_blocks(spark, path), "text_vec", ("id", "split"))
    return cells.groupBy("id", "split").agg(F.count("*").alias("cells"), rnd(F.sum("weight")).alias("total"))


_NAMES = met.METRICS


@query("src_metrics", sql(f"""
    SELECT split, {', '.join(f'{r(chr(34) + n + chr(34))} AS "{n}"' for n in _NAMES)} FROM metrics""", "metrics"))
def src_metrics(spark, d):
    """Metrics from stored predictions through a stored CSV table: nothing is refitted."""
    preds = stage(b.scores(spark, d), "predictions", ("split",))
    table = met.score(preds, 0.5, ("split",)).select("split", *[rnd(n).alias(n) for n in _NAMES])
    path = stage_path(spark, "metrics")
    files.write_report(table, path)
    return files.read_report(spark, path, table.schema)


@query("snk_base", sql(f"""
    SELECT * REPLACE ({r('duration_days')} AS duration_days) FROM base""", "base"))
def snk_base(spark, d):
    stored = stage(prepare.base_table(t.campaigns(spark, d)), "base")
    return stored.withColumn("duration_days", rnd("duration_days"))


@query("snk_clean", sql("SELECT id, name_clean, name_clean_tokens FROM clean WHERE name_clean <> ''", "clean"))
def snk_clean(spark, d):
    clean = prepare.add_clean_title(prepare.base_table(t.campaigns(spark, d)))
    return stage(prepare.drop_empty_titles(clean), "clean").select("id", "name_clean", "name_clean_tokens")


@query("snk_splits", sql("SELECT id, split FROM split3", "split3"))
def snk_splits(spark, d):
    return stage(b.records(spark, d).select("id", "split"), "splits")


@query("snk_blocks", sql(f"""
    SELECT split, feature, count(*) AS cells, {r('sum(value * value)', 4)} AS energy FROM cells
    WHERE value <> 0 GROUP BY split, feature""", "cells"))
def snk_blocks(spark, d):
    """Fused blocks and their column dictionary, stored and matched up again."""
    data = b.prepared(spark, d)
    path = stage_path(spark, "blocks")
    files.write_blocks(data.rows.select("id", "split", "target", "features"), path)
    names = stage(data.model.feature_dict(spark), "feature-names")
    cells = fusion.vector_cells(files.read_blocks(spark, path), names, keep=("id", "split"))
    return cells.groupBy("split", "feature").agg(F.count("*").alias("cells"),
                                        rnd(F.sum(F.col("value") * F.col("value")), 4).alias("energy"))


@query("snk_preds", sql("""
    SELECT id, split, 'scores' AS model, label, proba FROM scores
    UNION ALL SELECT id, split, 'flipped', label, 1.0::DOUBLE - proba FROM scores""", "scores"))
def snk_preds(spark, d):
    preds = b.scores(spark, d)
    both = union_all([
        preds.withColumn("model", F.lit("scores")),
        preds.withColumn("model", F.lit("flipped")).withColumn("proba", F.lit(1.0) - F.col("proba"))])
    path = stage_path(spark, "predictions")
    files.write_blocks(both.select("id", "split", "model", "label", "proba"), path)
    return files.read_blocks(spark, path).select("id", "split", "model", "label", "proba")


@query("snk_tables", sql(f"""
    SELECT split, grid_index, threshold, {r('f1')} AS f1 FROM sweep""", "sweep"))
def snk_tables(spark, d):
    table = met.threshold_sweep(b.scores(spark, d), ("split",)).select(
        "split", "grid_index", "threshold", rnd("f1").alias("f1"))
    path = stage_path(spark, "sweep")
    files.write_report(table, path)
    return files.read_report(spark, path, table.schema)


@query("snk_meta", sql(f"""
    SELECT (SELECT count(*) FROM split3 WHERE split = 'train') AS n_train,
           (SELECT count(*) FROM split3 WHERE split = 'val') AS n_val,
           (SELECT count(*) FROM split3 WHERE split = 'test') AS n_test,
           (SELECT count(*) FROM features) AS n_features,
           (SELECT count(*) FROM features WHERE block = 'text') AS n_text,
           '{','.join(cfg.NUMERIC)}' AS numeric_cols""", "split3", "features"))
def snk_meta(spark, d):
    rec, model = b.records(spark, d), b.features(spark, d)
    counts = rec.agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")])
    widths = model.block_widths()
    document = counts.select(
        "*", F.lit(model.width).cast("long").alias("n_features"),
        F.create_map(*[F.lit(x) for k, v in widths.items() for x in (k, v)]).alias("blocks"),
        F.array(*[F.lit(c) for c in cfg.NUMERIC]).alias("numeric_cols"))
    path = stage_path(spark, "meta")
    files.write_document(document, path)
    stored = spark.read.schema(document.schema).json(path)
    return stored.select("n_train", "n_val", "n_test", "n_features",
                         F.col("blocks")["text"].cast("long").alias("n_text"),
                         F.array_join("numeric_cols", ",").alias("numeric_cols"))


@query("snk_model", sql("""
    SELECT count(*) AS "rows", true AS same FROM rec""", "rec"))
def snk_model(spark, d):
    """A saved and reloaded pipeline and model give the same probabilities."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegressionModel
    from tandem.catalog.models import linear
    data, model = b.prepared(spark, d), linear(spark, d)
    path = stage_path(spark, "model")
    data.model.pipeline.write().overwrite().save(f"{path}/features")
    model.write().overwrite().save(f"{path}/linear")
    again = PipelineModel.load(f"{path}/features").transform(data.records)
    second = learn.predict(LogisticRegressionModel.load(f"{path}/linear"), again, "stored")
    first = learn.predict(model, data.rows, "fitted")
    both = first.join(second.select("id", F.col("proba").alias("p2")), "id")
    return both.agg(F.count("*").alias("rows"), (F.max(F.abs(F.col("proba") - F.col("p2"))) < 1e-12).alias("same"))
