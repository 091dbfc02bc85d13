"""Scoring a stream of raw campaigns.

Title cleaning, feature derivation, splitting by hash and scorecard scoring are
row-wise, so the stream needs no state, no watermark and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tandem.operators import prepare, scorecard as sc
from tandem.sources.tables import CAMPAIGN_SCHEMA


def campaign_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Campaign parquet files as they arrive in ``folder``."""
    return (spark.readStream.schema(CAMPAIGN_SCHEMA)
            .option("maxFilesPerTrigger", files_per_batch).parquet(folder))


def featurize(raw: DataFrame) -> DataFrame:
    """Derived columns for undecided campaigns: no label is needed to score."""
    rows = prepare.add_clean_title(prepare.add_basics(raw))
    return prepare.add_engineered(rows)


def score_stream(raw: DataFrame, card: sc.Scorecard) -> DataFrame:
    return sc.score_records(card, featurize(raw)).select("id", "z", "proba")


def write_scores(scores: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append scores as parquet; files are committed once per batch."""
    return (scores.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
