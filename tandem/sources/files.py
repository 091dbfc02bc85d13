"""Readers and writers: campaign CSV, staged tables, small report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tandem.sources.tables import CAMPAIGN_SCHEMA

# Quotes are doubled, line breaks kept, and white space at a value's ends is data.
CSV_OPTIONS = {"header": "true", "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_campaign_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Campaign CSV with a declared schema; quoted titles may hold commas.

    Line breaks inside quotes need ``multi_line``, and then each file is read by one task: convert such files once.
    """
    return spark.read.options(**CSV_OPTIONS, multiLine=multi_line).schema(CAMPAIGN_SCHEMA).csv(path)


def write_campaign_csv(df: DataFrame, path: str) -> None:
    df.select(*CAMPAIGN_SCHEMA.names).write.options(
        **CSV_OPTIONS, quoteAll="true", emptyValue="").csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """One CSV file for a report table (grids, metrics, top-k lists)."""
    df.coalesce(1).write.options(**CSV_OPTIONS, quoteAll="true").csv(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def write_blocks(df: DataFrame, path: str) -> None:
    """Feature rows, one folder per split so that a later job reads only its own."""
    df.write.partitionBy("split").parquet(path)


def read_blocks(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    blocks = spark.read.parquet(path)
    return blocks if split is None else blocks.where(F.col("split") == split)


def write_bucketed(df: DataFrame, path: str, name: str, buckets: int, key: str = "id") -> DataFrame:
    """A table under ``path`` whose files are split and sorted by ``key``: two such tables join without a shuffle."""
    df.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row table as a JSON document."""
    df.coalesce(1).write.json(path)
