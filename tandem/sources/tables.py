"""Input tables and the three logical views built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tandem.config import LABELLED_STATES, POSITIVE_STATE
from tandem.functions.numeric import unit_hash

CAMPAIGN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("main_category", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("usd_goal_real", T.DoubleType()),
    T.StructField("launched", T.TimestampNTZType()),
    T.StructField("deadline", T.TimestampNTZType()),
    T.StructField("state", T.StringType()),
    T.StructField("pledged", T.DoubleType()),
    T.StructField("backers", T.LongType()),
])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def campaigns(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, seen as a campaign with text, levels, dates and outcome.

    The line items are reduced per order before any join, and the dimension
    joins carry no hints: their sizes are left to the optimizer.
    """
    orders = table(spark, folder, "orders")
    items = (
        table(spark, folder, "lineitem").groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("partkey"),
             F.max("l_shipdate").alias("deadline"),
             F.sum("l_quantity").alias("pledged"),
             F.count("*").alias("backers"))
    )
    part = table(spark, folder, "part")
    places = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    customer = (
        table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_mktsegment", "n_name", "r_name")
    )
    status = F.col("o_orderstatus")
    return (
        orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(part, F.col("p_partkey") == F.col("partkey"))
        .join(customer, F.col("c_custkey") == F.col("o_custkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.col("p_name"), F.lit(" of the "), F.col("p_type"), F.lit(" #"),
                     F.col("p_size").cast("string")).alias("name"),
            F.col("p_type").alias("category"),
            F.col("c_mktsegment").alias("main_category"),
            F.col("r_name").alias("currency"),
            F.col("n_name").alias("country"),
            F.col("o_totalprice").alias("usd_goal_real"),
            F.col("o_orderdate").alias("launched"),
            "deadline",
            F.when(status == "F", "successful").when(status == "O", "failed")
            .otherwise("canceled").alias("state"),
            "pledged", "backers",
        )
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Long multilingual texts with a skewed number and a partly missing label."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("target"))
    return (
        table(spark, folder, "documents").join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").alias("id"),
            F.col("text").alias("name"),
            F.col("source").alias("category"),
            F.col("lang").alias("main_category"),
            F.col("n_chars").cast("double").alias("usd_goal_real"),
            "target",
        )
    )


def pseudo_scores(frame: DataFrame) -> DataFrame:
    """(id, label, split, proba) with hash-made, heavily tied scores."""
    key = F.col("id").cast("string")
    label = (F.col("state") == POSITIVE_STATE).cast("int")

    def hashed(tag: str) -> Column:
        return unit_hash(F.concat(key, F.lit(f":{tag}")))

    where = hashed("split")
    raw = (hashed("score") * F.lit(3.0) + label) / F.lit(4.0)
    return frame.where(F.col("state").isin(*LABELLED_STATES)).select(
        "id",
        label.alias("label"),
        F.when(where < 0.64, "train").when(where < 0.8, "val").otherwise("test").alias("split"),
        (F.floor(raw * F.lit(64.0)).cast("double") / F.lit(64.0)).alias("proba"),
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_scores(campaigns(spark, folder))
