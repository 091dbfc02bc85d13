"""Deterministic stratified splits.

Within each stratum rows are ordered by (md5 of "id:tag", id), and the first
ceil(n * percent / 100) go to the held-out side. The order is never built: hash
prefixes are counted, the prefix holding the last held-out row is found on that
count table, and only rows with that prefix are ranked. What comes out is one
cutoff per stratum, and membership is a comparison against it, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tandem.config import SEED, TEST_PERCENT, VALIDATION_PERCENT
from tandem.functions.numeric import unit_hash
from tandem.session import pinned

PER_PREFIX = 65_536  # rows of a hash prefix, about; only one prefix of a stratum is ranked


def prefix_digits(rows: int) -> int:
    """Hex digits that cut ``rows`` rows into prefixes of about PER_PREFIX; no fewer than four."""
    return max(4, -(-max(rows // PER_PREFIX, 1).bit_length() // 4))


def _digest(key: str, tag: str) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{tag}")).cast("binary"))


def cutoffs(df: DataFrame, percent: int, tag: str, key: str = "id",
            stratum: str = "target", digits: int | None = None) -> DataFrame:
    """One row per stratum: hash and key of its last held-out row."""
    digits = digits or prefix_digits(df.count())
    hashed = df.select(stratum, key, _digest(key, tag).alias("digest")).withColumn(
        "prefix", F.substring("digest", 1, digits))
    counts = hashed.groupBy(stratum, "prefix").agg(F.count("*").alias("n"))
    within = Window.partitionBy(stratum)
    placed = counts.withColumns({
        "before": F.coalesce(F.sum("n").over(
            within.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "total": F.sum("n").over(within)})
    take = F.floor((F.col("total") * percent + 99) / 100).cast("long")
    boundary = (
        placed.withColumn("take", take)
        .where((F.col("before") < F.col("take")) & (F.col("take") <= F.col("before") + F.col("n")))
        .select(F.col(stratum).alias("stratum"), "prefix", (F.col("take") - F.col("before")).alias("rank"))
    )
    # One row per stratum; the null-safe join keeps unlabelled rows together.
    boundary = pinned(boundary)
    inside = hashed.join(
        boundary, hashed[stratum].eqNullSafe(F.col("stratum")) & (hashed["prefix"] == boundary["prefix"]))
    order = Window.partitionBy("stratum").orderBy("digest", key)
    return pinned(
        inside.withColumn("place", F.row_number().over(order))
        .where(F.col("place") == F.col("rank"))
        .select("stratum", F.col("digest").alias("cut_digest"), F.col(key).alias("cut_key"))
    )


def held_out(df: DataFrame, cuts: DataFrame, tag: str, name: str, key: str = "id",
             stratum: str = "target") -> DataFrame:
    """Add boolean ``name``: true for rows at or before their stratum's cutoff."""
    digest = _digest(key, tag)
    inside = (digest < F.col("cut_digest")) | (
        (digest == F.col("cut_digest")) & (F.col(key) <= F.col("cut_key")))
    joined = df.join(cuts, df[stratum].eqNullSafe(F.col("stratum")), "left")
    return joined.withColumn(name, F.coalesce(inside, F.lit(False))).drop(
        "stratum", "cut_digest", "cut_key")


def two_way(df: DataFrame, percent: int = TEST_PERCENT, seed: int = SEED, **kw) -> DataFrame:
    """Add ``split`` in {train, test}."""
    tag = f"{seed}:test"
    marked = held_out(df, cutoffs(df, percent, tag, **kw), tag, "is_test", **{
        k: v for k, v in kw.items() if k != "digits"})
    return marked.withColumn("split", F.when(F.col("is_test"), "test").otherwise("train")).drop("is_test")


def three_way(df: DataFrame, test_percent: int = TEST_PERCENT,
              validation_percent: int = VALIDATION_PERCENT, seed: int = SEED, **kw) -> DataFrame:
    """Add ``split`` in {train, val, test}; validation comes out of the remainder.

    The test rows do not depend on the validation share.
    """
    names = {k: v for k, v in kw.items() if k != "digits"}
    test_tag, val_tag = f"{seed}:test", f"{seed}:val"
    marked = held_out(df, cutoffs(df, test_percent, test_tag, **kw), test_tag, "is_test", **names)
    rest = marked.where(~F.col("is_test"))
    marked = held_out(marked, cutoffs(rest, validation_percent, val_tag, **kw), val_tag, "is_val", **names)
    split = F.when(F.col("is_test"), "test").when(F.col("is_val"), "val").otherwise("train")
    return marked.withColumn("split", split).drop("is_test", "is_val")


def hash_split(df: DataFrame, test_percent: int = TEST_PERCENT,
               validation_percent: int = VALIDATION_PERCENT, seed: int = SEED,
               key: str = "id") -> DataFrame:
    """Shares that hold on average only, decided per row; works on streams."""
    place = unit_hash(F.concat(F.col(key).cast("string"), F.lit(f":{seed}:bucket")))
    test = test_percent / 100
    val = test + (1 - test) * validation_percent / 100
    return df.withColumn(
        "split", F.when(place < test, "test").when(place < val, "val").otherwise("train"))


def overlap(splits: DataFrame, key: str = "id") -> DataFrame:
    """Ids that sit in more than one split, or more than once (none expected)."""
    per_id = splits.groupBy(key).agg(
        F.count("*").alias("n"), F.min("split").alias("first"), F.max("split").alias("last"))
    return per_id.agg(
        F.count("*").alias("ids"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if(F.col("first") != F.col("last")).alias("in_two_splits"),
        F.count_if(F.col("n") > 1).alias("repeated"))
