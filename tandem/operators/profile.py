"""Profiles, rates, histograms and quality counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tandem.functions import text as txt
from tandem.operators.ordering import exact_quantiles, sketches


def to_rows(one_row: DataFrame, names, key: str, value: str) -> DataFrame:
    """Turn a one-row aggregate into (key, value) rows."""
    return one_row.unpivot([], list(names), key, value)


def column_profile(df: DataFrame, columns=None, long_text=()) -> DataFrame:
    """dtype, nulls, null share and distinct values (null included) per column.

    One shuffle for all columns: values are counted map-side as (column, value)
    pairs. Columns named in ``long_text`` travel as a digest, not as full text.
    """
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    keys = {c: F.sha2(F.col(c), 256) if c in long_text else F.col(c).cast("string")
            for c in columns}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), k.alias("value")) for c, k in keys.items()
    ])).alias("p")).select("p.*")
    distinct = pairs.groupBy("column", "value").agg(F.count("*").alias("n"))
    nulls = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    out = distinct.groupBy("column").agg(
        nulls.alias("nulls"), (F.lit(100.0) * nulls / F.sum("n")).alias("null_pct"),
        F.count("*").alias("distinct_values"))
    dtype = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return out.withColumn("dtype", dtype[F.col("column")])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value, null being a value of its own."""
    counts = df.groupBy(column).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", F.lit(100.0) * F.col("count") / total)


def rate_by(df: DataFrame, column: str, label: str = "target") -> DataFrame:
    return df.groupBy(column).agg(
        F.count("*").alias("count"), F.avg(label).alias("success_rate"))


def rate_by_top(df: DataFrame, column: str, n: int, label: str = "target") -> DataFrame:
    """Rates of the ``n`` most frequent values; ties go to the smaller name."""
    return (rate_by(df, column, label).where(F.col(column).isNotNull())
            .orderBy(F.desc("count"), F.asc(column)).limit(n))


def rate_extremes(rates: DataFrame, level: str) -> DataFrame:
    """Best and worst level and the spread in points; ties go to the smaller name."""
    r = F.col("success_rate")
    return rates.agg(
        F.min_by(level, F.struct(-r, F.col(level))).alias("best_level"),
        F.max(r).alias("best_rate"),
        F.min_by(level, F.struct(r, F.col(level))).alias("worst_level"),
        F.min(r).alias("worst_rate"),
        (F.lit(100.0) * (F.max(r) - F.min(r))).alias("spread_points"))


def label_correlations(df: DataFrame, columns, label: str = "target") -> DataFrame:
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c)
                   for c in columns])
    return to_rows(row, columns, "column", "correlation")


def describe(df: DataFrame, columns) -> DataFrame:
    """count, mean, std (n-1), min, exact quartiles and max per column.

    Moments and rank sketches of all columns are one aggregate; a second scan settles the quartiles.
    """
    columns, quartiles = list(columns), {0.25: "q25", 0.5: "q50", 0.75: "q75"}

    def moments(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(c)

    row = df.agg(*[moments(c) for c in columns], *sketches(columns, quartiles)).first()
    values = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, columns, quartiles, row).collect()}
    rows = [(c, *row[c], *[values.get((c, p)) for p in quartiles]) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, max double, " + ", ".join(f"{q} double" for q in quartiles.values()))


def skewness(column: Column) -> Column:
    """Bias-corrected skewness; the built-in gives the population form."""
    n = F.count(column).cast("double")
    return F.when(n > 2, F.skewness(column) * F.sqrt(n * (n - 1)) / (n - 2))


def quality_report(df: DataFrame) -> DataFrame:
    """Row, duplicate, blank and out-of-range counts.

    The counts need no shuffle; only the id column is shuffled, for duplicates.
    """
    d = F.col("duration_days")
    counts = df.agg(
        F.count("*").alias("rows"),
        F.count_if(txt.is_blank(F.col("name"))).alias("empty_names"),
        F.count_if(F.col("usd_goal_real") <= 0).alias("nonpositive_goals"),
        F.count_if(d.isNull() | (d <= 0)).alias("invalid_duration"),
        F.count_if(F.col("category").isNull()).alias("null_category"),
        F.count_if(F.col("country").isNull()).alias("null_country"))
    repeats = df.groupBy("id").agg((F.count("*") - 1).alias("extra")).agg(
        F.coalesce(F.sum("extra"), F.lit(0)))
    return counts.withColumn("duplicate_ids", repeats.scalar())


def histogram(df: DataFrame, column: Column, bins: int) -> DataFrame:
    """Equal-width bins over the data range; the maximum falls in the last bin.

    A constant column is binned over one unit around its value.
    """
    x = F.col("x")
    values = df.select(column.cast("double").alias("x")).where(x.isNotNull())
    low, high = values.agg(F.min("x"), F.max("x")).first()
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    slot = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return values.groupBy(slot.alias("bin")).agg(F.count("*").alias("count")).withColumn(
        "bin_start", F.lit(low) + F.col("bin") * F.lit(width))


def level_counts(df: DataFrame, columns) -> DataFrame:
    """Distinct non-null levels per column, one shuffle."""
    return level_table(df, columns).groupBy("column").agg(F.count("*").alias("levels"))


def level_table(df: DataFrame, columns) -> DataFrame:
    """(column, level, n) for every non-null level of every column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level"))
                      for c in columns])
    return (df.select(F.explode(cells).alias("c")).select("c.*")
            .where(F.col("level").isNotNull())
            .groupBy("column", "level").agg(F.count("*").alias("n")))


def level_pairs(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Distinct (parent, child) pairs."""
    return df.select(F.col(parent).alias("parent"), F.col(child).alias("child")).distinct()


def level_tree(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Children of each parent in name order, one row per parent; ``level_pairs`` has them as rows."""
    return level_pairs(df, parent, child).groupBy("parent").agg(F.sort_array(F.collect_list("child")).alias("children"))


def modal_child(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Most frequent child per parent; ties go to the smaller name. No window."""
    counts = df.groupBy(F.col(parent).alias("parent"), F.col(child).alias("child")).agg(
        F.count("*").alias("n"))
    return counts.groupBy("parent").agg(
        F.min_by("child", F.struct(-F.col("n"), F.col("child"))).alias("child"),
        F.max("n").alias("n"))


def sample_rows(df: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """A repeatable uniform sample of ``n`` rows, by hashed key."""
    tag = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return df.orderBy(tag, key).limit(n)


def prevalence(df: DataFrame, label: str = "target") -> DataFrame:
    p = F.avg(F.col(label).cast("double"))
    return df.agg(p.alias("positive_rate"), F.greatest(p, F.lit(1.0) - p).alias("majority_accuracy"))
