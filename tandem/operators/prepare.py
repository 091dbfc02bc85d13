"""Row filters, labels, derived columns and column roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tandem import config as cfg
from tandem.functions import numeric as num, text as txt


def label_outcomes(df: DataFrame) -> DataFrame:
    """Keep decided campaigns and add the 0/1 ``target``."""
    return df.where(F.col("state").isin(*cfg.LABELLED_STATES)).withColumn(
        "target", (F.col("state") == cfg.POSITIVE_STATE).cast("int"))


def add_basics(df: DataFrame) -> DataFrame:
    """Duration in days and the two raw-title counts; a null title becomes empty."""
    return df.withColumns({
        "name": F.coalesce("name", F.lit("")),
        "duration_days": num.days_between(F.col("launched"), F.col("deadline")),
        "name_len": txt.title_length(F.col("name")),
        "name_words": txt.title_words(F.col("name")),
    })


def quality_filter(df: DataFrame) -> DataFrame:
    return df.where((F.col("usd_goal_real") > 0) & (F.col("duration_days") > 0)
                    & ~txt.is_blank(F.col("name")))


def base_table(df: DataFrame) -> DataFrame:
    """Labelled, quality-filtered campaigns with the base columns only."""
    return quality_filter(add_basics(label_outcomes(df))).select(*cfg.BASE_COLUMNS)


def add_clean_title(df: DataFrame) -> DataFrame:
    clean = txt.clean_text(F.col("name"))
    return df.withColumn("name_clean", clean).withColumn(
        "name_clean_tokens", F.size(txt.split_clean(F.col("name_clean"))))


def drop_empty_titles(df: DataFrame) -> DataFrame:
    return df.where(F.col("name_clean") != "")


def add_engineered(df: DataFrame) -> DataFrame:
    """Log goal, launch-date levels, and number-or-zero title counts."""
    launched = (F.col("launched") if dict(df.dtypes)["launched"].startswith("timestamp")
                else num.parse_time(F.col("launched")))
    return df.withColumns({
        "log_goal": num.log_amount(F.col("usd_goal_real")),
        "launch_year": num.year_level(launched),
        "launch_month": num.month_level(launched),
        "launch_dow": num.weekday_level(launched),
        "name_len": num.to_number(F.col("name_len")),
        "name_words": num.to_number(F.col("name_words")),
    })


def modelling_table(df: DataFrame) -> DataFrame:
    """Raw campaigns to the table every model starts from."""
    return add_engineered(drop_empty_titles(add_clean_title(base_table(df))))


def kept_and_dropped(raw: DataFrame) -> DataFrame:
    """How many rows the label filter keeps, in one pass."""
    kept = F.count_if(F.col("state").isin(*cfg.LABELLED_STATES))
    total = F.count("*")
    return raw.agg(
        total.alias("rows"), kept.alias("kept"), (total - kept).alias("dropped"),
        (F.lit(100.0) * (total - kept) / total).alias("dropped_pct"))


def role_plan(df: DataFrame) -> DataFrame:
    """Role and decision per column, with how many values the data holds."""
    counted = df.agg(*[F.count(c).alias(c) for c in cfg.COLUMN_ROLES])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(role).alias("role"),
                 F.lit(decision).alias("decision"), F.col(c).alias("non_null"))
        for c, (role, decision) in cfg.COLUMN_ROLES.items()])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def check_features(columns) -> None:
    """Refuse a feature list that names an outcome column."""
    leaked = sorted(set(columns) & set(cfg.OUTCOME_COLUMNS))
    if leaked:
        raise ValueError(f"outcome columns cannot be features: {leaked}")


def feature_rows(df: DataFrame, numeric=cfg.NUMERIC, categorical=cfg.CATEGORICAL) -> DataFrame:
    """Project to id, target and allowed features."""
    check_features([*numeric, *categorical])
    return df.select("id", "target", "name_clean", *numeric, *categorical)
