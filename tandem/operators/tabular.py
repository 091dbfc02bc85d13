"""Scaling, level dictionaries, interactions and quantile bins.

Each fit is one aggregate over the training rows; each application is a column
expression, a row-wise ML stage or a dictionary join.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import (
    Bucketizer, OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler,
)
from pyspark.sql import Column, DataFrame, Window, functions as F

from tandem import config as cfg
from tandem.operators.ordering import exact_quantiles, numbered
from tandem.operators.prepare import check_features
from tandem.operators.profile import level_table
from tandem.session import pinned


@dataclass
class TabularBlock:
    numeric: list[str]
    categorical: list[str]
    stats: dict[str, tuple[float, float]]  # column -> (mean, scale)
    levels: dict[str, list[str]]           # column -> sorted train levels
    n_rows: int

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(len(v) for v in self.levels.values())

    @property
    def feature_names(self) -> list[str]:
        return [f"num__{c}" for c in self.numeric] + [
            f"cat__{c}_{lvl}" for c in self.categorical for lvl in self.levels[c]]

    @property
    def source_columns(self) -> list[str]:
        return self.numeric + [c for c in self.categorical for _ in self.levels[c]]

    def scaled(self, column: str) -> Column:
        mean, scale = self.stats[column]
        return (F.col(column).cast("double") - F.lit(mean)) / F.lit(scale)

    def scale_stage(self, extra: str = "") -> SQLTransformer:
        """Standardised numerics as SQL, so that a saved pipeline carries them."""
        cols = [f"(CAST(`{c}` AS DOUBLE) - {m!r}D) / {s!r}D AS `num__{c}`"
                for c, (m, s) in self.stats.items()]
        return SQLTransformer(statement=f"SELECT *, {', '.join(filter(None, [*cols, extra]))} FROM __THIS__")

    def index_stages(self) -> list[StringIndexerModel]:
        """Codes in level order; unseen and null levels share the code past the last."""
        return [StringIndexerModel.from_labels(self.levels[c], inputCol=c, outputCol=f"code__{c}",
                                               handleInvalid="keep") for c in self.categorical]

    def onehot_stage(self) -> OneHotEncoder:
        """One column per train level; the shared last code becomes all zeros."""
        return OneHotEncoder(inputCols=[f"code__{c}" for c in self.categorical],
                             outputCols=[f"hot__{c}" for c in self.categorical])

    def numeric_stage(self) -> VectorAssembler:
        return VectorAssembler(inputCols=[f"num__{c}" for c in self.numeric], outputCol="num_vec")


def fit_scaler(train: DataFrame, numeric) -> tuple[dict[str, tuple[float, float]], int]:
    """Mean and population deviation per column; a constant column scales by 1."""
    numeric = list(numeric)
    row = train.agg(F.count("*").alias("_n"),
                    *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in numeric],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in numeric]).first()

    def scale(c: str) -> float:
        mean, std = row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0
        return std if std > 10 * sys.float_info.epsilon * abs(mean) else 1.0

    return {c: (row[f"m_{c}"] or 0.0, scale(c)) for c in numeric}, row["_n"]


def level_dictionary(train: DataFrame, categorical) -> DataFrame:
    """(column, level, code): sorted levels of each column, numbered from 0; written once, joined by its users."""
    levels = pinned(level_table(train, categorical).select("column", "level"))
    return pinned(numbered(levels, "column", "level", "code"))


def fit_levels(train: DataFrame, categorical) -> dict[str, list[str]]:
    """Sorted levels per column for the vector form.

    A model's names and coefficients are on the driver, one per level, whatever their number; the long form
    (``level_dictionary``) keeps them in tables.
    """
    rows = level_table(train, categorical).select("column", "level").collect()
    return {c: sorted((r["level"] for r in rows if r["column"] == c),
                      key=lambda s: s.encode("utf-8")) for c in categorical}


def fit_tabular(train: DataFrame, numeric=cfg.NUMERIC, categorical=cfg.CATEGORICAL) -> TabularBlock:
    check_features([*numeric, *categorical])
    stats, n = fit_scaler(train, numeric)
    levels = fit_levels(train, categorical) if categorical else {}
    return TabularBlock(list(numeric), list(categorical), stats, levels, n)


def long_scaled(df: DataFrame, block: TabularBlock, keep=("id",)) -> DataFrame:
    """(keep..., feature, value) of the standardised numerics."""
    cells = F.array(*[F.struct(F.lit(f"num__{c}").alias("feature"), block.scaled(c).alias("value"))
                      for c in block.numeric])
    return df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.*")


def level_cells(df: DataFrame, categorical, keep=("id",)) -> DataFrame:
    """(keep..., column, level): one row per categorical cell."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level"))
                      for c in categorical])
    return df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.*")


def long_onehot(df: DataFrame, dictionary: DataFrame, categorical, keep=("id",)) -> DataFrame:
    """(keep..., feature, value=1) for known levels; unknown ones give no row."""
    return level_cells(df, categorical, keep).join(
        dictionary, ["column", "level"]).select(
        *keep, F.concat(F.lit("cat__"), "column", F.lit("_"), "level").alias("feature"),
        F.lit(1.0).alias("value"))


def ordinal_codes(df: DataFrame, dictionary: DataFrame, categorical, keep=("id",)) -> DataFrame:
    """(keep..., column, code), unseen levels and nulls being -1."""
    return level_cells(df, categorical, keep).join(
        dictionary, ["column", "level"], "left").select(
        *keep, "column", F.coalesce("code", F.lit(-1)).alias("code"))


def long_interaction(df: DataFrame, base: str, with_column: str, dictionary: DataFrame,
                     keep=("id",)) -> DataFrame:
    """``base`` under the row's own level; zero cells and unknown levels give no row."""
    levels = dictionary.where(F.col("column") == with_column).select("level")
    value = F.col(base).cast("double")
    name = F.concat(F.lit(f"inter__{base}_x_{with_column}_"), F.col("level"))
    return (df.where(value != 0)
            .join(levels, F.col(with_column).cast("string") == F.col("level"))
            .select(*keep, name.alias("feature"), value.alias("value")))


# --- quantile bins ----------------------------------------------------------

def quantile_edges(train: DataFrame, column: str, bins: int) -> list[float]:
    """Exact quantile edges; edges closer than 1e-8 are merged."""
    return bin_edges(train, [(column, bins)])[column, bins]


def bin_edges(train: DataFrame, wanted) -> dict[tuple[str, int], list[float]]:
    """Edges of several (column, bins) from the same two scans."""
    wanted = list(dict.fromkeys(wanted))
    if not wanted:
        return {}
    probs = sorted({i / n for _, n in wanted for i in range(n + 1)})
    columns = list(dict.fromkeys(c for c, _ in wanted))
    found = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(train, columns, probs).collect()}
    out = {}
    for c, n in wanted:
        raw = [found[c, i / n] for i in range(n + 1) if (c, i / n) in found]
        edges = raw[:1]
        for e in raw[1:]:
            if e - edges[-1] > 1e-8:
                edges.append(e)
        out[c, n] = edges
    return out


def bin_stage(column: str, edges: list[float], out: str) -> Bucketizer:
    """[a, b) bins; values outside the fitted range go to the outer bins. Edges that all merged leave one bin."""
    return Bucketizer(splits=[float("-inf"), *edges[1:-1], float("inf")],
                      inputCol=column, outputCol=out)


def bin_index(df: DataFrame, column: str, edges: list[float], out: str = "bin") -> DataFrame:
    if len(edges) <= 2:
        return df.withColumn(out, F.when(F.col(column).isNotNull(), 0).cast("int"))
    binned = bin_stage("_x", edges, "_bin").transform(df.withColumn("_x", F.col(column).cast("double")))
    return binned.withColumn(out, F.col("_bin").cast("int")).drop("_x", "_bin")


def bin_cells(df: DataFrame, column: str, edges: list[float], with_column: str,
              dictionary: DataFrame, keep=("id",)) -> DataFrame:
    """Cell number ``code * n_bins + bin`` as long; unknown levels give no row."""
    codes = dictionary.where(F.col("column") == with_column).select("level", "code")
    n_bins = max(1, len(edges) - 1)
    return (bin_index(df, column, edges)
            .join(codes, F.col(with_column).cast("string") == F.col("level"))
            .select(*keep, (F.col("code").cast("long") * n_bins + F.col("bin")).alias("cell")))


def apply_stages(df: DataFrame, stages: list[Transformer]) -> DataFrame:
    for s in stages:
        df = s.transform(df)
    return df
