"""One sparse vector per record from the text, tabular and interaction blocks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import Interaction, OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from tandem import config as cfg
from tandem.operators import tabular as tab
from tandem.operators.textblock import TextBlock, explode_vector, fit_text, tokens_of
from tandem.session import local_rows

TOKENS_SQL = (f"filter(split(coalesce(name_clean, ''), ' '), "
              f"w -> length(w) >= {cfg.MIN_TOKEN_LENGTH}) AS tokens")


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns and blocks a run uses."""

    numeric: tuple[str, ...] = cfg.NUMERIC
    categorical: tuple[str, ...] = cfg.CATEGORICAL
    with_text: bool = True
    slopes: tuple[tuple[str, str], ...] = ()        # (numeric, categorical) pairs
    bins: tuple[tuple[str, int], ...] = ()          # (numeric, bins)
    cells: tuple[tuple[str, int, str], ...] = ()    # (numeric, bins, categorical)
    max_terms: int = cfg.MAX_TERMS
    min_doc_freq: int = cfg.MIN_DOC_FREQ


def slope_names(base: str, column: str, levels: list[str]) -> list[str]:
    return [f"inter__{base}_x_{column}_{lvl}" for lvl in levels]


def bin_labels(n: int, edges: list[float]) -> list[str]:
    return [f"bin {i} of {n}" for i in range(max(1, len(edges) - 1))]


def bin_names(column: str, labels: list[str]) -> list[str]:
    return [f"inter__{column}_{b}" for b in labels]


def cell_names(column: str, labels: list[str], with_column: str, levels: list[str]) -> list[str]:
    return [f"inter__{with_column}_{lvl}_x_{column}_{b}" for lvl in levels for b in labels]


def wider(*specs: FeatureSpec) -> FeatureSpec:
    """One spec with every column and interaction of the given ones."""
    merged = lambda name: tuple(dict.fromkeys(x for s in specs for x in getattr(s, name)))
    return FeatureSpec(
        merged("numeric"), merged("categorical"), any(s.with_text for s in specs), merged("slopes"), merged("bins"), merged("cells"),
        max(s.max_terms for s in specs), min(s.min_doc_freq for s in specs))


@dataclass
class FusedModel:
    """A fitted feature pipeline and the dictionary of its columns."""

    spec: FeatureSpec
    pipeline: PipelineModel
    text: TextBlock | None
    tabular: tab.TabularBlock
    names: list[str]
    blocks: list[str]
    sources: list[str]
    n_rows: int
    edges: dict[tuple[str, int], list[float]] = field(default_factory=dict)

    @property
    def width(self) -> int:
        return len(self.names)

    def block_widths(self) -> dict[str, int]:
        return {b: self.blocks.count(b) for b in ("text", "tabular", "interaction")}

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(df)

    def columns_of(self, spec: FeatureSpec) -> list[bool]:
        """Which of this model's columns a narrower ``spec`` has."""
        levels = self.tabular.levels
        crossed = {name for base, column in spec.slopes for name in slope_names(base, column, levels[column])}
        crossed |= {name for c, n in spec.bins for name in bin_names(c, bin_labels(n, self.edges[c, n]))}
        crossed |= {name for c, n, w in spec.cells for name in cell_names(c, bin_labels(n, self.edges[c, n]), w, levels[w])}
        own = {*spec.numeric, *spec.categorical}
        return [spec.with_text if block == "text" else source in own if block == "tabular" else name in crossed
                for name, block, source in zip(self.names, self.blocks, self.sources)]

    def feature_dict(self, spark: SparkSession) -> DataFrame:
        """(idx, feature, block, source_column); as many rows as the vector is wide."""
        return local_rows(
            spark, {"idx": list(range(self.width)), "feature": self.names,
                    "block": self.blocks, "source_column": self.sources},
            "idx int, feature string, block string, source_column string")


def fit_features(train: DataFrame, spec: FeatureSpec = FeatureSpec(),
                 text: TextBlock | None = None, tabular: tab.TabularBlock | None = None) -> FusedModel:
    """Fit every transformer on ``train`` only and chain them into one pipeline.

    Already fitted blocks may be passed in, so runs that share a block fit it once.
    """
    if (tabular is None or tabular.numeric != list(spec.numeric)
            or tabular.categorical != list(spec.categorical)):
        tabular = tab.fit_tabular(train, spec.numeric, spec.categorical)
    if spec.with_text and text is None:
        text = fit_text(tokens_of(train), max_terms=spec.max_terms, min_doc_freq=spec.min_doc_freq,
                        n_docs=tabular.n_rows)

    stages: list[Transformer] = [tabular.scale_stage(TOKENS_SQL if spec.with_text else "")]
    parts, names, blocks, sources = [], [], [], []

    if spec.with_text:
        stages += text.stages()
        parts.append("text_vec")
        names += text.feature_names
        blocks += ["text"] * text.width
        sources += ["name"] * text.width

    stages.append(tabular.numeric_stage())
    parts.append("num_vec")
    # Level sizes are in the code columns' metadata: this fit reads no rows.
    probe = train.limit(0)
    if tabular.categorical:
        index = tabular.index_stages()
        hot = tabular.onehot_stage().fit(tab.apply_stages(probe, index))
        stages += [*index, hot]
        parts += [f"hot__{c}" for c in tabular.categorical]
    names += tabular.feature_names
    blocks += ["tabular"] * tabular.width
    sources += tabular.source_columns

    edges = tab.bin_edges(train, [*spec.bins, *[(c, n) for c, n, _ in spec.cells]])
    binned: set[tuple[str, int]] = set()

    def bin_columns(column: str, n: int) -> list[str]:
        if (column, n) not in binned:
            binned.add((column, n))
            cut = tab.bin_stage(column, edges[column, n], f"bin__{column}_{n}")
            hot = OneHotEncoder(inputCols=[f"bin__{column}_{n}"], outputCols=[f"hotbin__{column}_{n}"],
                                dropLast=False)
            stages.extend([cut, hot.fit(cut.transform(probe))])
        return bin_labels(n, edges[column, n])

    for base, column in spec.slopes:
        out = f"slope__{base}_{column}"
        stages.append(Interaction(inputCols=[base, f"hot__{column}"], outputCol=out))
        parts.append(out)
        names += slope_names(base, column, tabular.levels[column])
        blocks += ["interaction"] * len(tabular.levels[column])
        sources += [base] * len(tabular.levels[column])
    for column, n in spec.bins:
        labels = bin_columns(column, n)
        parts.append(f"hotbin__{column}_{n}")
        names += bin_names(column, labels)
        blocks += ["interaction"] * len(labels)
        sources += [column] * len(labels)
    for column, n, level_column in spec.cells:
        labels = bin_columns(column, n)
        out = f"cell__{column}_{level_column}"
        stages.append(Interaction(inputCols=[f"hot__{level_column}", f"hotbin__{column}_{n}"], outputCol=out))
        parts.append(out)
        cells = cell_names(column, labels, level_column, tabular.levels[level_column])
        names += cells
        blocks += ["interaction"] * len(cells)
        sources += [column] * len(cells)

    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return FusedModel(spec, PipelineModel(stages), text, tabular, names, blocks, sources,
                      tabular.n_rows, edges)


def tidy(df: DataFrame, keep=()) -> DataFrame:
    """Only what later jobs read; drops the pipeline's working columns."""
    return df.select("id", "split", F.col("target").cast("int").alias("target"), *keep, "features")


# --- blocks stored apart ----------------------------------------------------

def fuse_blocks(*blocks: tuple[DataFrame, str]) -> DataFrame:
    """Join separately stored vector blocks on id and assemble them.

    Rows are matched by id, never by position. Blocks bucketed by id on disk join
    without a shuffle.
    """
    first, column = blocks[0]
    joined, columns = first.select("id", column), [column]
    for other, column in blocks[1:]:
        joined = joined.join(other.select("id", column), "id")
        columns.append(column)
    return VectorAssembler(inputCols=columns, outputCol="features").transform(joined).select("id", "features")


def alignment(left: DataFrame, right: DataFrame, key: str = "id", label: str = "target") -> DataFrame:
    """Compare two id/label tables: rows on one side only, and differing labels."""
    l = left.select(F.col(key), F.col(label).alias("l"), F.lit(True).alias("in_left"))
    r = right.select(F.col(key), F.col(label).alias("r"), F.lit(True).alias("in_right"))
    both = l.join(r, key, "full_outer")
    return both.agg(
        F.count_if(F.col("in_left") & F.col("in_right")).alias("matched"),
        F.count_if(F.col("in_right").isNull()).alias("left_only"),
        F.count_if(F.col("in_left").isNull()).alias("right_only"),
        F.count_if(F.col("in_left") & F.col("in_right") & ~F.col("l").eqNullSafe(F.col("r")))
        .alias("label_mismatch"))


def block_stats(df: DataFrame, vector: str, width: int, value_bytes: int = 4,
                index_bytes: int = 4) -> DataFrame:
    """Rows, non-zeros, density, and the bytes of sparse and dense storage."""
    v = F.unwrap_udt(vector)
    nonzero = F.size(F.filter(v["values"], lambda x: x != 0)).cast("long")
    counted = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(nonzero), F.lit(0)).alias("nnz"))
    rows, nnz = F.col("rows"), F.col("nnz")
    return counted.select(
        rows, F.lit(width).cast("long").alias("cols"), nnz,
        (nnz / (rows * F.lit(float(width)))).alias("density"),
        (nnz * (value_bytes + index_bytes) + (rows + 1) * index_bytes).alias("sparse_bytes"),
        (rows * F.lit(width).cast("long") * 4).alias("dense_bytes"))


def lineage_violations(features: DataFrame, text_terms: DataFrame, allowed) -> DataFrame:
    """Features that trace neither to an allowed column nor to a vocabulary term."""
    is_text = F.col("block") == "text"
    tabular = features.where(~is_text & ~F.col("source_column").isin(*allowed))
    named = text_terms.select(F.concat(F.lit("text__"), "term").alias("feature"))
    text = features.where(is_text).join(named, "feature", "left_anti")
    return tabular.unionByName(text)


def vector_cells(df: DataFrame, features: DataFrame, vector: str = "features",
                 keep=("id",)) -> DataFrame:
    """(keep..., feature, value) of a fused vector's non-zeros."""
    cells = explode_vector(df, vector, keep)
    return cells.join(F.broadcast(features.select("idx", "feature")), "idx").select(
        *keep, "feature", F.col("weight").alias("value"))
