"""Vocabulary, inverse document frequency and TF-IDF.

Fitting is one scan and one shuffle of (term, partial counts). Applying moves
nothing: terms are counted, weighted and normalised inside each row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tandem import config as cfg
from tandem.functions.text import bind, model_tokens, ngrams
from tandem.session import pinned


def term_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """(term, tf, doc_freq): occurrences and documents per term, in one pass.

    Each row offers its tokens and, behind them, its distinct tokens; the place tells them apart. Both are summed
    map-side, so a term found in every row costs one record per task.
    """
    offers = bind(tokens, lambda words: F.struct(
        F.size(words).alias("n"), F.concat(words, F.array_distinct(words)).alias("terms")))
    return (
        df.select(offers.alias("o")).select("o.n", F.posexplode("o.terms").alias("place", "term"))
        .groupBy("term").agg(F.count_if(F.col("place") < F.col("n")).alias("tf"),
                             F.count_if(F.col("place") >= F.col("n")).alias("doc_freq"))
    )


def pick_terms(counts: DataFrame, max_terms: int, min_doc_freq: int) -> DataFrame:
    """The most frequent terms; ties at the boundary go to the smaller term."""
    return (counts.where(F.col("doc_freq") >= min_doc_freq)
            .orderBy(F.desc("tf"), F.asc("term")).limit(max_terms))


def smooth_idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.ln((F.lit(1.0) + n_docs) / (F.lit(1.0) + doc_freq)) + F.lit(1.0)


@dataclass
class TextBlock:
    """A fitted vocabulary. Everything kept here is bounded by ``max_terms``."""

    terms: list[str]
    tf: list[int]
    doc_freq: list[int]
    idf: list[float]
    n_docs: int
    table: DataFrame  # (idx, term, tf, doc_freq, idf)

    @property
    def width(self) -> int:
        return len(self.terms)

    @property
    def feature_names(self) -> list[str]:
        return [f"text__{t}" for t in self.terms]

    def stages(self, tokens: str = "tokens", out: str = "text_vec") -> list[Transformer]:
        """Count, weight by idf, normalise to unit length: three row-wise stages."""
        return [
            CountVectorizerModel.from_vocabulary(self.terms, inputCol=tokens, outputCol="_tf"),
            ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_tfidf"),
            Normalizer(p=2.0, inputCol="_tfidf", outputCol=out),
        ]

    def transform(self, df: DataFrame, tokens: str = "tokens", out: str = "text_vec") -> DataFrame:
        if not self.terms:
            raise ValueError("the vocabulary is empty: no term reaches the document floor")
        for s in self.stages(tokens, out):
            df = s.transform(df)
        return df.drop("_tf", "_tfidf")

    def long(self, df: DataFrame, tokens: str = "tokens", keep: tuple[str, ...] = ("id",)) -> DataFrame:
        """(keep..., term, weight) for every non-zero cell."""
        cells = explode_vector(self.transform(df, tokens), "text_vec", keep)
        names = F.broadcast(self.table.select("idx", "term"))
        return cells.join(names, "idx").select(*keep, "term", "weight")


def vector_array(vector: str) -> Column:
    """A vector's (idx, weight) cells, whether it is stored sparse or dense."""
    v = F.unwrap_udt(vector)
    sparse = F.arrays_zip(v["indices"].alias("idx"), v["values"].alias("weight"))
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("idx"), x.alias("weight")))
    return F.when(v["type"] == 0, sparse).otherwise(dense)


def explode_vector(df: DataFrame, vector: str, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """(keep..., idx, weight) of a sparse vector column's non-zeros."""
    return (df.select(*keep, F.explode(vector_array(vector)).alias("c")).select(*keep, "c.idx", "c.weight")
            .where(F.col("weight") != 0))


def tokens_of(df: DataFrame, clean: str = "name_clean", low: int = 1, high: int = 1,
              out: str = "tokens") -> DataFrame:
    return df.withColumn(out, ngrams(model_tokens(F.col(clean)), low, high))


def fit_text(train: DataFrame, tokens: str = "tokens", max_terms: int = cfg.MAX_TERMS,
             min_doc_freq: int = cfg.MIN_DOC_FREQ, n_docs: int | None = None) -> TextBlock:
    """Vocabulary of ``train``; pass ``n_docs`` where its row count is already known."""
    n_docs = train.count() if n_docs is None else n_docs
    picked = pick_terms(term_counts(train, F.col(tokens)), max_terms, min_doc_freq)
    return block_from_counts(train.sparkSession, picked, n_docs, max_terms)


def block_from_counts(spark: SparkSession, picked: DataFrame, n_docs: int,
                      max_terms: int = cfg.MAX_TERMS) -> TextBlock:
    # At most max_terms rows: the window and the collect below are bounded by it.
    order = Window.partitionBy(F.lit(0)).orderBy("term")
    table = pinned(picked.withColumns({
        "idx": F.row_number().over(order) - 1,
        "idf": smooth_idf(F.lit(float(n_docs)), F.col("doc_freq"))}))
    rows = table.orderBy("idx").collect()
    return TextBlock([r["term"] for r in rows], [r["tf"] for r in rows],
                     [r["doc_freq"] for r in rows], [r["idf"] for r in rows], n_docs, table)


def mean_weights(df: DataFrame, block: TextBlock, tokens: str = "tokens") -> DataFrame:
    """(term, mean_tfidf): column means over all rows, zeros included. Vectors are added up where they are; no cell is sent."""
    means = block.transform(df, tokens).agg(Summarizer.mean(F.col("text_vec")).alias("means"))
    cells = means.select(F.posexplode(vector_to_array("means")).alias("idx", "mean_tfidf")).where("mean_tfidf <> 0")
    return cells.join(block.table.select("idx", "term"), "idx").select("term", "mean_tfidf")
