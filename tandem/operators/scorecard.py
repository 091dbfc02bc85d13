"""A linear model as tables, scored without the ML model that made it.

Scoring a record touches that record only: terms are counted in the row, the
level dictionaries join broadcast, and nothing is grouped or shuffled. The same
code therefore scores batches and streams.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tandem import config as cfg
from tandem.functions.numeric import sigmoid
from tandem.functions.text import clean_tokens
from tandem.operators.fusion import FusedModel
from tandem.session import local_rows

PLACES = 6


@dataclass
class Scorecard:
    terms: list[tuple[str, float, float]]                 # term, idf, coef
    numeric: list[tuple[str, float, float, float]]        # column, mean, scale, coef
    levels: dict[str, list[tuple[str, float]]]            # column -> (level, coef)
    intercept: float
    thresholds: dict[str, float] = field(default_factory=lambda: {"default": 0.5})
    metrics: dict[str, float] = field(default_factory=dict)
    facts: dict[str, float] = field(default_factory=dict)   # row counts, feature count, majority accuracy
    form: dict[str, str] = field(default_factory=dict)      # first choices of a scoring form

    @property
    def width(self) -> int:
        return len(self.terms) + len(self.numeric) + sum(len(v) for v in self.levels.values())

    def term_table(self, spark: SparkSession) -> DataFrame:
        return local_rows(spark, {"idx": list(range(len(self.terms))),
                                  "term": [t for t, _, _ in self.terms],
                                  "idf": [i for _, i, _ in self.terms],
                                  "coef": [c for _, _, c in self.terms]},
                          "idx int, term string, idf double, coef double")

    def numeric_table(self, spark: SparkSession) -> DataFrame:
        name, mean, scale, coef = zip(*self.numeric)
        return local_rows(spark, {"column": list(name), "mean": list(mean), "scale": list(scale),
                                  "coef": list(coef)},
                          "column string, mean double, scale double, coef double")

    def level_table(self, spark: SparkSession, column: str | None = None) -> DataFrame:
        rows = [(c, lvl, w) for c, ls in self.levels.items() for lvl, w in ls
                if column is None or c == column]
        return local_rows(spark, {"column": [r[0] for r in rows], "level": [r[1] for r in rows],
                                  "coef": [r[2] for r in rows]},
                          "column string, level string, coef double")

    def table(self, spark: SparkSession) -> DataFrame:
        """Every coefficient as (kind, name, coef); what staleness checks compare."""
        rows = ([("text", t, c) for t, _, c in self.terms]
                + [("numeric", n, c) for n, _, _, c in self.numeric]
                + [("level", f"{col}={lvl}", c) for col, ls in self.levels.items() for lvl, c in ls])
        return local_rows(spark, {"kind": [r[0] for r in rows], "name": [r[1] for r in rows],
                                  "coef": [r[2] for r in rows]}, "kind string, name string, coef double")


def build(model: FusedModel, coefficients, intercept: float, thresholds=None, metrics=None,
          places: int = PLACES) -> Scorecard:
    """Scorecard from a fused model (text and tabular blocks) and its coefficients."""
    coefs = [round(float(c), places) for c in coefficients]
    if len(coefs) != model.width or model.block_widths()["interaction"]:
        raise ValueError(f"{len(coefs)} coefficients for {model.width} plain features")
    n_text, tabular = (model.text.width if model.text else 0), model.tabular
    terms = [(t, round(i, places), c) for t, i, c in
             zip(model.text.terms, model.text.idf, coefs)] if model.text else []
    numeric = [(c, *tabular.stats[c], coefs[n_text + j]) for j, c in enumerate(tabular.numeric)]
    at = n_text + len(numeric)
    levels = {}
    for c in tabular.categorical:
        levels[c] = list(zip(tabular.levels[c], coefs[at:at + len(tabular.levels[c])]))
        at += len(tabular.levels[c])
    return Scorecard(terms, numeric, levels, round(float(intercept), places),
                     dict(thresholds or {"default": 0.5}), dict(metrics or {}))


# --- scoring ----------------------------------------------------------------

def _with_terms(card: Scorecard, df: DataFrame) -> DataFrame:
    """Add ``_w`` (tf*idf) and ``_c`` (tf*idf*coef) over the card's vocabulary."""
    tokens = F.filter(clean_tokens(F.col("name")), lambda w: F.length(w) >= cfg.MIN_TOKEN_LENGTH)
    out = CountVectorizerModel.from_vocabulary(
        [t for t, _, _ in card.terms], inputCol="_tokens", outputCol="_tf",
    ).transform(df.withColumn("_tokens", tokens))
    for name, weights in (("_w", [i for _, i, _ in card.terms]),
                          ("_c", [i * c for _, i, c in card.terms])):
        out = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="_tf",
                                 outputCol=name).transform(out)
    return out


def _values(vector: str) -> Column:
    return F.unwrap_udt(vector)["values"]


def _total(values: Column, of=lambda x: x) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + of(x))


def _with_levels(card: Scorecard, df: DataFrame) -> DataFrame:
    """Add ``_lvl_<column>``: the level's coefficient, null where unknown.

    The dictionaries are the card's own rows, of known size.
    """
    for column in card.levels:
        lookup = card.level_table(df.sparkSession, column).select(
            F.col("level").alias("_level"), F.col("coef").alias(f"_lvl_{column}"))
        df = df.join(F.broadcast(lookup), F.col(column).cast("string") == F.col("_level"), "left").drop("_level")
    return df


def _numeric_parts(card: Scorecard) -> dict[str, Column]:
    return {c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) * F.lit(w)
            for c, m, s, w in card.numeric}


def _sum(columns) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + c
    return total


def score_records(card: Scorecard, df: DataFrame) -> DataFrame:
    """Add ``z`` (log-odds) and ``proba`` from the scorecard alone."""
    rows = _with_levels(card, df)
    z = F.lit(card.intercept)
    if card.terms:
        rows = _with_terms(card, rows)
        norm = F.sqrt(_total(_values("_w"), lambda x: x * x))
        z = z + F.when(norm > 0, _total(_values("_c")) / norm).otherwise(0.0)
    z = z + _sum(_numeric_parts(card).values())
    z = z + _sum(F.coalesce(F.col(f"_lvl_{c}"), F.lit(0.0)) for c in card.levels)
    return rows.withColumn("z", z).withColumn("proba", sigmoid(F.col("z"))).select(
        *df.columns, "z", "proba")


def contributions(card: Scorecard, df: DataFrame, top: int | None = None) -> DataFrame:
    """(id, feature, contribution), the ``top`` largest by size per record.

    Ranked inside the row, so records are never regrouped. Term indexes follow
    term order and sort after numerics and levels, as their names do.
    """
    rows = _with_levels(card, df)
    parts = [
        *[F.struct(F.lit(0).alias("block"),
                   F.concat(F.lit(f"cat__{c}_"), F.col(c).cast("string")).alias("name"),
                   F.lit(-1).alias("idx"), F.col(f"_lvl_{c}").alias("value")) for c in card.levels],
        *[F.struct(F.lit(1).alias("block"), F.lit(f"num__{c}").alias("name"),
                   F.lit(-1).alias("idx"), v.alias("value"))
          for c, v in _numeric_parts(card).items()],
    ]
    cells = F.array(*parts)
    if card.terms:
        rows = _with_terms(card, rows)
        norm = F.sqrt(_total(_values("_w"), lambda x: x * x))
        rows = rows.withColumn("_norm", norm)
        c = F.unwrap_udt("_c")
        cells = F.concat(cells, F.transform(
            F.arrays_zip(c["indices"].alias("i"), c["values"].alias("v")),
            lambda p: F.struct(F.lit(2).alias("block"), F.lit("").alias("name"),
                               p["i"].alias("idx"), (p["v"] / F.col("_norm")).alias("value"))))
    known = F.filter(cells, lambda p: p["value"].isNotNull())
    ranked = F.sort_array(F.transform(known, lambda p: F.struct(
        (-F.abs(p["value"])).alias("order"), p["block"].alias("block"), p["name"].alias("name"),
        p["idx"].alias("idx"), p["value"].alias("value"))))
    if top is not None:
        ranked = F.slice(ranked, 1, top)
    out = rows.select("id", F.posexplode(ranked).alias("pos", "p")).select("id", "pos", "p.*")
    names = F.broadcast(card.term_table(df.sparkSession).select("idx", "term"))
    feature = F.when(F.col("block") == 2, F.concat(F.lit("text__"), "term")).otherwise(F.col("name"))
    return out.join(names, "idx", "left").select(
        "id", (F.col("pos") + 1).alias("rank"), feature.alias("feature"),
        F.col("value").alias("contribution"))


def what_if(card: Scorecard, df: DataFrame, changes: dict[str, dict[str, object]]) -> DataFrame:
    """Score each record as it is and with fields replaced.

    The variants are listed inside the row and exploded: one output row per
    record and scenario.
    """
    fields = sorted({f for c in changes.values() for f in c})
    types = dict(df.dtypes)
    variants = F.array(*[
        F.struct(F.lit(name).alias("scenario"),
                 *[F.lit(change[f]).cast(types[f]).alias(f) if f in change else F.col(f)
                   for f in fields])
        for name, change in {"as is": {}, **changes}.items()])
    rest = [c for c in df.columns if c not in fields]
    exploded = df.select(*rest, F.explode(variants).alias("v")).select(*rest, "v.*")
    return score_records(card, exploded)


def parity(expected: DataFrame, actual: DataFrame, key: str = "id") -> DataFrame:
    """Largest probability difference over all records, and where it is."""
    both = expected.select(key, F.col("proba").alias("p1")).join(
        actual.select(key, F.col("proba").alias("p2")), key, "full_outer")
    diff = F.abs(F.col("p1") - F.col("p2"))
    return both.agg(
        F.count("*").alias("rows"), F.count_if(diff.isNull()).alias("unmatched"),
        F.max(diff).alias("max_abs_diff"), F.max_by(key, diff).alias("worst_id"))


def assert_parity(expected: DataFrame, actual: DataFrame, tol: float = 1e-6) -> float:
    row = parity(expected, actual).first()
    if row["unmatched"] or row["max_abs_diff"] > tol:
        raise AssertionError(f"scorecard differs from the model: {row.asDict()}")
    return row["max_abs_diff"]


def stale_rows(stored: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Rows present in only one of two scorecard tables; empty when current."""
    gone = stored.exceptAll(rebuilt).withColumn("side", F.lit("stored"))
    new = rebuilt.exceptAll(stored).withColumn("side", F.lit("rebuilt"))
    return gone.unionByName(new)


# --- one-document export ----------------------------------------------------

def payload(card: Scorecard, spark: SparkSession, extras: dict[str, object] | None = None) -> DataFrame:
    """The scorecard as a one-row nested table, ready for a JSON file.

    A document is one row by nature; its size is the model's width.
    """
    terms = card.term_table(spark).agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct("term", F.array("idf", "coef"))))).alias("vocab"))
    numeric = card.numeric_table(spark).agg(
        F.sort_array(F.collect_list(F.struct("column", "mean", "scale", "coef"))).alias("numeric"))
    by_column = card.level_table(spark).groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct("level", "coef"))).alias("levels"))
    columns = F.sort_array(F.collect_list(F.struct("column", "levels")))
    levels = by_column.agg(F.map_from_entries(F.transform(columns, lambda c: F.struct(
        c["column"], F.map_from_entries(c["levels"])))).alias("categorical"))

    def number_map(values: dict[str, float]) -> Column:
        if not values:
            return F.create_map().cast("map<string,double>")
        return F.create_map(*[F.lit(x) for k, v in values.items() for x in (k, float(v))])

    def one(df: DataFrame, name: str) -> Column:
        return df.select(name).scalar().alias(name)

    settings = F.struct(F.lit("l2").alias("norm"), F.lit(True).alias("smooth_idf"),
                        F.lit(False).alias("sublinear_tf"),
                        F.lit(cfg.MIN_TOKEN_LENGTH).alias("min_token_length"))
    return spark.range(1).select(
        F.lit(1).alias("schema"), F.lit(card.intercept).alias("intercept"),
        settings.alias("tfidf"), F.lit(sorted(cfg.STOP_WORDS)).alias("stopwords"),
        one(terms, "vocab"), one(numeric, "numeric"), one(levels, "categorical"),
        number_map(card.thresholds).alias("thresholds"), number_map(card.metrics).alias("metrics"),
        *[F.lit(v).alias(k) for k, v in (extras or {}).items()])


def from_payload(df: DataFrame) -> Scorecard:
    """A scorecard from a stored document (one row)."""
    r = df.first().asDict(recursive=True)

    def entries(value) -> dict:
        return {k: v for k, v in (value or {}).items() if v is not None}

    return Scorecard(
        [(t, *w) for t, w in sorted(entries(r["vocab"]).items())],
        [(n["column"], n["mean"], n["scale"], n["coef"]) for n in r["numeric"]],
        {c: sorted(entries(ls).items(), key=lambda x: x[0].encode())
         for c, ls in entries(r["categorical"]).items()},
        r["intercept"], entries(r["thresholds"]), entries(r["metrics"]), entries(r.get("facts")), entries(r.get("form")))


PAYLOAD_SCHEMA = (
    "schema int, intercept double, "
    "tfidf struct<norm:string,smooth_idf:boolean,sublinear_tf:boolean,min_token_length:int>, "
    "stopwords array<string>, vocab map<string,array<double>>, "
    "numeric array<struct<column:string,mean:double,scale:double,coef:double>>, "
    "categorical map<string,map<string,double>>, thresholds map<string,double>, metrics map<string,double>, "
    "model string, title_features map<string,string>, facts map<string,double>, form map<string,string>")
