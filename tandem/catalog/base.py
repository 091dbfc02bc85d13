"""Registry of queries, the SQL they are checked against, and shared fits.

The SQL side is written from scratch as named common table expressions; a query
names the ones it needs and their requirements come along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tandem import config as cfg
from tandem.functions.text import WHITESPACE, clean_tokens
from tandem.operators import prepare, scorecard as sc, split
from tandem.operators.fusion import FeatureSpec, FusedModel, fit_features
from tandem.operators.textblock import TextBlock, fit_text, tokens_of
from tandem.plans import training
from tandem.session import local_rows, stage
from tandem.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def rnd(c, places: int = 6) -> Column:
    """Round for comparison; adding 0 turns a negative zero into zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, places) + F.lit(0.0)


# --- SQL fragments ----------------------------------------------------------

_STOP = ", ".join(f"'{w}'" for w in cfg.STOP_WORDS)


def r(expr: str, places: int = 6) -> str:
    return f"(round({expr}, {places}) + 0.0::DOUBLE)"


def unit(expr: str) -> str:
    return f"(cast(('0x' || substr(md5({expr}), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0::DOUBLE)"


def hash_coef(expr: str) -> str:
    return f"round(2.0::DOUBLE * {unit(expr)} - 1.0::DOUBLE, 6)"


def clean_list(col: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower(coalesce({col}, '')), '[^a-z]+'), "
            f"lambda w: w <> '' AND w NOT IN ({_STOP}))")


def cleaned(col: str) -> str:
    return f"array_to_string({clean_list(col)}, ' ')"


def term_list(clean: str) -> str:
    return f"list_filter(string_split({clean}, ' '), lambda w: length(w) >= {cfg.MIN_TOKEN_LENGTH})"


def tfidf_ctes(prefix: str, source: str, fit_where: str = "TRUE", limit: int = cfg.MAX_TERMS) -> dict:
    """Token counts, vocabulary (fitted where ``fit_where``) and weights of ``source``."""
    p = prefix
    return {
        f"{p}tok": ((source,), f"SELECT id, unnest({term_list('name_clean')}) AS term FROM {source}"),
        f"{p}cnt": ((f"{p}tok",), f"SELECT id, term, count(*) AS tf FROM {p}tok GROUP BY id, term"),
        f"{p}terms": ((f"{p}cnt", source), f"""
            SELECT term, sum(tf)::BIGINT AS tf, count(*) AS doc_freq
            FROM {p}cnt JOIN (SELECT id FROM {source} WHERE {fit_where}) USING (id) GROUP BY term"""),
        f"{p}vocab": ((f"{p}terms", source), f"""
            SELECT term, tf, doc_freq, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS idx,
                   ln((1.0::DOUBLE + (SELECT count(*) FROM {source} WHERE {fit_where}))
                      / (1.0::DOUBLE + doc_freq)) + 1.0::DOUBLE AS idf
            FROM (SELECT * FROM {p}terms WHERE doc_freq >= {cfg.MIN_DOC_FREQ}
                  ORDER BY tf DESC, term LIMIT {limit})"""),
        f"{p}w": ((f"{p}cnt", f"{p}vocab"), f"""
            SELECT id, term, idx, c.tf, c.tf * idf / sqrt(sum(c.tf * idf * c.tf * idf) OVER (PARTITION BY id)) AS weight
            FROM {p}cnt c JOIN {p}vocab v USING (term)"""),
    }


def split_sql(source: str) -> str:
    def place(tag: str, rows: str) -> str:
        return (f"SELECT id, target, row_number() OVER (PARTITION BY target ORDER BY "
                f"md5(concat(id::VARCHAR, ':{cfg.SEED}:{tag}')), id) AS place, "
                f"count(*) OVER (PARTITION BY target) AS n FROM {rows}")

    t, v = cfg.TEST_PERCENT, cfg.VALIDATION_PERCENT
    return f"""
        SELECT id, target, CASE WHEN place <= (n * {t} + 99) // 100 THEN 'test' ELSE 'rest' END AS part
        FROM ({place('test', source)})""", f"""
        SELECT id, target, 'test' AS split FROM part2 WHERE part = 'test'
        UNION ALL
        SELECT id, target, CASE WHEN place <= (n * {v} + 99) // 100 THEN 'val' ELSE 'train' END AS split
        FROM ({place('val', "(SELECT id, target FROM part2 WHERE part = 'rest')")})"""


_PART2, _SPLIT3 = split_sql("eng")
_NUM = cfg.NUMERIC
_CAT = cfg.CATEGORICAL

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "li": ((), """
        SELECT l_orderkey, min(l_partkey) AS partkey, max(l_shipdate) AS deadline,
               sum(l_quantity) AS pledged, count(*) AS backers FROM lineitem GROUP BY l_orderkey"""),
    "campaigns": (("li",), """
        SELECT o_orderkey AS id, concat(p_name, ' of the ', p_type, ' #', p_size::VARCHAR) AS name,
               p_type AS category, c_mktsegment AS main_category, r_name AS currency, n_name AS country,
               o_totalprice AS usd_goal_real, o_orderdate AS launched, deadline,
               CASE o_orderstatus WHEN 'F' THEN 'successful' WHEN 'O' THEN 'failed' ELSE 'canceled' END AS state,
               pledged, backers
        FROM orders JOIN li ON l_orderkey = o_orderkey JOIN part ON p_partkey = partkey
        JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey"""),
    "posts": ((), """
        SELECT d.doc_id AS id, d.text AS name, d.source AS category, d.lang AS main_category,
               d.n_chars::DOUBLE AS usd_goal_real, l.quality AS target
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""),
    "scores": (("campaigns",), f"""
        SELECT id, CASE WHEN state = 'successful' THEN 1 ELSE 0 END AS label,
               CASE WHEN {unit("concat(id::VARCHAR, ':split')")} < 0.64::DOUBLE THEN 'train'
                    WHEN {unit("concat(id::VARCHAR, ':split')")} < 0.8::DOUBLE THEN 'val' ELSE 'test' END AS split,
               floor(64.0::DOUBLE * ({unit("concat(id::VARCHAR, ':score')")} * 3.0::DOUBLE
                     + CASE WHEN state = 'successful' THEN 1 ELSE 0 END) / 4.0::DOUBLE) / 64.0::DOUBLE AS proba
        FROM campaigns WHERE state IN ('successful', 'failed')"""),
    "labelled": (("campaigns",), f"""
        SELECT *, CASE WHEN state = 'successful' THEN 1 ELSE 0 END AS target,
               (epoch_us(deadline) - epoch_us(launched))::DOUBLE / 86400e6::DOUBLE AS duration_days,
               length(coalesce(name, ''))::INTEGER AS name_len,
               len(list_filter(regexp_split_to_array(coalesce(name, ''), '[{WHITESPACE}]+'),
                               lambda w: w <> ''))::INTEGER AS name_words
        FROM campaigns WHERE state IN ('successful', 'failed')"""),
    "base": (("labelled",), f"""
        SELECT {', '.join(cfg.BASE_COLUMNS)} FROM labelled
        WHERE usd_goal_real > 0 AND duration_days > 0 AND regexp_matches(name, '[^{WHITESPACE}]')"""),
    "clean": (("base",), f"""
        SELECT *, {cleaned('name')} AS name_clean, len({clean_list('name')})::INTEGER AS name_clean_tokens
        FROM base"""),
    "eng": (("clean",), """
        SELECT * REPLACE (name_len::DOUBLE AS name_len, name_words::DOUBLE AS name_words),
               ln(1.0::DOUBLE + greatest(usd_goal_real, 0)) AS log_goal,
               year(launched)::VARCHAR AS launch_year, month(launched)::VARCHAR AS launch_month,
               (isodow(launched) - 1)::VARCHAR AS launch_dow
        FROM clean WHERE name_clean <> ''"""),
    "part2": (("eng",), _PART2),
    "split3": (("part2",), _SPLIT3),
    "rec": (("eng", "split3"), "SELECT e.*, s.split FROM eng e JOIN split3 s USING (id)"),
    "train": (("rec",), "SELECT * FROM rec WHERE split = 'train'"),
    "pclean": (("posts",), f"SELECT *, {cleaned('name')} AS name_clean FROM posts"),
    **tfidf_ctes("p", "pclean"),
    **tfidf_ctes("c", "rec", "split = 'train'"),
    "stats": (("train",), " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg({c}) AS mean, "
        f"CASE WHEN stddev_pop({c}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({c}) END AS scale FROM train"
        for c in _NUM)),
    "numlong": (("rec",), " UNION ALL ".join(
        f"SELECT id, split, '{c}' AS \"column\", {c}::DOUBLE AS x FROM rec" for c in _NUM)),
    "numcells": (("numlong", "stats"), """
        SELECT id, split, concat('num__', "column") AS feature, "column", (x - mean) / scale AS value
        FROM numlong JOIN stats USING ("column")"""),
    "catlong": (("rec",), " UNION ALL ".join(
        f"SELECT id, split, '{c}' AS \"column\", {c}::VARCHAR AS level FROM rec" for c in _CAT)),
    "levels": (("catlong",), """
        SELECT "column", level, (row_number() OVER (PARTITION BY "column" ORDER BY level) - 1)::INTEGER AS code
        FROM (SELECT DISTINCT "column", level FROM catlong WHERE split = 'train' AND level IS NOT NULL)"""),
    "catcells": (("catlong", "levels"), """
        SELECT id, split, concat('cat__', "column", '_', level) AS feature, "column", level, 1.0::DOUBLE AS value
        FROM catlong JOIN levels USING ("column", level)"""),
    "cells": (("numcells", "catcells", "cw", "rec"), """
        SELECT id, r.split, concat('text__', term) AS feature, weight AS value FROM cw JOIN rec r USING (id)
        UNION ALL SELECT id, split, feature, value FROM numcells
        UNION ALL SELECT id, split, feature, value FROM catcells"""),
    "features": (("cvocab", "levels", "stats"), """
        SELECT concat('text__', term) AS feature, 'text' AS block, 'name' AS source_column FROM cvocab
        UNION ALL SELECT concat('num__', "column"), 'tabular', "column" FROM stats
        UNION ALL SELECT concat('cat__', "column", '_', level), 'tabular', "column" FROM levels"""),
    "coefs": (("features",), f"""
        SELECT feature, block, {hash_coef('feature')} AS coef, abs({hash_coef('feature')}) AS abs_coef
        FROM features"""),
    # scorecard contributions per record
    "parts": (("cw", "numcells", "catcells", "cvocab", "cnt_card", "stats"), f"""
        SELECT id, concat('text__', term) AS feature, weight * {hash_coef("concat('text__', term)")} AS c FROM cnt_card
        UNION ALL SELECT id, feature, value * {hash_coef('feature')} FROM numcells
        UNION ALL SELECT id, feature, value * {hash_coef('feature')} FROM catcells"""),
    # weights from the card's own idf, rounded as exported
    "cnt_card": (("ccnt", "cvocab"), """
        SELECT id, term, c.tf * round(idf, 6) / sqrt(sum(c.tf * round(idf, 6) * c.tf * round(idf, 6))
               OVER (PARTITION BY id)) AS weight
        FROM ccnt c JOIN cvocab v USING (term)"""),
    "zs": (("parts", "rec"), f"""
        SELECT id, {hash_coef("'intercept'")} + coalesce(sum(c), 0) AS z FROM rec LEFT JOIN parts USING (id) GROUP BY id"""),
    # evaluation of the tied scores
    "conf": (("scores",), """
        SELECT split, count(*) FILTER (proba >= 0.5::DOUBLE AND label = 1) AS tp,
               count(*) FILTER (proba >= 0.5::DOUBLE AND label = 0) AS fp,
               count(*) FILTER (proba < 0.5::DOUBLE AND label = 0) AS tn,
               count(*) FILTER (proba < 0.5::DOUBLE AND label = 1) AS fn FROM scores GROUP BY split"""),
    "levels_of_score": (("scores",), """
        SELECT split, proba, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM scores GROUP BY split, proba"""),
    "cum": (("levels_of_score",), """
        SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
               sum(pos) OVER (PARTITION BY split) AS P, sum(neg) OVER (PARTITION BY split) AS N
        FROM levels_of_score WINDOW w AS (PARTITION BY split ORDER BY proba DESC)"""),
    "rank_metrics": (("cum",), """
        SELECT split, sum(pos * (2.0::DOUBLE * (N - fp) + neg)) / (2.0::DOUBLE * max(P) * max(N)) AS roc_auc,
               sum(pos::DOUBLE * tp / (tp + fp)) / max(P) AS average_precision FROM cum GROUP BY split"""),
    "metrics": (("conf", "rank_metrics"), """
        SELECT split, (tp + tn)::DOUBLE / (tp + fp + tn + fn) AS accuracy,
               coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS "precision",
               coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
               coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, roc_auc, average_precision
        FROM conf JOIN rank_metrics USING (split)"""),
    "sweep": (("scores",), f"""
        SELECT split, k::INTEGER AS grid_index, k / 100.0::DOUBLE AS threshold,
               (tp + tn)::DOUBLE / (tp + fp + tn + fn) AS accuracy,
               coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS "precision",
               coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
               coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
        FROM (SELECT split, k, count(*) FILTER (proba >= k / 100.0::DOUBLE AND label = 1) AS tp,
                     count(*) FILTER (proba >= k / 100.0::DOUBLE AND label = 0) AS fp,
                     count(*) FILTER (proba < k / 100.0::DOUBLE AND label = 0) AS tn,
                     count(*) FILTER (proba < k / 100.0::DOUBLE AND label = 1) AS fn
              FROM scores, range({cfg.THRESHOLD_FIRST}, {cfg.THRESHOLD_LAST + 1}) g(k) GROUP BY split, k)"""),
}


def sql(body: str, *needs: str) -> str:
    """``body`` with the named expressions and all they need in front of it."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return body
    named = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    own = body.strip()
    if own.startswith("WITH "):
        return f"WITH {named},\n{own[len('WITH '):]}"
    return f"WITH {named}\n{own}"


# --- fits shared by several queries of one session --------------------------

_CACHE: dict[tuple, object] = {}


def shared(fn):
    def call(spark: SparkSession, folder: str):
        key = (fn.__name__, spark.sparkContext.applicationId, folder)
        if key not in _CACHE:
            _CACHE[key] = fn(spark, folder)
        return _CACHE[key]
    return call


def modelling(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.modelling_table(tables.campaigns(spark, folder))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.add_basics(prepare.label_outcomes(tables.campaigns(spark, folder)))


@shared
def records(spark: SparkSession, folder: str) -> DataFrame:
    """Modelling rows with their split, staged: every fit below reads them again."""
    return training.split_records(tables.campaigns(spark, folder))


def train_rows(spark: SparkSession, folder: str) -> DataFrame:
    return records(spark, folder).where(F.col("split") == "train")


@shared
def features(spark: SparkSession, folder: str) -> FusedModel:
    return fit_features(train_rows(spark, folder), FeatureSpec())


@shared
def prepared(spark: SparkSession, folder: str) -> training.Prepared:
    model = features(spark, folder)
    return training.fit_prepared(records(spark, folder), model.spec, text=model.text, tabular=model.tabular)


def post_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Posts as token lists, straight from the raw text."""
    tokens = F.filter(clean_tokens(F.col("name")), lambda w: F.length(w) >= cfg.MIN_TOKEN_LENGTH)
    return tables.posts(spark, folder).select("id", "main_category", "target", tokens.alias("tokens"))


@shared
def post_block(spark: SparkSession, folder: str) -> TextBlock:
    return fit_text(post_tokens(spark, folder))


def title_tokens(df: DataFrame) -> DataFrame:
    return tokens_of(df)


def hashed_coef(name: str) -> float:
    """A fixed, data-independent coefficient in [-1, 1) for a feature name."""
    return round(2.0 * int(hashlib.md5(name.encode()).hexdigest()[:8], 16) / 4294967296.0 - 1.0, 6)


@shared
def hashed_card(spark: SparkSession, folder: str) -> sc.Scorecard:
    """A scorecard on fitted vocabulary, scaling and levels with hashed weights."""
    model = features(spark, folder)
    return sc.build(model, [hashed_coef(n) for n in model.names], hashed_coef("intercept"))


@shared
def hashed_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    model = features(spark, folder)
    coefs = [hashed_coef(n) for n in model.names]
    return local_rows(spark, {"feature": model.names, "block": model.blocks, "coef": coefs,
                              "abs_coef": [abs(c) for c in coefs]},
                      "feature string, block string, coef double, abs_coef double")


@shared
def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scored rows as a stored predictions table, the way evaluation meets them."""
    return stage(tables.scores(spark, folder), "scores")


@shared
def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and labels of the modelling rows, stored: fitting a split reads them again."""
    return stage(modelling(spark, folder).select("id", "target"), "labels")


@shared
def measures(spark: SparkSession, folder: str) -> DataFrame:
    """The numeric columns of the labelled rows, stored for multi-pass summaries."""
    return stage(labelled(spark, folder).select(
        "usd_goal_real", "duration_days", "name_len", "name_words"), "measures")


def two_way(spark: SparkSession, folder: str) -> DataFrame:
    return split.two_way(labels(spark, folder))
