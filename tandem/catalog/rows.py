"""Queries: filters, projections, joins, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem import config as cfg
from tandem.catalog import base as b
from tandem.catalog.base import query, r, rnd, sql
from tandem.functions import numeric as num, text as txt
from tandem.operators import fusion, metrics as met, prepare, profile, split, tabular as tab
from tandem.operators.ordering import union_all
from tandem.session import stage_path
from tandem.sources import files, tables as t

# --- filters and projections ------------------------------------------------


@query("flt_state", sql("SELECT id, state FROM campaigns WHERE state IN ('successful', 'failed')", "campaigns"))
def flt_state(spark, d):
    return prepare.label_outcomes(t.campaigns(spark, d)).select("id", "state")


@query("prj_target", sql("SELECT id, target FROM labelled", "labelled"))
def prj_target(spark, d):
    return prepare.label_outcomes(t.campaigns(spark, d)).select("id", "target")


@query("flt_dropped", sql(f"""
    SELECT count(*) AS "rows", count(*) FILTER (state IN ('successful', 'failed')) AS kept,
           count(*) FILTER (state NOT IN ('successful', 'failed')) AS dropped,
           {r("100.0::DOUBLE * count(*) FILTER (state NOT IN ('successful', 'failed')) / count(*)")} AS dropped_pct
    FROM campaigns""", "campaigns"))
def flt_dropped(spark, d):
    return prepare.kept_and_dropped(t.campaigns(spark, d)).withColumn("dropped_pct", rnd("dropped_pct"))


@query("prj_roles", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{role}' AS role, '{what}' AS decision, count({c}) AS non_null FROM campaigns"
    for c, (role, what) in cfg.COLUMN_ROLES.items()), "campaigns"))
def prj_roles(spark, d):
    return prepare.role_plan(t.campaigns(spark, d))


@query("prj_allowed", sql(f"""
    SELECT id, target, name_clean, {r('log_goal')} AS log_goal, {r('duration_days')} AS duration_days,
           name_len, name_words, {', '.join(cfg.CATEGORICAL)} FROM eng""", "eng"))
def prj_allowed(spark, d):
    """Only allowed columns reach a feature table."""
    return prepare.feature_rows(b.modelling(spark, d)).withColumns(
        {"log_goal": rnd("log_goal"), "duration_days": rnd("duration_days")})


@query("flt_quality", sql(f"""
    SELECT id, name, usd_goal_real, {r('duration_days')} AS duration_days, target FROM base""", "base"))
def flt_quality(spark, d):
    return prepare.quality_filter(b.labelled(spark, d)).select(
        "id", "name", "usd_goal_real", rnd("duration_days").alias("duration_days"), "target")


@query("flt_empty_text", sql("""
    SELECT id, length(name_clean)::INTEGER AS clean_len FROM pclean WHERE name_clean <> ''""", "pclean"))
def flt_empty_text(spark, d):
    kept = prepare.drop_empty_titles(prepare.add_clean_title(t.posts(spark, d)))
    return kept.select("id", F.length("name_clean").alias("clean_len"))


@query("prj_fillna", sql("""
    SELECT id, coalesce(target, 0)::DOUBLE AS target, coalesce(main_category, 'unknown') AS main_category,
           length(coalesce(name, ''))::INTEGER AS n FROM posts""", "posts"))
def prj_fillna(spark, d):
    return t.posts(spark, d).select(
        "id", num.to_number(F.col("target")).alias("target"),
        F.coalesce("main_category", F.lit(num.UNKNOWN)).alias("main_category"),
        txt.title_length(F.col("name")).alias("n"))


@query("prj_clip", sql(f"""
    SELECT id, {r('least(greatest(duration_days, 0), 90)')} AS duration_days,
           least(greatest(name_len, 0), 120)::DOUBLE AS name_len,
           least(greatest(name_words, 0), 5)::DOUBLE AS name_words,
           {r('greatest(usd_goal_real, 0)')} AS usd_goal_real FROM labelled""", "labelled"))
def prj_clip(spark, d):
    return b.labelled(spark, d).select(
        "id", rnd(num.clip(F.col("duration_days"), 0, 90)).alias("duration_days"),
        num.clip(F.col("name_len"), 0, 120).alias("name_len"),
        num.clip(F.col("name_words"), 0, 5).alias("name_words"),
        rnd(num.clip(F.col("usd_goal_real"), 0)).alias("usd_goal_real"))


@query("prj_case", sql("""
    SELECT feature, CASE WHEN starts_with(feature, 'text__') THEN 'text'
                         WHEN starts_with(feature, 'inter__') THEN 'interaction' ELSE 'tabular' END AS block
    FROM features""", "features"))
def prj_case(spark, d):
    f = F.col("feature")
    block = (F.when(f.startswith("text__"), "text").when(f.startswith("inter__"), "interaction")
             .otherwise("tabular"))
    return b.features(spark, d).feature_dict(spark).select("feature", block.alias("block"))


@query("prj_strip_prefix", sql("""
    SELECT feature, regexp_replace(feature, '^(text|num|cat|inter)__', '') AS label FROM features""", "features"))
def prj_strip_prefix(spark, d):
    return b.features(spark, d).feature_dict(spark).select(
        "feature", F.regexp_replace("feature", "^(text|num|cat|inter)__", "").alias("label"))


@query("prj_value_map", sql("""
    SELECT CASE target WHEN 0 THEN 'failed (0)' ELSE 'successful (1)' END AS outcome, count(*) AS "count"
    FROM labelled GROUP BY target""", "labelled"))
def prj_value_map(spark, d):
    shown = F.create_map(F.lit(0), F.lit("failed (0)"), F.lit(1), F.lit("successful (1)"))
    return (prepare.label_outcomes(t.campaigns(spark, d)).groupBy("target").agg(F.count("*").alias("count"))
            .select(shown[F.col("target")].alias("outcome"), "count"))


@query("prj_round", sql(f"""
    SELECT main_category, {r('avg(target)', 3)} AS rate3, {r('avg(target)', 4)} AS rate4,
           {r('avg(target)', 6)} AS rate6 FROM labelled GROUP BY main_category""", "labelled"))
def prj_round(spark, d):
    rates = profile.rate_by(prepare.label_outcomes(t.campaigns(spark, d)), "main_category")
    return rates.select("main_category", *[rnd("success_rate", p).alias(f"rate{p}") for p in (3, 4, 6)])


@query("prj_unpivot", sql("""
    SELECT split, unnest(['sparse', 'dense']) AS storage,
           unnest([nnz * 8 + ("rows" + 1) * 4, "rows" * (SELECT count(*) FROM cvocab) * 4])::BIGINT AS bytes
    FROM (SELECT r.split, count(DISTINCT r.id) AS "rows", count(w.term) AS nnz
          FROM rec r LEFT JOIN cw w USING (id) GROUP BY r.split)""", "rec", "cw", "cvocab"))
def prj_unpivot(spark, d):
    rows, width = b.prepared(spark, d).rows, b.features(spark, d).text.width
    stats = union_all([
        fusion.block_stats(rows.where(F.col("split") == s), "text_vec", width).withColumn("split", F.lit(s))
        for s in ("train", "val", "test")])
    named = stats.select("split", F.col("sparse_bytes").alias("sparse"), F.col("dense_bytes").alias("dense"))
    return named.unpivot(["split"], ["sparse", "dense"], "storage", "bytes")


@query("prj_const", sql("""
    SELECT id, 'labelled' AS source FROM labelled UNION ALL SELECT id, 'canceled' FROM campaigns
    WHERE state = 'canceled'""", "labelled", "campaigns"))
def prj_const(spark, d):
    raw = t.campaigns(spark, d)
    kept = prepare.label_outcomes(raw).select("id").withColumn("source", F.lit("labelled"))
    rest = raw.where(F.col("state") == "canceled").select("id").withColumn("source", F.lit("canceled"))
    return kept.unionByName(rest)


@query("prj_abs_delta", sql(f"""
    WITH rates AS (SELECT main_category, avg(target) AS rate FROM labelled GROUP BY 1)
    SELECT main_category, {r("rate - (SELECT rate FROM rates WHERE main_category = 'BUILDING')")} AS delta,
           {r("abs(rate - (SELECT rate FROM rates WHERE main_category = 'BUILDING'))")} AS abs_delta
    FROM rates""", "labelled"))
def prj_abs_delta(spark, d):
    rates = profile.rate_by(prepare.label_outcomes(t.campaigns(spark, d)), "main_category")
    out = met.delta_to(rates, F.col("main_category") == "BUILDING", "success_rate", "delta")
    return out.select("main_category", rnd("delta").alias("delta"), rnd(F.abs("delta")).alias("abs_delta"))


@query("prj_column_override", sql("""
    SELECT 'basic' AS spec, (SELECT count(*) FROM cvocab) AS n_text,
           2 + (SELECT count(*) FROM levels WHERE "column" IN ('category', 'main_category', 'currency', 'country')) AS n_tab,
           0::BIGINT AS n_inter
    UNION ALL SELECT 'no text', 0, 4 + (SELECT count(*) FROM levels), 0
    UNION ALL SELECT 'slopes', (SELECT count(*) FROM cvocab), 4 + (SELECT count(*) FROM levels),
           (SELECT count(*) FROM levels WHERE "column" = 'main_category')""", "cvocab", "levels"))
def prj_column_override(spark, d):
    train, full = b.train_rows(spark, d), b.features(spark, d)
    specs = {
        "basic": fusion.FeatureSpec(cfg.BASIC_NUMERIC, cfg.BASIC_CATEGORICAL),
        "no text": fusion.FeatureSpec(with_text=False),
        "slopes": fusion.FeatureSpec(slopes=((cfg.CROSS_BASE, cfg.CROSS_WITH),)),
    }
    parts = []
    for name, spec in specs.items():
        model = fusion.fit_features(train, spec, text=full.text, tabular=full.tabular)
        block = F.col("block")
        parts.append(model.feature_dict(spark).agg(
            F.lit(name).alias("spec"), F.count_if(block == "text").alias("n_text"),
            F.count_if(block == "tabular").alias("n_tab"), F.count_if(block == "interaction").alias("n_inter")))
    return union_all(parts)


@query("prj_pad_unknown", """
    SELECT o_orderkey AS id, coalesce(year(ts)::VARCHAR, 'unknown') AS launch_year,
           coalesce(month(ts)::VARCHAR, 'unknown') AS launch_month,
           coalesce((isodow(ts) - 1)::VARCHAR, 'unknown') AS launch_dow
    FROM (SELECT o_orderkey, try_cast(CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority
                 ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS ts FROM orders)""")
def prj_pad_unknown(spark, d):
    ts = num.parse_time(_messy_date())
    return t.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), num.year_level(ts).alias("launch_year"),
        num.month_level(ts).alias("launch_month"), num.weekday_level(ts).alias("launch_dow"))


def _messy_date():
    """A text column where one priority class carries no date at all."""
    return F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


# --- scalars ----------------------------------------------------------------


@query("dt_parse", """
    SELECT o_orderkey AS id, coalesce(strftime(try_cast(CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority
           ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP), '%Y/%m/%d %H.%M.%S'), 'missing') AS launched
    FROM orders""")
def dt_parse(spark, d):
    at = num.parse_time(_messy_date()).cast("timestamp_ntz")
    return t.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.coalesce(F.date_format(at, "yyyy/MM/dd HH.mm.ss"), F.lit("missing")).alias("launched"))


@query("dt_duration", sql(f"SELECT id, {r('duration_days')} AS duration_days FROM labelled", "labelled"))
def dt_duration(spark, d):
    return b.labelled(spark, d).select("id", rnd("duration_days").alias("duration_days"))


@query("dt_parts", sql("""
    SELECT id, year(launched)::VARCHAR AS launch_year, month(launched)::VARCHAR AS launch_month,
           (isodow(launched) - 1)::VARCHAR AS launch_dow FROM campaigns""", "campaigns"))
def dt_parts(spark, d):
    at = F.col("launched")
    return t.campaigns(spark, d).select(
        "id", num.year_level(at).alias("launch_year"), num.month_level(at).alias("launch_month"),
        num.weekday_level(at).alias("launch_dow"))


@query("num_log1p", sql(f"""
    SELECT id, {r('ln(1.0::DOUBLE + greatest(usd_goal_real, 0))')} AS log_goal FROM posts""", "posts"))
def num_log1p(spark, d):
    return t.posts(spark, d).select("id", rnd(num.log_amount(F.col("usd_goal_real"))).alias("log_goal"))


@query("num_log1p_negative", f"""
    SELECT c_custkey AS id, {r('ln(1.0::DOUBLE + greatest(c_acctbal, 0))')} AS log_amount FROM customer""")
def num_log1p_negative(spark, d):
    """Balances below zero count as zero."""
    return t.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), rnd(num.log_amount(F.col("c_acctbal"))).alias("log_amount"))


@query("num_coerce", """
    SELECT o_orderkey AS id, coalesce(try_cast(CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority
           ELSE o_custkey::VARCHAR END AS DOUBLE), 0) AS n FROM orders""")
def num_coerce(spark, d):
    messy = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority")).otherwise(
        F.col("o_custkey").cast("string"))
    return t.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), num.to_number(messy).alias("n"))


@query("num_sigmoid", sql(f"""
    SELECT id, {r('1.0::DOUBLE / (1.0::DOUBLE + exp(-(proba * 8 - 4)))')} AS p FROM scores""", "scores"))
def num_sigmoid(spark, d):
    return b.scores(spark, d).select("id", rnd(num.sigmoid(F.col("proba") * 8.0 - 4.0)).alias("p"))


@query("num_logit", sql(f"""
    SELECT id, {r('ln((proba * 0.5 + 0.25) / (1.0::DOUBLE - (proba * 0.5 + 0.25)))')} AS z FROM scores""", "scores"))
def num_logit(spark, d):
    return b.scores(spark, d).select("id", rnd(num.logit(F.col("proba") * 0.5 + 0.25)).alias("z"))


# --- joins and alignment ----------------------------------------------------


@query("jn_split_left", sql("""
    SELECT s.id, s.split, e.name, e.target FROM split3 s LEFT JOIN eng e ON s.id = e.id""", "split3", "eng"))
def jn_split_left(spark, d):
    ids = b.records(spark, d).select("id", "split")
    return ids.join(b.modelling(spark, d), "id", "left").select("id", "split", "name", "target")


@query("jn_align_check", sql("""
    SELECT count(*) AS matched, 0::BIGINT AS left_only, 0::BIGINT AS right_only, 0::BIGINT AS label_mismatch
    FROM eng""", "eng"))
def jn_align_check(spark, d):
    """Stored feature rows against the modelling table they came from."""
    return fusion.alignment(b.prepared(spark, d).rows.select("id", "target"),
                            b.modelling(spark, d).select("id", "target"))


@query("jn_fuse", sql(f"""
    SELECT id, count(*) AS cells, {r('sum(value * value)')} AS energy FROM cells WHERE value <> 0 GROUP BY id""",
    "cells"))
def jn_fuse(spark, d):
    """Blocks stored apart, matched by id and assembled."""
    from tandem.operators.textblock import explode_vector
    rec, model = b.records(spark, d), b.features(spark, d)
    text = model.text.transform(b.title_tokens(rec)).select("id", "text_vec")
    block = model.tabular
    stages = [block.scale_stage(), block.numeric_stage(), *block.index_stages()]
    tabular = tab.apply_stages(rec, stages)
    tabular = block.onehot_stage().fit(tabular.limit(0)).transform(tabular)
    from pyspark.ml.feature import VectorAssembler
    tabular = VectorAssembler(inputCols=["num_vec", *[f"hot__{c}" for c in block.categorical]],
                              outputCol="tab_vec").transform(tabular).select("id", "tab_vec")
    folder = stage_path(spark, "blocks")
    name = "blocks_" + folder.rsplit("-", 1)[-1]
    stored = [files.write_bucketed(df, f"{folder}/{kind}", f"{name}_{kind}", 8) for df, kind in ((text, "text"), (tabular, "tab"))]
    fused = fusion.fuse_blocks((stored[0], "text_vec"), (stored[1], "tab_vec"))
    w = F.col("weight")
    return explode_vector(fused, "features").groupBy("id").agg(
        F.count("*").alias("cells"), rnd(F.sum(w * w)).alias("energy"))


@query("jn_vocab", sql(f"""
    SELECT id, term, c.tf, {r('idf')} AS idf, {b.hash_coef("concat('text__', term)")} AS coef
    FROM ccnt c JOIN cvocab v USING (term)""", "ccnt", "cvocab"))
def jn_vocab(spark, d):
    rec = b.title_tokens(b.records(spark, d))
    terms = b.hashed_card(spark, d).term_table(spark).select("term", "idf", "coef")
    known = rec.select("id", F.explode("tokens").alias("term")).join(terms, "term")
    counts = known.groupBy("id", "term").agg(F.count("*").alias("tf"), F.first("idf").alias("idf"), F.first("coef").alias("coef"))
    return counts.select(
        "id", "term", "tf", rnd("idf").alias("idf"), "coef")


@query("jn_levels", sql(f"""
    SELECT id, l."column", l.level, CASE WHEN v.level IS NULL THEN 0 ELSE
           {b.hash_coef("concat('cat__', l.\"column\", '_', l.level)")} END AS coef
    FROM catlong l LEFT JOIN levels v USING ("column", level)""", "catlong", "levels"))
def jn_levels(spark, d):
    cells = tab.level_cells(b.records(spark, d), cfg.CATEGORICAL)
    coefs = b.hashed_card(spark, d).level_table(spark)
    return cells.join(coefs, ["column", "level"], "left").select(
        "id", "column", "level", F.coalesce("coef", F.lit(0.0)).alias("coef"))


@query("jn_subset_check", sql("""
    SELECT (SELECT count(*) FROM cvocab) AS terms, count(*) AS missing FROM
    (SELECT term FROM cvocab EXCEPT SELECT term FROM ctok JOIN train USING (id))""", "cvocab", "ctok", "train"))
def jn_subset_check(spark, d):
    vocab = b.features(spark, d).text.table.select("term")
    seen = b.title_tokens(b.train_rows(spark, d)).select(F.explode("tokens").alias("term")).distinct()
    missing = vocab.join(seen, "term", "left_anti").agg(F.count("*").alias("missing"))
    return missing.withColumn("terms", vocab.agg(F.count("*")).scalar())


@query("jn_disjoint_check", sql("""
    SELECT count(*) AS ids, sum(n)::BIGINT AS "rows", count(*) FILTER (splits > 1) AS in_two_splits,
           count(*) FILTER (n > 1) AS repeated
    FROM (SELECT id, count(*) AS n, count(DISTINCT split) AS splits FROM split3 GROUP BY id)""", "split3"))
def jn_disjoint_check(spark, d):
    return split.overlap(b.records(spark, d).select("id", "split"))


# --- top-k ------------------------------------------------------------------


def _ends(column: str, n: int) -> str:
    return f"""
    SELECT * FROM (SELECT 'high' AS side, feature, coef FROM {column} ORDER BY coef DESC, feature LIMIT {n})
    UNION ALL
    SELECT * FROM (SELECT 'low' AS side, feature, coef FROM {column} ORDER BY coef, feature LIMIT {n})"""


def top_and_bottom(coefs, n: int):
    high = coefs.orderBy(F.desc("coef"), "feature").limit(n).withColumn("side", F.lit("high"))
    low = coefs.orderBy("coef", "feature").limit(n).withColumn("side", F.lit("low"))
    return high.unionByName(low).select("side", "feature", "coef")


@query("top_coef", sql(_ends("coefs", 15), "coefs"))
def top_coef(spark, d):
    return top_and_bottom(b.hashed_coefficients(spark, d), 15)


@query("top_coef_text", sql(_ends("(SELECT * FROM coefs WHERE block = 'text')", 15), "coefs"))
def top_coef_text(spark, d):
    return top_and_bottom(b.hashed_coefficients(spark, d).where(F.col("block") == "text"), 15)


@query("top_coef_abs", sql("""
    SELECT feature, coef FROM coefs WHERE block = 'tabular' ORDER BY abs_coef DESC, feature LIMIT 15""", "coefs"))
def top_coef_abs(spark, d):
    tabular = b.hashed_coefficients(spark, d).where(F.col("block") == "tabular")
    return tabular.orderBy(F.desc("abs_coef"), "feature").limit(15).select("feature", "coef")


@query("top_idf", sql(f"""
    SELECT term, {r('idf')} AS idf FROM pvocab ORDER BY doc_freq, term LIMIT 20""", "pvocab"))
def top_idf(spark, d):
    return (b.post_block(spark, d).table.orderBy("doc_freq", "term").limit(20)
            .select("term", rnd("idf").alias("idf")))


@query("top_mean_tfidf", sql(f"""
    SELECT term, {r('sum(weight) / (SELECT count(*) FROM pclean)')} AS mean_tfidf FROM pw GROUP BY term
    ORDER BY mean_tfidf DESC, term LIMIT 20""", "pw", "pclean"))
def top_mean_tfidf(spark, d):
    from tandem.operators.textblock import mean_weights
    block = b.post_block(spark, d)
    means = mean_weights(b.post_tokens(spark, d), block)
    return (means.select("term", rnd("mean_tfidf").alias("mean_tfidf"))
            .orderBy(F.desc("mean_tfidf"), "term").limit(20))


@query("best_row", sql(f"""
    SELECT split, grid_index, threshold, {r('f1')} AS f1 FROM sweep
    QUALIFY row_number() OVER (PARTITION BY split ORDER BY f1 DESC, grid_index) = 1""", "sweep"))
def best_row(spark, d):
    sweep = met.threshold_sweep(b.scores(spark, d), ("split",))
    return met.best_row(sweep, "f1", "grid_index", ("split",)).select(
        "split", "grid_index", "threshold", rnd("f1").alias("f1"))


@query("nearest_row", sql(f"""
    SELECT grid_index, threshold, {r('f1')} AS f1 FROM sweep WHERE split = 'test'
    ORDER BY abs(threshold - 0.333::DOUBLE), grid_index LIMIT 1""", "sweep"))
def nearest_row(spark, d):
    sweep = met.threshold_sweep(b.scores(spark, d).where(F.col("split") == "test"))
    return met.nearest_row(sweep, "threshold", 0.333, "grid_index").select(
        "grid_index", "threshold", rnd("f1").alias("f1"))


@query("preview", sql("""
    SELECT id, name, state FROM campaigns ORDER BY md5(concat(id::VARCHAR, ':42')), id LIMIT 400""", "campaigns"))
def preview(spark, d):
    return profile.sample_rows(t.campaigns(spark, d), 400, cfg.SEED).select("id", "name", "state")


@query("rank_table", sql(f"""
    SELECT split, grid_index, {r('f1')} AS f1 FROM sweep ORDER BY f1 DESC, split, grid_index LIMIT 10""", "sweep"))
def rank_table(spark, d):
    sweep = met.threshold_sweep(b.scores(spark, d), ("split",)).select("split", "grid_index", rnd("f1").alias("f1"))
    return sweep.orderBy(F.desc("f1"), "split", "grid_index").limit(10)


# --- set operations ---------------------------------------------------------


@query("set_union", sql("SELECT id, split FROM split3", "split3"))
def set_union(spark, d):
    rec = b.records(spark, d).select("id", "split")
    return union_all([rec.where(F.col("split") == s).select("id").withColumn("split", F.lit(s))
                      for s in ("train", "val", "test")])


@query("set_distinct_pairs", sql("SELECT DISTINCT main_category, category FROM eng", "eng"))
def set_distinct_pairs(spark, d):
    return b.modelling(spark, d).select("main_category", "category").distinct()


@query("set_intersect_check", sql("""
    SELECT (SELECT count(*) FROM (SELECT id FROM split3 WHERE split = 'train'
            INTERSECT SELECT id FROM split3 WHERE split <> 'train')) AS shared,
           (SELECT count(*) FROM (SELECT id FROM eng EXCEPT SELECT id FROM split3)) AS uncovered""", "split3", "eng"))
def set_intersect_check(spark, d):
    rec = b.records(spark, d).select("id", "split")
    train, other = (rec.where(c).select("id") for c in (F.col("split") == "train", F.col("split") != "train"))
    shared = train.intersect(other).agg(F.count("*").alias("shared"))
    uncovered = b.modelling(spark, d).select("id").exceptAll(rec.select("id")).agg(F.count("*"))
    return shared.withColumn("uncovered", uncovered.scalar())
