"""Queries: profiles, rates, histograms, quality counts, block audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem import config as cfg
from tandem.catalog import base as b
from tandem.catalog.base import query, r, rnd, sql
from tandem.functions import numeric as num
from tandem.operators import fusion, ordering, prepare, profile, split, textblock as tx
from tandem.plans import export
from tandem.sources import tables as t

_POST_COLUMNS = ("id", "name", "category", "main_category", "usd_goal_real", "target")
_SPARK_TYPES = {"id": "bigint", "name": "string", "category": "string", "main_category": "string",
                "usd_goal_real": "double", "target": "int"}


@query("agg_profile", sql(" UNION ALL ".join(f"""
    SELECT '{c}' AS "column", '{_SPARK_TYPES[c]}' AS dtype, count(*) FILTER ({c} IS NULL) AS nulls,
           {r(f"100.0::DOUBLE * count(*) FILTER ({c} IS NULL) / count(*)")} AS null_pct,
           count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_values
    FROM posts""" for c in _POST_COLUMNS), "posts"))
def agg_profile(spark, d):
    return profile.column_profile(t.posts(spark, d), _POST_COLUMNS, long_text=("name",)).withColumn(
        "null_pct", rnd("null_pct"))


@query("agg_value_counts", sql(f"""
    SELECT state, count(*) AS "count",
           {r('100.0::DOUBLE * count(*) / (SELECT count(*) FROM campaigns)')} AS pct
    FROM campaigns GROUP BY state""", "campaigns"))
def agg_value_counts(spark, d):
    return profile.value_counts(t.campaigns(spark, d), "state").withColumn("pct", rnd("pct"))


@query("agg_value_counts_null", sql(f"""
    SELECT coalesce(target::VARCHAR, 'null') AS target, count(*) AS "count",
           {r('100.0::DOUBLE * count(*) / (SELECT count(*) FROM posts)')} AS pct
    FROM posts GROUP BY target""", "posts"))
def agg_value_counts_null(spark, d):
    counts = profile.value_counts(t.posts(spark, d), "target")
    return counts.select(F.coalesce(F.col("target").cast("string"), F.lit("null")).alias("target"),
                         "count", rnd("pct").alias("pct"))


@query("agg_rate_by_cat", sql(f"""
    SELECT main_category, count(*) AS "count", {r('avg(target)')} AS success_rate
    FROM labelled GROUP BY main_category ORDER BY success_rate DESC""", "labelled"))
def agg_rate_by_cat(spark, d):
    rates = profile.rate_by(prepare.label_outcomes(t.campaigns(spark, d)), "main_category")
    return rates.withColumn("success_rate", rnd("success_rate")).orderBy(F.desc("success_rate"))


@query("agg_rate_topn", sql(f"""
    SELECT country, count(*) AS "count", {r('avg(target)')} AS success_rate FROM labelled
    GROUP BY country ORDER BY "count" DESC, country LIMIT 10""", "labelled"))
def agg_rate_topn(spark, d):
    rates = profile.rate_by_top(prepare.label_outcomes(t.campaigns(spark, d)), "country", 10)
    return rates.withColumn("success_rate", rnd("success_rate"))


@query("agg_rate_by_year", sql(f"""
    SELECT launch_year, count(*) AS "count", {r('avg(target)')} AS success_rate FROM train GROUP BY launch_year""",
    "train"))
def agg_rate_by_year(spark, d):
    return profile.rate_by(b.train_rows(spark, d), "launch_year").withColumn("success_rate", rnd("success_rate"))


@query("agg_rate_spread", sql(f"""
    WITH y AS (SELECT launch_year AS l, avg(target) AS m FROM train GROUP BY launch_year)
    SELECT (SELECT l FROM y ORDER BY m DESC, l LIMIT 1) AS best_level, {r('max(m)')} AS best_rate,
           (SELECT l FROM y ORDER BY m, l LIMIT 1) AS worst_level, {r('min(m)')} AS worst_rate,
           {r('100.0::DOUBLE * (max(m) - min(m))')} AS spread_points FROM y""", "train"))
def agg_rate_spread(spark, d):
    out = profile.rate_extremes(profile.rate_by(b.train_rows(spark, d), "launch_year"), "launch_year")
    return out.withColumns({c: rnd(c) for c in ("best_rate", "worst_rate", "spread_points")})


@query("agg_corr", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r(f'corr({c}::DOUBLE, target::DOUBLE)')} AS correlation FROM labelled"
    for c in ("pledged", "backers", "usd_goal_real")), "labelled"))
def agg_corr(spark, d):
    df = prepare.label_outcomes(t.campaigns(spark, d))
    return profile.label_correlations(df, ["pledged", "backers", "usd_goal_real"]).withColumn(
        "correlation", rnd("correlation"))


_DESCRIBED = ("usd_goal_real", "duration_days", "name_len", "name_words")


@query("agg_describe", sql(" UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS "count", {r(f'avg({c})', 4)} AS mean,
           {r(f'stddev_samp({c})', 4)} AS std, {r(f'min({c})', 4)} AS "min", {r(f'max({c})', 4)} AS "max",
           {r(f'quantile_cont({c}, 0.25)', 4)} AS q25, {r(f'quantile_cont({c}, 0.5)', 4)} AS q50,
           {r(f'quantile_cont({c}, 0.75)', 4)} AS q75 FROM (SELECT {c}::DOUBLE AS {c} FROM labelled)"""
    for c in _DESCRIBED), "labelled"))
def agg_describe(spark, d):
    out = profile.describe(b.measures(spark, d), _DESCRIBED)
    return out.withColumns({c: rnd(c, 4) for c in ("mean", "std", "min", "max", "q25", "q50", "q75")})


@query("agg_skew", sql(f"""
    SELECT {r('skewness(usd_goal_real)')} AS raw_skew,
           {r('skewness(ln(1.0::DOUBLE + usd_goal_real))')} AS log_skew FROM posts""", "posts"))
def agg_skew(spark, d):
    x = F.col("usd_goal_real")
    return t.posts(spark, d).agg(rnd(profile.skewness(x)).alias("raw_skew"),
                                 rnd(profile.skewness(num.log_amount(x))).alias("log_skew"))


@query("agg_quality", sql("""
    SELECT count(*) AS "rows", count(*) - count(DISTINCT id) AS duplicate_ids,
           count(*) FILTER (trim(name) = '') AS empty_names,
           count(*) FILTER (usd_goal_real <= 0) AS nonpositive_goals,
           count(*) FILTER (duration_days IS NULL OR duration_days <= 0) AS invalid_duration,
           count(*) FILTER (category IS NULL) AS null_category,
           count(*) FILTER (country IS NULL) AS null_country FROM labelled""", "labelled"))
def agg_quality(spark, d):
    return profile.quality_report(b.labelled(spark, d))


def _histogram_sql(expr: str, source: str, bins: int) -> str:
    return f"""
    WITH v AS (SELECT ({expr})::DOUBLE AS x FROM {source}), lim AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
    SELECT least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1})::INTEGER AS bin,
           {r(f'min(lo) + least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1}) * ((min(hi) - min(lo)) / {bins})')} AS bin_start,
           count(*) AS "count" FROM v, lim GROUP BY least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1})"""


def _histogram(df, column, bins):
    return profile.histogram(df, column, bins).withColumn("bin_start", rnd("bin_start"))


@query("agg_histogram", sql(_histogram_sql("least(greatest(duration_days, 0), 90)", "labelled", 40), "labelled"))
def agg_histogram(spark, d):
    return _histogram(b.measures(spark, d), num.clip(F.col("duration_days"), 0, 90), 40)


@query("agg_histogram_log", sql(_histogram_sql("ln(1.0::DOUBLE + usd_goal_real)", "posts", 40), "posts"))
def agg_histogram_log(spark, d):
    return _histogram(t.posts(spark, d), num.log_amount(F.col("usd_goal_real")), 40)


@query("agg_histogram_tokens", sql(_histogram_sql(
    f"least(len({b.clean_list('name')}), 20)", "posts", 20), "posts"))
def agg_histogram_tokens(spark, d):
    df = prepare.add_clean_title(t.posts(spark, d))
    return _histogram(df, num.clip(F.col("name_clean_tokens"), high=20), 20)


@query("agg_token_freq", sql("""
    SELECT term AS token, sum(tf)::BIGINT AS n FROM
    (SELECT unnest(string_split(name_clean, ' ')) AS term, 1 AS tf FROM pclean WHERE name_clean <> '')
    GROUP BY term ORDER BY n DESC, token LIMIT 20""", "pclean"))
def agg_token_freq(spark, d):
    from tandem.functions.text import clean_tokens
    words = t.posts(spark, d).select(F.explode(clean_tokens(F.col("name"))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(20)


@query("agg_doc_freq", sql("SELECT term, tf, doc_freq FROM pterms", "pterms"))
def agg_doc_freq(spark, d):
    return tx.term_counts(b.post_tokens(spark, d), F.col("tokens"))


@query("agg_mean_tfidf", sql(f"""
    SELECT term, {r('sum(weight) / (SELECT count(*) FROM pclean)')} AS mean_tfidf FROM pw GROUP BY term""",
    "pw", "pclean"))
def agg_mean_tfidf(spark, d):
    block = b.post_block(spark, d)
    means = tx.mean_weights(b.post_tokens(spark, d), block)
    return means.select("term", rnd("mean_tfidf").alias("mean_tfidf"))


@query("agg_modality_coef", sql(f"""
    SELECT block, count(*) AS n, {r('avg(abs_coef)')} AS mean_abs, {r('sum(abs_coef)')} AS sum_abs
    FROM coefs GROUP BY block""", "coefs"))
def agg_modality_coef(spark, d):
    return b.hashed_coefficients(spark, d).groupBy("block").agg(
        F.count("*").alias("n"), rnd(F.avg("abs_coef")).alias("mean_abs"),
        rnd(F.sum("abs_coef")).alias("sum_abs"))


@query("agg_cardinality", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS levels FROM eng" for c in cfg.CATEGORICAL), "eng"))
def agg_cardinality(spark, d):
    return profile.level_counts(b.modelling(spark, d), cfg.CATEGORICAL)


@query("agg_category_tree", sql("""
    SELECT main_category AS parent, array_to_string(list_sort(list(DISTINCT category)), '|') AS children
    FROM eng GROUP BY main_category""", "eng"))
def agg_category_tree(spark, d):
    tree = profile.level_tree(b.modelling(spark, d), "main_category", "category")
    return tree.select("parent", F.array_join("children", "|").alias("children"))


@query("agg_modal_child", sql("""
    SELECT main_category AS parent, category AS child, count(*) AS n FROM eng GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY main_category ORDER BY count(*) DESC, category) = 1""", "eng"))
def agg_modal_child(spark, d):
    return profile.modal_child(b.modelling(spark, d), "main_category", "category")


@query("agg_medians", sql(f"""
    SELECT {r('quantile_cont(usd_goal_real, 0.5)')} AS goal_usd, {r('quantile_cont(duration_days, 0.5)')} AS duration_days,
           max(launch_year::INTEGER)::VARCHAR AS launch_year FROM eng""", "eng"))
def agg_medians(spark, d):
    df = b.records(spark, d)
    middle = ordering.exact_quantiles(df, ["usd_goal_real", "duration_days"], [0.5])

    def of(column):
        return F.max(F.when(F.col("column") == column, F.col("value")))

    latest = df.agg(F.max(F.col("launch_year").try_cast("int")).cast("string"))
    return middle.agg(rnd(of("usd_goal_real")).alias("goal_usd"),
                      rnd(of("duration_days")).alias("duration_days")).withColumn("launch_year", latest.scalar())


@query("agg_prevalence", sql(f"""
    SELECT {r('avg(target)')} AS positive_rate, {r('greatest(avg(target), 1 - avg(target))')} AS majority_accuracy
    FROM rec WHERE split = 'test'""", "rec"))
def agg_prevalence(spark, d):
    out = profile.prevalence(b.records(spark, d).where(F.col("split") == "test"))
    return out.select(*[rnd(c).alias(c) for c in out.columns])


@query("agg_block_stats", sql(f"""
    SELECT n AS "rows", w AS cols, nnz, {r('nnz / (n * w::DOUBLE)')} AS density,
           nnz * 8 + (n + 1) * 4 AS sparse_bytes, n * w * 4 AS dense_bytes
    FROM (SELECT (SELECT count(*) FROM pclean) AS n, (SELECT count(*) FROM pvocab) AS w,
                 (SELECT count(*) FROM pw) AS nnz)""", "pclean", "pvocab", "pw"))
def agg_block_stats(spark, d):
    block = b.post_block(spark, d)
    rows = block.transform(b.post_tokens(spark, d))
    return fusion.block_stats(rows, "text_vec", block.width).withColumn("density", rnd("density"))


@query("agg_split_summary", sql(f"""
    SELECT split, count(*) AS "rows", {r('avg(target)')} AS success_rate FROM split3 GROUP BY split""", "split3"))
def agg_split_summary(spark, d):
    return b.records(spark, d).groupBy("split").agg(
        F.count("*").alias("rows"), rnd(F.avg("target")).alias("success_rate"))


@query("agg_coverage_check", sql("""
    SELECT (SELECT count(*) FROM eng) AS expected, count(*) AS assigned, count(*) FILTER (n = 1) AS once
    FROM (SELECT id, count(*) AS n FROM split3 GROUP BY id)""", "eng", "split3"))
def agg_coverage_check(spark, d):
    per_id = b.records(spark, d).groupBy("id").agg(F.count("*").alias("n"))
    out = per_id.agg(F.count("*").alias("assigned"), F.count_if(F.col("n") == 1).alias("once"))
    return out.withColumn("expected", b.modelling(spark, d).agg(F.count("*")).scalar())


# --- splits -----------------------------------------------------------------


@query("spl_two_way", sql("""
    SELECT id, CASE WHEN part = 'test' THEN 'test' ELSE 'train' END AS split FROM part2""", "part2"))
def spl_two_way(spark, d):
    return b.two_way(spark, d).select("id", "split")


@query("spl_three_way", sql("SELECT id, target, split FROM split3", "split3"))
def spl_three_way(spark, d):
    return split.three_way(b.labels(spark, d))


@query("spl_hash_bucket", sql(f"""
    SELECT id, CASE WHEN h < 0.2::DOUBLE THEN 'test' WHEN h < 0.2::DOUBLE + (1 - 0.2::DOUBLE) * 20 / 100 THEN 'val'
                    ELSE 'train' END AS split
    FROM (SELECT id, {b.unit("concat(id::VARCHAR, ':42:bucket')")} AS h FROM posts)""", "posts"))
def spl_hash_bucket(spark, d):
    return split.hash_split(t.posts(spark, d).select("id"))


@query("sc_defaults", sql("""
    SELECT main_category AS parent, category AS child, count(*) AS n,
           (SELECT round(quantile_cont(usd_goal_real, 0.5), 6) FROM eng) AS goal_usd,
           (SELECT round(quantile_cont(duration_days, 0.5), 6) FROM eng) AS duration_days,
           (SELECT max(launch_year::INTEGER)::VARCHAR FROM eng) AS launch_year
    FROM eng GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY main_category ORDER BY count(*) DESC, category) = 1""", "eng"))
def sc_defaults(spark, d):
    rec = b.records(spark, d)
    start = export.defaults(rec)
    return profile.modal_child(rec, "main_category", "category").withColumns({
        "goal_usd": rnd(F.lit(start["goal_usd"])), "duration_days": rnd(F.lit(start["duration_days"])),
        "launch_year": F.lit(start["launch_year"])})
