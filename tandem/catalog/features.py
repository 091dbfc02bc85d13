"""Queries: text operators and fitted feature transforms."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tandem import config as cfg
from tandem.catalog import base as b
from tandem.catalog.base import clean_list, cleaned, query, r, rnd, sql, term_list
from tandem.functions import text as txt
from tandem.operators import fusion, learn, svd, tabular as tab, textblock as tx
from tandem.operators.ordering import union_all
from tandem.session import stage
from tandem.sources import tables as t

# --- text -------------------------------------------------------------------


@query("txt_clean", sql(f"SELECT id, {cleaned('name')} AS name_clean FROM posts", "posts"))
def txt_clean(spark, d):
    return t.posts(spark, d).select("id", txt.clean_text(F.col("name")).alias("name_clean"))


@query("txt_clean_conversations", f"""
    SELECT conv_id, turn, {cleaned('text')} AS clean, {cleaned(cleaned('text'))} AS twice FROM conversations""")
def txt_clean_conversations(spark, d):
    """Cleaning an already clean text changes nothing."""
    clean = txt.clean_text(F.col("text"))
    return t.table(spark, d, "conversations").select("conv_id", "turn", clean.alias("clean")).withColumn(
        "twice", txt.clean_text(F.col("clean")))


@query("txt_stopwords", f"""
    SELECT w AS word, count(*) AS n FROM
    (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM documents)
    WHERE w IN ({', '.join(f"'{w}'" for w in cfg.STOP_WORDS)}) GROUP BY w""")
def txt_stopwords(spark, d):
    words = t.table(spark, d, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
    return words.where(F.col("word").isin(*cfg.STOP_WORDS)).groupBy("word").agg(F.count("*").alias("n"))


@query("txt_clean_tokens", sql(f"SELECT id, len({clean_list('name')})::INTEGER AS n FROM posts", "posts"))
def txt_clean_tokens(spark, d):
    return t.posts(spark, d).select("id", F.size(txt.clean_tokens(F.col("name"))).alias("n"))


@query("txt_len", sql("SELECT id, length(name)::INTEGER AS name_len FROM posts", "posts"))
def txt_len(spark, d):
    return t.posts(spark, d).select("id", txt.title_length(F.col("name")).alias("name_len"))


@query("txt_words", sql(f"""
    SELECT id, len(list_filter(regexp_split_to_array(name, '[{txt.WHITESPACE}]+'), lambda w: w <> ''))::INTEGER
    AS name_words FROM posts""", "posts"))
def txt_words(spark, d):
    return t.posts(spark, d).select("id", txt.title_words(F.col("name")).alias("name_words"))


@query("txt_tokenize", sql(f"""
    SELECT id, array_to_string({term_list('name_clean')}, ' ') AS tokens FROM pclean""", "pclean"))
def txt_tokenize(spark, d):
    return b.post_tokens(spark, d).select("id", F.array_join("tokens", " ").alias("tokens"))


@query("txt_ngrams", sql(f"""
    WITH tok AS (SELECT id, {term_list('name_clean')} AS t FROM pclean),
         grams AS (SELECT id, unnest(t) AS term FROM tok
                   UNION ALL SELECT id, concat(t[i], ' ', t[i + 1])
                   FROM (SELECT id, t, unnest(range(1, len(t))) AS i FROM tok WHERE len(t) > 1))
    SELECT term, count(*) AS tf, count(DISTINCT id) AS doc_freq FROM grams GROUP BY term
    HAVING count(DISTINCT id) >= {cfg.MIN_DOC_FREQ} ORDER BY tf DESC, term LIMIT {cfg.MAX_TERMS}""", "pclean"))
def txt_ngrams(spark, d):
    """Vocabulary over single words and pairs."""
    counts = tx.term_counts(b.post_tokens(spark, d), txt.ngrams(F.col("tokens"), 1, 2))
    return tx.pick_terms(counts, cfg.MAX_TERMS, cfg.MIN_DOC_FREQ)


@query("txt_vocab", sql("SELECT idx, term, tf, doc_freq FROM pvocab", "pvocab"))
def txt_vocab(spark, d):
    return b.post_block(spark, d).table.select("idx", "term", "tf", "doc_freq")


@query("txt_idf", sql(f"SELECT term, {r('idf')} AS idf FROM pvocab", "pvocab"))
def txt_idf(spark, d):
    return b.post_block(spark, d).table.select("term", rnd("idf").alias("idf"))


@query("txt_tfidf", sql(f"SELECT id, term, {r('weight')} AS weight FROM pw", "pw"))
def txt_tfidf(spark, d):
    cells = b.post_block(spark, d).long(b.post_tokens(spark, d))
    return cells.select("id", "term", rnd("weight").alias("weight"))


@query("txt_feature_names", sql("SELECT idx, concat('text__', term) AS feature FROM cvocab", "cvocab"))
def txt_feature_names(spark, d):
    return b.features(spark, d).text.table.select("idx", F.concat(F.lit("text__"), "term").alias("feature"))


# --- tabular features -------------------------------------------------------


@query("fx_scale", sql(f"SELECT id, feature, {r('value')} AS value FROM numcells", "numcells"))
def fx_scale(spark, d):
    cells = tab.long_scaled(b.records(spark, d), b.features(spark, d).tabular)
    return cells.select("id", "feature", rnd("value").alias("value"))


@query("fx_onehot", sql("SELECT id, feature, value FROM catcells", "catcells"))
def fx_onehot(spark, d):
    dictionary = tab.level_dictionary(b.train_rows(spark, d), cfg.CATEGORICAL)
    return tab.long_onehot(b.records(spark, d), dictionary, cfg.CATEGORICAL)


@query("fx_columns", sql(f"""
    SELECT id, feature, {r('value')} AS value FROM numcells WHERE value <> 0
    UNION ALL SELECT id, feature, value FROM catcells""", "numcells", "catcells"))
def fx_columns(spark, d):
    """The tabular part of the fused vector, routed column group by column group."""
    data = b.prepared(spark, d)
    cells = fusion.vector_cells(data.rows, data.model.feature_dict(spark))
    return cells.where(~F.col("feature").startswith("text__")).select(
        "id", "feature", rnd("value").alias("value"))


@query("fx_interaction", sql(f"""
    SELECT id, concat('inter__log_goal_x_main_category_', level) AS feature, {r('log_goal')} AS value
    FROM rec JOIN levels ON "column" = 'main_category' AND level = main_category WHERE log_goal <> 0""",
    "rec", "levels"))
def fx_interaction(spark, d):
    dictionary = tab.level_dictionary(b.train_rows(spark, d), [cfg.CROSS_WITH])
    cells = tab.long_interaction(b.records(spark, d), cfg.CROSS_BASE, cfg.CROSS_WITH, dictionary)
    return cells.select("id", "feature", rnd("value").alias("value"))


@query("fx_interaction_vector", sql(f"""
    SELECT id, concat('inter__log_goal_x_main_category_', level) AS feature, {r('log_goal')} AS value
    FROM rec JOIN levels ON "column" = 'main_category' AND level = main_category WHERE log_goal <> 0""",
    "rec", "levels"))
def fx_interaction_vector(spark, d):
    """The same cells out of the fused vector."""
    full = b.features(spark, d)
    spec = fusion.FeatureSpec(slopes=((cfg.CROSS_BASE, cfg.CROSS_WITH),))
    model = fusion.fit_features(b.train_rows(spark, d), spec, text=full.text, tabular=full.tabular)
    cells = fusion.vector_cells(model.transform(b.records(spark, d)), model.feature_dict(spark))
    return cells.where(F.col("feature").startswith("inter__")).select(
        "id", "feature", rnd("value").alias("value"))


@query("fx_quantile_bins", sql(" UNION ALL ".join(f"""
    SELECT {n}::INTEGER AS bins, i::INTEGER AS edge_index,
           {r("e[i + 1]")} AS edge
    FROM (SELECT quantile_cont(log_goal, [{', '.join(str(i / n) for i in range(n + 1))}]) AS e FROM train),
         range(0, {n + 1}) g(i)""" for n in (10, 25, 50)), "train"))
def fx_quantile_bins(spark, d):
    train = b.train_rows(spark, d)
    out = []
    for n in (10, 25, 50):
        edges = tab.quantile_edges(train, "log_goal", n)
        rows = spark.createDataFrame([(n, i, e) for i, e in enumerate(edges)], "bins int, edge_index int, edge double")
        out.append(rows.withColumn("edge", rnd("edge")))
    return union_all(out)


@query("fx_bin_onehot", sql("""
    SELECT id, (len(list_filter(e[2:10], lambda x: x <= log_goal)))::INTEGER AS bin FROM rec,
    (SELECT quantile_cont(log_goal, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS e FROM train)""",
    "rec", "train"))
def fx_bin_onehot(spark, d):
    edges = tab.quantile_edges(b.train_rows(spark, d), "log_goal", 10)
    return tab.bin_index(b.records(spark, d).select("id", "log_goal"), "log_goal", edges).select("id", "bin")


@query("fx_bin_cross", sql("""
    SELECT id, (code::BIGINT * 10 + len(list_filter(e[2:10], lambda x: x <= log_goal)))::BIGINT AS cell
    FROM rec JOIN levels ON "column" = 'main_category' AND level = main_category,
    (SELECT quantile_cont(log_goal, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS e FROM train)""",
    "rec", "levels", "train"))
def fx_bin_cross(spark, d):
    train = b.train_rows(spark, d)
    edges = tab.quantile_edges(train, "log_goal", cfg.GOAL_BINS)
    dictionary = tab.level_dictionary(train, [cfg.CROSS_WITH])
    return tab.bin_cells(b.records(spark, d), "log_goal", edges, cfg.CROSS_WITH, dictionary)


@query("fx_ordinal", sql("""
    SELECT id, l."column", coalesce(code, -1)::INTEGER AS code FROM catlong l LEFT JOIN levels USING ("column", level)""",
    "catlong", "levels"))
def fx_ordinal(spark, d):
    dictionary = tab.level_dictionary(b.train_rows(spark, d), cfg.CATEGORICAL)
    return tab.ordinal_codes(b.records(spark, d), dictionary, cfg.CATEGORICAL)


@b.shared
def post_projection(spark, d):
    """(basis, stored rows): posts projected on the leading directions of their text; fitted on all posts."""
    rows = stage(b.post_block(spark, d).transform(b.post_tokens(spark, d)).select("id", "text_vec"), "post_vectors")
    basis = svd.fit_svd(rows, "text_vec", cfg.SVD_RANK)
    out = svd.project(rows, "text_vec", basis).select("id", vector_to_array("text_svd").alias("v"))
    return basis, stage(out, "projection")


_SHOWN = 20


@query("fx_svd", f"""
    SELECT a::INTEGER AS a, b::INTEGER AS b, CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS product, true AS falls
    FROM range({_SHOWN}) x(a), range({_SHOWN}) y(b) WHERE a <= b""")
def fx_svd(spark, d):
    """Projections on the first directions, in units of their singular values: of unit length and at right angles,
    as only those on singular directions are; and no later value is larger."""
    basis, rows = post_projection(spark, d)
    scale = F.array(*[F.lit(float(s)) for s in basis.values[:_SHOWN]])
    cells = F.transform(F.slice("v", 1, _SHOWN), lambda x, k: x / F.element_at(scale, k + 1))
    pairs = [(i, j) for i in range(_SHOWN) for j in range(i, _SHOWN)]
    sums = rows.select(cells.alias("c")).agg(*[F.sum(F.col("c")[i] * F.col("c")[j]).alias(f"p{i}_{j}") for i, j in pairs])
    falls = bool((basis.values[1:] <= basis.values[:-1] + 1e-12).all())
    cell = lambda i, j: F.struct(F.lit(i).alias("a"), F.lit(j).alias("b"), rnd(f"p{i}_{j}").alias("product"))
    return sums.select(F.explode(F.array(*[cell(i, j) for i, j in pairs])).alias("c")).select("c.*", F.lit(falls).alias("falls"))


@query("fx_svd_rows")
def fx_svd_rows(spark, d):
    return post_projection(spark, d)[1].select("id", F.posexplode("v").alias("component", "value"))


@query("fx_svd_full", sql(f"""
    SELECT id, CASE WHEN count(term) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS energy
    FROM rec LEFT JOIN cw USING (id) GROUP BY id""", "rec", "cw"))
def fx_svd_full(spark, d):
    """At full rank a projection keeps the length of every (unit) row."""
    data = b.prepared(spark, d)
    basis = svd.fit_svd(data.train, "text_vec", data.model.text.width)
    v = vector_to_array("text_svd")
    return svd.project(data.rows, "text_vec", basis).select(
        "id", rnd(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)).alias("energy"))


@query("fx_gram", sql(f"""
    SELECT a.term AS term_a, c.term AS term_b, {r('sum(a.weight * c.weight)')} AS dot
    FROM cw a JOIN cw c ON a.id = c.id AND a.term <= c.term JOIN train t ON t.id = a.id GROUP BY 1, 2""",
    "cw", "train"))
def fx_gram(spark, d):
    data = b.prepared(spark, d)
    return svd.gramian_table(data.train, "text_vec", data.model.text).withColumn("dot", rnd("dot"))


@query("fx_dense_pack", sql(f"""
    SELECT id, split, {r('log_goal')} AS log_goal, {r('duration_days')} AS duration_days,
           coalesce(k.code, n)::DOUBLE AS country_code, (11 + least(120, w))::INTEGER AS width
    FROM rec LEFT JOIN (SELECT level AS country, code FROM levels WHERE "column" = 'country') k USING (country),
         (SELECT count(*) AS n FROM levels WHERE "column" = 'country'), (SELECT count(*) AS w FROM cvocab)""",
    "rec", "levels", "cvocab"))
def fx_dense_pack(spark, d):
    data = b.prepared(spark, d)
    pack = learn.fit_dense(data.train, data.model)
    v = vector_to_array("dense")
    at = pack.inputs.index
    return pack.transform(data.rows).select(
        "id", "split", rnd(v[at("log_goal")]).alias("log_goal"),
        rnd(v[at("duration_days")]).alias("duration_days"),
        v[at("code__country")].alias("country_code"), F.size(v).alias("width"))


@query("fx_names", sql("SELECT feature, block, source_column FROM features", "features"))
def fx_names(spark, d):
    return b.features(spark, d).feature_dict(spark).select("feature", "block", "source_column")


@query("fx_lineage", sql("""
    SELECT count(*) AS features, count(*) FILTER (block = 'text') AS text_features, 0::BIGINT AS violations
    FROM features""", "features"))
def fx_lineage(spark, d):
    model = b.features(spark, d)
    names = model.feature_dict(spark)
    wrong = fusion.lineage_violations(names, model.text.table, [*cfg.NUMERIC, *cfg.CATEGORICAL])
    out = names.agg(F.count("*").alias("features"), F.count_if(F.col("block") == "text").alias("text_features"))
    return out.withColumn("violations", wrong.agg(F.count("*")).scalar())


@query("fx_fit_scope", sql(f"""
    SELECT "column", (SELECT count(*) FROM train) AS fit_rows, {r('mean')} AS mean, {r('scale')} AS scale FROM stats""",
    "stats", "train"))
def fx_fit_scope(spark, d):
    """What the scaler saw: train rows only."""
    block = b.features(spark, d).tabular
    rows = [(c, block.n_rows, m, s) for c, (m, s) in block.stats.items()]
    seen = spark.createDataFrame(rows, "column string, fit_rows long, mean double, scale double")
    return seen.withColumns({"mean": rnd("mean"), "scale": rnd("scale")})


@query("fx_level_dictionary", sql("SELECT \"column\", level, code FROM levels", "levels"))
def fx_level_dictionary(spark, d):
    return tab.level_dictionary(b.train_rows(spark, d), cfg.CATEGORICAL)
