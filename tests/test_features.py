import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem import config as cfg
from tandem.operators import fusion, svd, tabular as tab, textblock as tx

DOCS = [(0, "apple pear apple"), (1, "pear plum"), (2, ""), (3, "plum plum fig x"), (4, "apple fig kiwi")]


@pytest.fixture(scope="module")
def docs(spark):
    return tx.tokens_of(spark.createDataFrame(DOCS, "id int, name_clean string"))


def brute_tfidf(min_df=2):
    tokens = {i: [w for w in t.split() if len(w) > 1] for i, t in DOCS}
    df = {}
    for ws in tokens.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log((1 + len(DOCS)) / (1 + n)) + 1 for w, n in df.items() if n >= min_df}
    out = {}
    for i, ws in tokens.items():
        raw = {w: ws.count(w) * idf[w] for w in set(ws) if w in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, w): v / norm for w, v in raw.items()})
    return out


def test_tfidf_matches_the_formula(docs):
    block = tx.fit_text(docs)
    got = {(r["id"], r["term"]): r["weight"] for r in block.long(docs).collect()}
    want = brute_tfidf()
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_vocabulary_cap_takes_frequent_terms_first(docs):
    counts = {r["term"]: (r["tf"], r["doc_freq"]) for r in tx.term_counts(docs, F.col("tokens")).collect()}
    assert counts == {"apple": (3, 2), "pear": (2, 2), "plum": (3, 2), "fig": (2, 2), "kiwi": (1, 1)}
    assert tx.fit_text(docs, max_terms=3).terms == ["apple", "fig", "plum"]


def test_a_term_in_a_third_of_all_rows(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"cold{'abc'[i % 3]} rare") for i in range(3000)]
    df = tx.tokens_of(spark.createDataFrame(rows, "id int, name_clean string")).repartition(6)
    counts = {r["term"]: r["doc_freq"] for r in tx.term_counts(df, F.col("tokens")).collect()}
    assert counts["hot"] == 1000


def test_unseen_text_gives_an_empty_row(docs, spark):
    block = tx.fit_text(docs)
    new = tx.tokens_of(spark.createDataFrame([(9, "unknown words"), (8, None)], "id int, name_clean string"))
    assert block.long(new).count() == 0


@pytest.fixture(scope="module")
def levels_frame(spark):
    train = spark.createDataFrame(
        [(i, float(i), 5.0, f"lvl{i % 159}", "ab"[i % 2]) for i in range(1000)],
        "id int, x double, same double, wide string, narrow string")
    new = spark.createDataFrame([(1, 3.0, 5.0, "lvl7", "zzz"), (2, 0.0, 5.0, None, "b")], train.schema)
    return train, new


def test_scaler_uses_population_deviation(levels_frame):
    train, _ = levels_frame
    stats, n = tab.fit_scaler(train, ["x", "same"])
    assert n == 1000
    assert stats["x"] == pytest.approx((499.5, np.arange(1000).std()))
    assert stats["same"] == (5.0, 1.0)


def test_onehot_unseen_and_null_are_zero(levels_frame):
    train, new = levels_frame
    block = tab.fit_tabular(train, ("x",), ("wide", "narrow"))
    assert block.width == 1 + 159 + 2
    dictionary = tab.level_dictionary(train, ["wide", "narrow"])
    assert sorted((r["id"], r["feature"]) for r in tab.long_onehot(new, dictionary, ["wide", "narrow"]).collect()) == [
        (1, "cat__wide_lvl7"), (2, "cat__narrow_b")]
    codes = {(r["id"], r["column"]): r["code"] for r in tab.ordinal_codes(new, dictionary, ["wide", "narrow"]).collect()}
    assert codes[1, "narrow"] == codes[2, "wide"] == -1 and codes[2, "narrow"] == 1


def test_dictionary_numbers_follow_the_order_of_levels(levels_frame):
    train, _ = levels_frame
    rows = tab.level_dictionary(train, ["wide", "narrow"]).collect()
    for column in ("wide", "narrow"):
        own = sorted((r["level"], r["code"]) for r in rows if r["column"] == column)
        assert [code for _, code in own] == list(range(len(own)))
    assert len(rows) == 161


def test_any_number_of_levels_is_encoded(spark):
    df = spark.range(210_000).selectExpr("id", "concat('lvl', id) AS wide", "cast(id % 7 AS double) AS x")
    dictionary = tab.level_dictionary(df, ["wide"])
    codes = tab.ordinal_codes(df, dictionary, ["wide"])
    assert codes.agg({"code": "min"}).first()[0] == 0 and codes.select("code").distinct().count() == 210_000
    assert tab.long_onehot(df, dictionary, ["wide"]).count() == 210_000
    assert len(tab.fit_levels(df, ["wide"])["wide"]) == 210_000


@pytest.mark.parametrize("values", [[3.0] * 5, [1.0, 2.0] * 4, [0.0] * 9 + [1.0]])
def test_merged_quantile_edges_keep_a_bin(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(99, None), (98, float("nan"))], "id int, x double")
    edges = tab.quantile_edges(df.where("id < 90"), "x", 10)
    bins = {r["id"]: r["bin"] for r in tab.bin_index(df.where("id <> 98"), "x", edges).collect()}
    assert set(bins[i] for i in range(len(values))) <= set(range(max(1, len(edges) - 1))) and bins[99] is None
    assert tab.quantile_edges(df, "x", 10)[0] == min(values)


def test_vector_and_long_form_agree(levels_frame):
    train, new = levels_frame
    block = tab.fit_tabular(train, ("x",), ("wide", "narrow"))
    stages = [block.scale_stage(), *block.index_stages()]
    out = tab.apply_stages(new, stages)
    out = block.onehot_stage().fit(tab.apply_stages(train.limit(0), stages)).transform(out)
    cells = {c: {r["id"]: r[f"hot__{c}"] for r in out.collect()} for c in ("wide", "narrow")}
    assert cells["wide"][1].size == 159 and cells["narrow"][1].size == 2
    assert cells["narrow"][1].numNonzeros() == 0 and cells["wide"][2].numNonzeros() == 0


def test_interaction_cells(levels_frame):
    train, new = levels_frame
    dictionary = tab.level_dictionary(train, ["wide", "narrow"])
    rows = tab.long_interaction(new, "x", "wide", dictionary).collect()
    assert [(r["id"], r["feature"], r["value"]) for r in rows] == [(1, "inter__x_x_wide_lvl7", 3.0)]
    assert tab.long_interaction(new.where("id = 2"), "x", "narrow", dictionary).count() == 0  # value 0


def test_cells_beyond_127_levels(levels_frame):
    train, _ = levels_frame
    edges = tab.quantile_edges(train, "x", 10)
    dictionary = tab.level_dictionary(train, ["wide"])
    cells = tab.bin_cells(train, "x", edges, "wide", dictionary)
    row = cells.agg(F.min("cell"), F.max("cell"), F.count("*")).first()
    assert row[0] >= 0 and 127 * 10 < row[1] < 159 * 10 and row[2] == 1000


def test_fused_dictionary_is_complete(spark, model, prepared):
    assert len(model.names) == model.width == prepared.rows.first()["features"].size
    assert sum(model.block_widths().values()) == model.width
    names = model.feature_dict(spark)
    assert fusion.lineage_violations(names, model.text.table, [*cfg.NUMERIC, *cfg.CATEGORICAL]).count() == 0
    stray = spark.createDataFrame([(99, "num__pledged", "tabular", "pledged"), (98, "text__nosuch", "text", "name")],
                                  names.schema)
    assert fusion.lineage_violations(
        names.unionByName(stray), model.text.table, [*cfg.NUMERIC, *cfg.CATEGORICAL]).count() == 2


def test_nothing_is_fitted_outside_train(model, records):
    train = records.where("split = 'train'")
    assert model.n_rows == train.count() == model.text.n_docs
    seen = {r[0] for r in train.select(F.explode(F.split("name_clean", " "))).distinct().collect()}
    assert set(model.text.terms) <= seen
    want = train.agg(*[F.avg(c) for c in cfg.NUMERIC]).first()
    assert [model.tabular.stats[c][0] for c in cfg.NUMERIC] == pytest.approx(list(want))


def test_features_stay_sparse(prepared):
    kinds = prepared.rows.select(F.unwrap_udt("features")["type"].alias("t")).distinct().collect()
    assert [r["t"] for r in kinds] == [0]


def test_blocks_align_by_id(spark):
    left = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id int, target int")
    right = spark.createDataFrame([(2, 1), (3, 0), (4, 0)], "id int, target int")
    assert fusion.alignment(left, right).first().asDict() == {
        "matched": 2, "left_only": 1, "right_only": 1, "label_mismatch": 1}


def test_all_extra_blocks(records):
    spec = fusion.FeatureSpec(slopes=(("log_goal", "main_category"), ("log_goal", "category")),
                              bins=(("log_goal", 10), ("log_goal", 25)),
                              cells=(("log_goal", 10, "main_category"),))
    m = fusion.fit_features(records.where("split = 'train'"), spec)
    row = m.transform(records).select("features").first()
    assert row["features"].size == m.width == len(set(m.names))


def test_projection_matches_numpy(spark):
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 6)) * (rng.uniform(size=(40, 6)) < 0.5)
    x[7] = 0
    rows = [(i, Vectors.sparse(6, {int(j): float(r[j]) for j in np.nonzero(r)[0]}) if i % 2 else Vectors.dense(r))
            for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["id", "v"])
    basis = svd.fit_svd(df, "v", 4)
    np.testing.assert_allclose(basis.values, np.linalg.svd(x, compute_uv=False)[:4], rtol=1e-9)
    got = {r["id"]: r["text_svd"].toArray() for r in svd.project(df, "v", basis).collect()}
    np.testing.assert_allclose(np.array([got[i] for i in range(40)]), x @ basis.vectors, atol=1e-9)
