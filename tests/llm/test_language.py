import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tandem.llm import language
from tandem.llm.catalog import op2_language


def test_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op2_language(spark, folder).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and 150 < len(held) < 350
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_codewords_differ():
    for n in (1, 2, 3, 4, 5, 9, 30):
        code = language.codewords(n)
        assert code.shape[0] == n
        if n > 1:
            assert (np.abs(code.sum(axis=0)) < n).all()
            closest = min((code[a] != code[b]).sum() for a in range(n) for b in range(a))
            assert closest >= max(1, code.shape[1] // 4)


def test_grams_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array(["Some wörds, and MORE words " * 40, None, "", "!!", "tail"])
    count = lambda: [np.sort(np.concatenate([b[o == k] for o, b in found] or [[]])).tolist() for found in [list(language.gram_pieces(texts))] for k in range(5)]
    whole = count()
    monkeypatch.setattr(language, "CHUNK", 64)
    cut = count()
    assert whole[1:] == cut[1:] and whole[1] == whole[2] == whole[3] == []
    # A text read in pieces gets blanks at the cuts, nothing else.
    assert abs(len(cut[0]) - len(whole[0])) <= 0.2 * len(whole[0])


def test_nulls_letters_and_other_columns(spark):
    rows = [(k, f"the cat and the dog number {k}", "en", "x") for k in range(20)] + [(k, f"der Hund und die Katze Nummer {k}", "de", "x") for k in range(20, 40)]
    rows += [(40, None, "en", "x"), (41, "123 -- !!", "de", "x"), (42, "", None, "x"), (43, "die Katze und der Hund", None, "x"), (44, "the dog", None, "x"), (None, "the dog", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = language.identify(docs, F.lit(True))
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "ambiguous"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    assert got[40] == got[41] == got[42] == ("und", 0.0)
    assert got[43][0] == "de" and got[44] == got[None] and got[44][0] == "en"
    # What a prediction may not see makes no difference.
    other = docs.withColumns({"lang": F.when(F.col("doc_id") < 40, F.col("lang")), "doc_id": F.col("doc_id") + 7})
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(other, F.lit(True)).collect()}[50] == "de"


def test_nothing_learnt_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language.identify(docs, F.lit(True)).collect()] == ["und"]
    assert language.identify(docs.limit(0), F.lit(True)).collect() == []


def test_one_language_and_a_long_text(spark):
    docs = spark.createDataFrame([(1, "word " * 600_000, "en"), (2, "abc", None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in language.identify(docs, F.lit(True)).collect()} == {("en", 1.0)}
