import pytest
from pyspark.sql import functions as F

from tandem import config as cfg
from tandem.functions import text as txt

CASES = [
    ("A Lamp for Bergen + Oslo", "lamp bergen oslo"),
    ("Volume 88", "volume"),
    ("", ""),
    (None, ""),
    ("Who Was Ada?", "ada"),
    ("   ", ""),
    ("NULL", "null"),
    ("Ünïcode café", "n code caf"),
    (" ".join(cfg.STOP_WORDS[20:25]), ""),
]


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, name string")


def test_clean_text(titles):
    rows = titles.select("id", txt.clean_text(F.col("name")).alias("c")).orderBy("id").collect()
    assert [r["c"] for r in rows] == [c for _, c in CASES]


def test_cleaning_twice_changes_nothing(titles):
    once = txt.clean_text(F.col("name"))
    out = titles.withColumn("a", once).withColumn("b", txt.clean_text(F.col("a")))
    assert out.where("a <> b").count() == 0


def test_stop_words():
    assert len(cfg.STOP_WORDS) == len(set(cfg.STOP_WORDS)) == 318
    assert {"the", "none"} <= set(cfg.STOP_WORDS)


@pytest.mark.parametrize("title", [
    "two words", " lead", "tab\tand\nline", "no break", "a b", "", "x", "\x1cx\x85y", "   "])
def test_title_counts_match_python(spark, title):
    row = spark.createDataFrame([(title,)], "name string").select(
        txt.title_length(F.col("name")), txt.title_words(F.col("name")), txt.is_blank(F.col("name"))).first()
    assert tuple(row) == (len(title), len(title.split()), title.strip() == "")


def test_null_title_counts_as_empty(spark):
    row = spark.createDataFrame([(None,)], "name string").select(
        txt.title_length(F.col("name")), txt.title_words(F.col("name")), txt.is_blank(F.col("name"))).first()
    assert tuple(row) == (0, 0, True)


def test_model_tokens_drop_single_letters(spark):
    row = spark.createDataFrame([("x ring y small",)], "c string").select(txt.model_tokens(F.col("c"))).first()
    assert row[0] == ["ring", "small"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(txt.ngrams(F.col("t"), 1, 2)).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["a"], []]
    got = [r[0] for r in df.select(txt.ngrams(F.col("t"), 2, 3)).collect()]
    assert got == [["a b", "b c", "a b c"], [], []]
