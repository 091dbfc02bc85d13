import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tandem import config as cfg
from tandem.functions import numeric as num
from tandem.operators import prepare, profile
from tandem.sources import files, tables as t


@pytest.fixture(scope="module")
def toy(spark):
    rows = [
        (1, 0.0, "2013-06-11 07:45:00", "12", "3", "Craft", 1),
        (2, 750.0, "2016-03-18 21:10:00", "25", "5", "Games", 0),
        (3, 98765432.1, "next spring", None, None, "Craft", 1),
        (4, -5.0, None, "x", "1", None, 0),
        (5, None, "2015-01-04", "3", "1", "Art", 0),
    ]
    return spark.createDataFrame(
        rows, "id int, usd_goal_real double, launched string, name_len string, name_words string, "
              "main_category string, target int")


def test_engineered_columns(toy):
    rows = {r["id"]: r for r in prepare.add_engineered(toy).collect()}
    assert rows[1]["log_goal"] == 0.0
    assert rows[2]["log_goal"] == pytest.approx(math.log1p(750))
    assert rows[4]["log_goal"] == 0.0
    assert rows[5]["log_goal"] is None  # unknown stays unknown
    assert [rows[i]["launch_year"] for i in (1, 2, 3, 4)] == ["2013", "2016", "unknown", "unknown"]
    assert (rows[2]["launch_month"], rows[2]["launch_dow"]) == ("3", "4")  # a Friday, Monday being 0
    assert rows[5]["launch_dow"] == "6"
    assert [rows[i]["name_len"] for i in (1, 3, 4)] == [12.0, 0.0, 0.0]


def test_log_reduces_skew(spark):
    df = spark.createDataFrame([(float(10 ** (i % 8)),) for i in range(400)], "x double")
    row = df.agg(profile.skewness(F.col("x")).alias("a"),
                 profile.skewness(num.log_amount(F.col("x"))).alias("b")).first()
    assert abs(row["b"]) < abs(row["a"])


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (5.0,), (99.0,)], "x double")
    assert [r[0] for r in df.select(num.clip(F.col("x"), 0, 10)).collect()] == [None, 0.0, 5.0, 10.0]


def test_ratio_of_nothing_is_zero(spark):
    assert spark.range(1).select(num.ratio(F.lit(0), F.lit(0))).first()[0] == 0.0


def _campaign(i, **kw):
    row = dict(id=i, name="Small ring", category="c", main_category="m", currency="USD", country='N,0"',
               usd_goal_real=10.0, launched=datetime(2015, 1, 1), deadline=datetime(2015, 1, 31, 12),
               state="successful", pledged=1.0, backers=2)
    return tuple({**row, **kw}.values())


def test_base_table_drops_bad_rows(spark):
    rows = [
        _campaign(1), _campaign(2, state="canceled"), _campaign(3, usd_goal_real=0.0),
        _campaign(4, deadline=datetime(2014, 1, 1)), _campaign(5, name="  "), _campaign(6, name=None),
        _campaign(7, state="failed", usd_goal_real=1e9), _campaign(8, deadline=None),
    ]
    df = spark.createDataFrame(rows, t.CAMPAIGN_SCHEMA)
    out = {r["id"]: r for r in prepare.base_table(df).collect()}
    assert sorted(out) == [1, 7]
    assert (out[1]["duration_days"], out[1]["target"], out[7]["target"]) == (30.5, 1, 0)
    assert tuple(prepare.base_table(df).columns) == cfg.BASE_COLUMNS
    kept = prepare.kept_and_dropped(df).first()
    assert (kept["rows"], kept["kept"], kept["dropped"]) == (8, 7, 1)


def test_quality_report(spark):
    rows = [_campaign(1), _campaign(1), _campaign(2, usd_goal_real=-1.0), _campaign(3, name=" "),
            _campaign(4, deadline=None), _campaign(5, category=None, country=None)]
    df = prepare.add_basics(spark.createDataFrame(rows, t.CAMPAIGN_SCHEMA))
    assert profile.quality_report(df).first().asDict() == {
        "rows": 6, "duplicate_ids": 1, "empty_names": 1, "nonpositive_goals": 1, "invalid_duration": 1,
        "null_category": 1, "null_country": 1}


def test_duration_ignores_the_session_time_zone(spark):
    df = spark.createDataFrame([_campaign(1, launched=datetime(2020, 3, 7), deadline=datetime(2020, 3, 9))],
                               t.CAMPAIGN_SCHEMA)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert prepare.add_basics(df).first()["duration_days"] == 2.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_no_outcome_column_is_a_feature():
    assert not (set(cfg.NUMERIC) | set(cfg.CATEGORICAL)) & set(cfg.OUTCOME_COLUMNS)
    with pytest.raises(ValueError, match="pledged"):
        prepare.check_features(["log_goal", "pledged"])


def test_csv_round_trip(spark, tmp_path):
    names = ['comma, and "quote"', "line\nbreak", "", "back\\slash", "tab\t"]
    df = spark.createDataFrame([_campaign(i, name=n) for i, n in enumerate(names)], t.CAMPAIGN_SCHEMA)
    path = str(tmp_path / "csv")
    files.write_campaign_csv(df, path)
    back = files.read_campaign_csv(spark, path, multi_line=True)
    assert {r["id"]: (r["name"] or "", r["country"], r["launched"]) for r in back.collect()} == {
        i: (n, 'N,0"', datetime(2015, 1, 1)) for i, n in enumerate(names)}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    rows = {r["bin"]: r["count"] for r in profile.histogram(df, F.col("x"), 5).collect()}
    assert rows == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    same = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert [r["count"] for r in profile.histogram(same, F.col("x"), 5).collect()] == [4]


def test_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "a"), (4, None)], "id int, s string")
    rows = {r["column"]: r for r in profile.column_profile(df, long_text=("s",)).collect()}
    assert (rows["s"]["nulls"], rows["s"]["distinct_values"], rows["s"]["null_pct"]) == (2, 2, 50.0)
    assert rows["id"]["distinct_values"] == 4


def test_modal_child_ties_go_to_the_smaller_name(spark):
    df = spark.createDataFrame([("m", "b"), ("m", "a"), ("n", "z"), ("n", "z"), ("n", "y")], "p string, c string")
    assert {r["parent"]: r["child"] for r in profile.modal_child(df, "p", "c").collect()} == {"m": "a", "n": "z"}


def test_level_tree_lists_every_child(spark):
    df = spark.range(10).selectExpr("'p' AS p", "cast(id AS string) AS c")
    assert profile.level_tree(df, "p", "c").first()["children"] == [str(i) for i in range(10)]
