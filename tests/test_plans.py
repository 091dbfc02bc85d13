"""What must hold of the physical plans, so that they still hold on large tables."""

import re

import pytest

import __spark_entry__ as entry
from conftest import plan_of
from tandem.catalog import base
from tandem.operators import metrics as met, split, textblock as tx
from tandem.session import pinned, shared_dir, stage
from tandem.sources import tables as t

ROW_LEVEL = ["flt_state", "flt_quality", "txt_clean", "txt_tfidf", "txt_words", "dt_parts", "fx_scale", "fx_onehot",
             "fx_columns", "sc_score", "sc_contrib", "sc_whatif", "spl_three_way", "agg_doc_freq", "ev_score",
             "ev_threshold_sweep", "jn_split_left", "agg_describe"]


def operators(plan: str) -> list[str]:
    return [line.strip(" :+-*()0123456789") for line in plan.splitlines()]


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_no_python_and_no_single_partition(spark, folder, name):
    plan = plan_of(entry.queries()[name](spark, folder))
    assert not re.search(r"(Arrow|Batch)EvalPython|MapInPandas|PythonUDF", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # a final global aggregate may gather its partial rows; a window or sort may not
    ops = operators(plan)
    for i, op in enumerate(ops):
        if op.startswith("Exchange SinglePartition"):
            assert ops[i - 1].startswith("HashAggregate"), (name, ops[i - 1])


@pytest.mark.parametrize("name", ["txt_clean", "txt_tfidf", "fx_scale", "sc_score", "sc_contrib", "sc_whatif", "fx_onehot"])
def test_row_wise_operators_do_not_shuffle(spark, folder, name):
    plan = plan_of(entry.queries()[name](spark, folder))
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_split_membership_is_a_comparison(spark, folder):
    rows = base.records(spark, folder).select("id", "target")
    assert "Exchange hashpartitioning" not in plan_of(split.three_way(rows))


def test_scans_read_only_what_they_need(spark, folder):
    plan = plan_of(t.campaigns(spark, folder).select("id", "state"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line)
    assert "l_extendedprice" not in scan and "l_quantity" not in scan and "l_shipdate" not in scan


def test_term_counting_combines_before_the_shuffle(spark, folder):
    df = base.post_tokens(spark, folder)
    plan = plan_of(tx.term_counts(df, df.tokens))
    assert plan.count("Exchange hashpartitioning(term") == 1 and "partial_sum" in plan


def test_sweep_is_one_pass(spark, folder):
    plan = plan_of(met.threshold_sweep(base.scores(spark, folder), ("split",)))
    assert plan.count("FileScan") == 1 and "Window" not in plan


def test_pinned_tables_are_stored_at_any_size(spark):
    for n in (5, 50_000):
        kept = pinned(spark.range(n))
        assert "FileScan" in plan_of(kept) and kept.count() == n


def test_staged_tables_live_in_the_configured_folder(spark):
    staged = stage(spark.range(3).selectExpr("id", "id % 2 AS k"), "x", ("k",))
    assert staged.count() == 3
    assert all(shared_dir(spark) in f for f in staged.inputFiles())


def test_scoring_streams_without_state(spark, folder):
    from tandem.streaming import scoring
    stream = spark.readStream.schema(t.CAMPAIGN_SCHEMA).parquet(folder)
    scored = scoring.score_stream(stream, base.hashed_card(spark, folder))
    text = scored._jdf.queryExecution().analyzed().toString()
    assert scored.isStreaming and "Aggregate" not in text
