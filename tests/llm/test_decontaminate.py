import hashlib
import re

import check_queries as check
import pytest

from tandem.llm import catalog, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, size=10):
    cut = [(str(i), tuple(w[s : s + size])) for i, t in items if i is not None and (w := terms(t)) for s in range(max(1, len(w) - size + 1))]
    out = []
    for doc_id, text in docs:
        w, hit, held = terms(text), set(), set()
        for item, window in cut:
            for s in range(len(w) - len(window) + 1):
                if tuple(w[s : s + len(window)]) == window:
                    hit.update(range(s, s + len(window)))
                    held.add(item)
        out.append((doc_id, len(w), len(hit), sorted(held)))
    return out


def run(spark, docs, items, **more):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return decontaminate.contaminated(docs, items, **more)


def test_query_matches_sql_and_brute_force(spark, folder):
    con = check.connect(folder)
    assert check.compare(catalog.op4_decontamination(spark, folder), con, catalog.ORACLES["op4_decontamination"]) is None
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["n_hit"], r["items_sha256"]) for r in catalog.op4_decontamination(spark, folder).collect()}
    assert got == {(i, h, hashlib.sha256(",".join(held).encode()).hexdigest()) for i, _, h, held in by_hand(docs, items)}
    assert sum(h > 0 for _, h, _ in got) > 2


def test_short_items_overlaps_repeats_and_nulls(spark):
    docs = [(1, "The cat-sat on THE mat."), (2, "a a a a a a a a a a a a"), (3, None), (4, ""), (None, "one cat"), (1, "The cat-sat on THE mat."), (5, "É1 x")]
    items = [(10, "cat sat"), (2, "a " * 11), (3, None), (4, "  .. "), (None, "mat"), (11, "É1"), (12, "nowhere")]
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in run(spark, docs, items).collect()]
    assert sorted(got, key=str) == sorted(by_hand(docs, items), key=str)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    assert [(r["n_hit"], r["item_ids"]) for r in run(spark, docs, items).collect()] == [(0, [])] * len(docs)


def test_proximity_is_told_from_phrases(spark):
    docs = [(1, "w0 alpha w1 w2 beta w3"), (2, "alpha x x x beta w1 w2"), (3, "alpha " + "w1 " * 40 + "beta w2")]
    got = {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in run(spark, docs, [(1, "alpha w1 w2 beta")], slack=3).collect()}
    assert got[1] == (4, 0) and got[2][0] == 0 and got[2][1] > 0 and got[3] == (0, 0)


def test_clashing_columns_and_a_long_text(spark):
    docs = spark.createDataFrame([(1, "x y z " * 100_000 + "rare one two", "h")], "doc_id long, text string, hits string")
    items = spark.createDataFrame([(1, "rare one two")], "item_id long, text string")
    out = decontaminate.contaminated(docs, items)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "item_ids", "hits", "n_near"]
    assert out.select("n_words", "n_hit").first() == (300_003, 3)


def test_distinct_words_are_not_gathered_in_one_task(spark, monkeypatch):
    plans, stage = {}, decontaminate.stage

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, label)

    monkeypatch.setattr(decontaminate, "stage", watched)
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    assert decontaminate.contaminated(docs, items).first()["n_hit"] == 2
    assert not any("Repartition" in plans[label] for label in ("terms", "wanted"))
