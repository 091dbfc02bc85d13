"""Mean weights and term counts against plain Python."""

from collections import Counter

import numpy as np
import pytest

from tandem.operators import textblock as tx

TEXTS = [["red", "fox", "red"], [], ["fox"], None, ["red", "fox", "owl", "owl"], ["owl", "elk"], ["elk", "rare"]]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, tokens array<string>")


def test_counts_of_terms_and_documents(frame):
    got = {r["term"]: (r["tf"], r["doc_freq"]) for r in tx.term_counts(frame, frame["tokens"]).collect()}
    tf, df = Counter(w for t in TEXTS for w in t or []), Counter(w for t in TEXTS for w in set(t or []))
    assert got == {w: (tf[w], df[w]) for w in tf}


def test_means_count_empty_rows_and_send_one_vector_a_task(spark, frame):
    rows = frame.where("tokens is not null")
    block = tx.fit_text(rows)
    means = tx.mean_weights(rows, block)
    got = {r["term"]: r["mean_tfidf"] for r in means.collect()}
    idf = dict(zip(block.terms, block.idf))
    total = Counter()
    for t in TEXTS:
        w = {k: n * idf[k] for k, n in Counter(t or []).items() if k in idf}
        for k, v in w.items():
            total[k] += v / np.sqrt(sum(x * x for x in w.values()))
    assert sorted(got) == sorted(total) == ["elk", "fox", "owl", "red"]
    for k, v in total.items():
        assert got[k] == pytest.approx(v / 6, rel=1e-12)
    plan = means._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate")  # cells are listed from the sums, not from the rows
