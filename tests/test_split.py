import hashlib

import pytest

from tandem.operators import split


def brute(rows, percent, tag):
    """Ids of the held-out side by plain ranking."""
    out = set()
    for label in {y for _, y in rows}:
        ids = sorted((hashlib.md5(f"{i}:{tag}".encode()).hexdigest(), i) for i, y in rows if y == label)
        take = (len(ids) * percent + 99) // 100
        out |= {i for _, i in ids[:take]}
    return out


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, 1 if i % 3 == 0 else 0) for i in range(5000)]
    return rows, spark.createDataFrame(rows, "id long, target int")


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_matches_plain_ranking(labelled, digits):
    rows, df = labelled
    got = {r["id"] for r in split.two_way(df, digits=digits).where("split = 'test'").collect()}
    assert got == brute(rows, 20, "42:test")


def test_three_way_nests(labelled):
    rows, df = labelled
    parts = {}
    for r in split.three_way(df).collect():
        parts.setdefault(r["split"], set()).add(r["id"])
    test = brute(rows, 20, "42:test")
    assert parts["test"] == test
    assert parts["val"] == brute([x for x in rows if x[0] not in test], 20, "42:val")
    assert sum(map(len, parts.values())) == len(rows)


def test_test_rows_do_not_depend_on_the_validation_share(labelled):
    _, df = labelled
    ids = [sorted(r["id"] for r in split.three_way(df, validation_percent=v).where("split = 'test'").collect())
           for v in (10, 40)]
    assert ids[0] == ids[1]


def test_layout_does_not_matter(labelled):
    _, df = labelled
    a, b = (sorted(map(tuple, split.three_way(x).collect())) for x in (df, df.repartition(13)))
    assert a == b


def test_one_class_and_null_labels(spark):
    df = spark.createDataFrame([(i, None if i < 10 else 1) for i in range(60)], "id long, target int")
    counts = {(r["target"], r["split"]): r["count"] for r in
              split.two_way(df).groupBy("target", "split").count().collect()}
    assert counts == {(None, "test"): 2, (None, "train"): 8, (1, "test"): 10, (1, "train"): 40}


def test_splits_are_disjoint_and_complete(records):
    row = split.overlap(records.select("id", "split")).first()
    assert row["ids"] == row["rows"] == records.count()
    assert (row["in_two_splits"], row["repeated"]) == (0, 0)


def test_overlap_sees_a_repeat(spark):
    df = spark.createDataFrame([(1, "train"), (1, "test"), (2, "val"), (2, "val")], "id int, split string")
    row = split.overlap(df).first()
    assert (row["in_two_splits"], row["repeated"]) == (1, 2)


def test_hash_split_shares(spark):
    rows = split.hash_split(spark.range(20000)).groupBy("split").count().collect()
    share = {r["split"]: r["count"] / 20000 for r in rows}
    assert share["test"] == pytest.approx(0.20, abs=0.02)
    assert share["val"] == pytest.approx(0.16, abs=0.02)
