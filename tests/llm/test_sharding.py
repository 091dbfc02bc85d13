import hashlib

import pytest
from pyspark.sql import functions as F

from tandem.llm import sharding
from tandem.llm.catalog import op1_sharding


def by_hand(keys, shards, vnodes):
    """One key after the other, clockwise from cell 0, to the next shard that is not full."""
    nodes, room = sharding.ring(shards, vnodes), sharding.capacities(len(keys), shards, 0.0)
    at = {k: int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16) for k in keys}
    out = {}
    for k in sorted(keys, key=at.get):
        cell = at[k] >> (60 - sharding.CELL_BITS)
        n = next((i for i, (c, _) in enumerate(nodes) if c >= cell), len(nodes))
        while room[nodes[n % len(nodes)][1]] == 0:
            n += 1
        out[k] = nodes[n % len(nodes)][1]
        room[out[k]] -= 1
    return out


def test_rows_go_to_the_next_shard_with_room(spark):
    got = {r["doc_id"]: r["shard"] for r in sharding.shard(spark.range(3001).withColumnRenamed("id", "doc_id"), F.col("doc_id"), 5, 16).collect()}
    assert got == by_hand(range(3001), 5, 16)


def test_query_is_balanced_and_gapless(spark, folder):
    rows = op1_sharding(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(200))
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(25))


def test_one_more_shard_moves_few_keys_when_there_is_room(spark):
    keys = spark.range(20000).withColumnRenamed("id", "k")
    old = sharding.shard(keys, F.col("k"), 8, spare=0.25).select("k", F.col("shard").alias("a"))
    new = sharding.shard(keys, F.col("k"), 9, spare=0.25).select("k", F.col("shard").alias("b"))
    assert old.join(new, "k").where("a != b").count() < 0.3 * 20000


def test_nulls_repeats_clashing_names_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "x", 9)] * 4 + [(1, None, 9)] * 5 + [(2, "", 9)], "doc_id long, text string, shard int")
    out = sharding.shard(docs, F.col("doc_id"), 3)
    assert out.columns == ["doc_id", "text", "shard", "slot"]
    rows = out.collect()
    assert sorted(sum(r["shard"] == s for r in rows) for s in range(3)) == [3, 3, 4]
    assert sharding.shard(docs.limit(0), F.col("doc_id")).collect() == []
    with pytest.raises(ValueError):
        sharding.shard(docs, F.col("doc_id"), 0)
