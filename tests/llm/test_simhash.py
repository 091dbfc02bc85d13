import re

import xxhash
from pyspark.sql import functions as F

from tandem.llm import linking, simhash
from tandem.llm.catalog import op7_simhash


def mark_of(text, size=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def lowest_reachable(items, near):
    """items: (id, value); plain search over all pairs."""
    label = {i: i for i, _ in items}
    changed = True
    while changed:
        changed = False
        for i, a in items:
            for j, b in items:
                if near(a, b) and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_query_against_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    marks = {r["doc_id"]: mark_of(r["text"]) for r in docs}
    want = lowest_reachable(sorted(marks.items()), lambda a, b: (a ^ b).bit_count() <= 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op7_simhash(spark, folder).collect()}
    assert got == {i: (f"{marks[i]:016x}", want[i]) for i in marks}


def test_blocks_miss_no_close_pair(spark):
    import random

    rng, marks = random.Random(5), []
    for _ in range(40):
        base = rng.getrandbits(64)
        marks.append(base)
        for flips in (1, 3, 4, 4, 5):
            close = base
            for bit in rng.sample(range(64), flips):
                close ^= 1 << bit
            marks.append(close)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    keyed = spark.createDataFrame([(m,) for m in signed], "id long").select(F.explode(simhash.block_keys(F.col("id"), 4, 7)).alias("bucket"), "id")
    found = linking.connect(keyed, lambda p: p.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 4))
    label = {r["id"]: r["component"] for r in found.collect()}
    want = lowest_reachable([(s, m) for s, m in zip(signed, marks)], lambda a, b: (a ^ b).bit_count() <= 4)
    assert {s: label.get(s, s) for s in signed} == want


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in linking.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}}
    assert linking.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pairs_that_the_first_star_misses_are_found(spark):
    members = spark.createDataFrame([("x", i) for i in (0, 10, 11, 12, 30)], "bucket string, id long")
    found = linking.connect(members, lambda p: p.where(F.abs(F.col("a") - F.col("b")) <= 2))
    assert {r["id"]: r["component"] for r in found.collect()} == {10: 10, 11: 10, 12: 10}


def test_nulls_long_texts_repeats_and_no_rows(spark):
    long_text = "alpha beta gamma delta " * 100_000
    rows = [(None, "one two three four five", 1), (4, "one two three four five", 2), (4, "one two three four five", 2), (5, None, 3), (6, " \n", 4), (7, long_text, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    out = simhash.near_copies(docs)
    assert out.columns == ["doc_id", "text", "fingerprint", "component_id", "first"]
    got = {(r["doc_id"], r["component_id"]) for r in out.collect()}
    assert got == {(None, 4), (4, 4), (5, 5), (6, 5), (7, 7)}
    assert out.count() == 6 and sorted(r["doc_id"] for r in out.where("first").collect()) == [4, 5, 7]
    without_id = simhash.near_copies(docs.where("doc_id is null").union(docs.where("doc_id is null")))
    assert [r["component_id"] for r in without_id.where("first").collect()] == [None]
    assert simhash.near_copies(docs.limit(0)).collect() == []
