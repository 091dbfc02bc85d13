import hashlib
import math
from collections import defaultdict

import numpy as np

from tandem.llm import catalog, vectorcode

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def brute_force(rows, entries=256, rounds=4):
    """Plain loops over plain integers: (vec_id, code, error, label_error), and the codebooks' digest."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    dims = max(4, -(-max(len(v) for _, v, _ in kept) // 4) * 4)
    kept = [(i, v + [0] * (dims - len(v)), label) for i, v, label in kept]
    places = dims // 4
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * places : (p + 1) * places] for r in order] for p in range(4)]

    def assign(v, p):
        part = v[p * places : (p + 1) * places]
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[assign(v, p)[1]].append(v[p * places : (p + 1) * places])
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])]
    coded, totals = [], defaultdict(int)
    for i, v, label in kept:
        found = [assign(v, p) for p in range(4)]
        coded.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        totals[label] += coded[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, totals[label]) for i, c, e, label in coded), key=repr), digest


def held(df):
    rows = df.collect()
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in rows), key=repr), {r["codebooks_sha256"] for r in rows}


def check(spark, rows):
    got, digests = held(vectorcode.compress(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)))
    want, digest = brute_force([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows])
    assert got == want and digests == ({digest} if want else set())


def test_random_vectors(spark):
    rng = np.random.default_rng(5)
    check(spark, [(int(i), rng.normal(0, 0.2, 8).astype(np.float32).tolist(), int(i) % 3 if i % 7 else None) for i in rng.permutation(700)])


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, [0.5] * 6, 1), (3, [0.25, -0.5, 0.0, 1.0, 2.0, -0.0001], 1), (None, [9.0] * 6, None), (7, None, 1), (8, [1.0, None], 1), (9, [nan, 1.0], 2),
        (10, [-inf, 0.0], 2), (11, [], 2), (12, [1.5], 2), (3, [0.5] * 6, 1), (-4, [100.0, -100.0, 0.0, 0.0, 50.0, 0.0], 5),
    ]
    check(spark, rows)
    check(spark, rows[3:4])
    check(spark, [(1, [], None)])
    assert vectorcode.compress(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ties_go_to_the_lower_entry_and_copies_agree(spark):
    rows = [(i, [0.0, 1.0, 0.0, 0.0], 1) for i in range(300)] + [(300 + i, [i / 1024.0, 0.0, 0.0, 0.0], 2) for i in range(8)]
    check(spark, rows)


def test_huge_components_are_bounded(spark):
    rows = spark.createDataFrame([(1, [3e38, -3e38, 0.0, 1.0], 1, "x"), (2, [0.0, 0.0, 0.0, 0.0], 1, "x")], SCHEMA)
    got = {r["vec_id"]: r for r in vectorcode.compress(rows).collect()}
    assert got[1]["code"] == "00000000" and got[2]["code"] == "01010001" and got[1]["error"] >= 0


def test_extra_columns_and_clashing_names(spark):
    df = spark.createDataFrame([(1, [0.5] * 4, 1, "mine")], SCHEMA)
    out = vectorcode.compress(df)
    assert out.columns == ["vec_id", "embedding", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert out.first()["code"] == "00000000"


def test_tables_give_plain_distances():
    rng = np.random.default_rng(1)
    for scale in (300, 40_000, 1 << 27):
        whole, books = rng.integers(-scale, scale, (1000, 12)), rng.integers(-scale, scale, (4, 256, 3))
        best, distance = vectorcode.nearest(*vectorcode.to_block(whole), books)
        for p in range(4):
            plain = ((whole[:, None, p * 3 : p * 3 + 3] - books[p][None]) ** 2).sum(axis=2)
            assert (best[p] == plain.argmin(axis=1)).all() and (distance[p] == plain.min(axis=1)).all()


def test_query_against_brute_force(spark, folder):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    dims = len(rows[0][1])
    got, digests = held(catalog.op13_vector_codes(spark, folder))
    # The brute force in plain Python, on NumPy rows for speed.
    whole = np.array([[math.floor(1024 * x) for x in v] for _, v, _ in rows])
    first = np.argsort([r[0] for r in rows], kind="stable")[:256]
    books = [whole[first, p * dims // 4 : (p + 1) * dims // 4] for p in range(4)]
    parts = [whole[:, p * dims // 4 : (p + 1) * dims // 4] for p in range(4)]
    near = lambda p: ((parts[p][:, None] - books[p][None]) ** 2).sum(axis=2)
    for _ in range(4):
        for p in range(4):
            best = near(p).argmin(axis=1)
            books[p] = np.array([parts[p][best == k].sum(axis=0) // (best == k).sum() if (best == k).any() else books[p][k] for k in range(256)])
    final = [near(p) for p in range(4)]
    error = sum(f.min(axis=1) for f in final)
    labels = defaultdict(int)
    for (_, _, label), e in zip(rows, error.tolist()):
        labels[label] += e
    want = sorted(((i, "".join(f"{f[k].argmin():02x}" for f in final), int(error[k]), labels[label]) for k, (i, _, label) in enumerate(rows)), key=repr)
    assert got == want
    assert digests == {hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()}
