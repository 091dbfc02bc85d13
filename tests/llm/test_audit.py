import re
from collections import Counter, defaultdict
from itertools import permutations

from tandem.llm import audit, catalog


def brute_force(docs, labels):
    """Every order run filter by filter over the rows of every part."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i,
        }
        parts[part or ""].append((i, fails))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            alive, gone = rows, []
            for step, f in enumerate(order, 1):
                removed = [r for r in alive if r[1][f]]
                redundant = [r for r in gone if r[1][f]]
                alive, gone = [r for r in alive if not r[1][f]], gone + removed
                alone = [r for r in rows if r[1][f] and sum(r[1].values()) == 1]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [len(alive), len(removed), len(redundant), len(alone), sum(r[0] in good for r in removed), sum(r[0] in toxic for r in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def held(df):
    rows = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in audit.OUTPUTS] for r in df.collect()}
    return rows


LONG = " ".join(f"w{k}" for k in range(250))
ROWS = [
    (1, LONG, "a"), (2, LONG, "a"), (2, LONG, "a"), (None, LONG, "b"), (3, None, None), (4, "", ""), (5, "X" * 50, "a"), (6, "the " * 400, "b"),
    (7, LONG + " $5", "b"), (8, "A B C # d", None), (9, "\n\t ", "c"), (10, " é " * 300, "c"), (11, LONG + " " + LONG + " " + LONG, "a"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (5, 0, 1), (None, 1, 1), (6, None, 1), (11, 1, None), (99, 1, 1)]


def tables(spark, rows=ROWS, labels=LABELS):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, mask string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_edge_rows_against_brute_force(spark):
    docs, labels = tables(spark)
    got = held(audit.interactions(docs, labels))
    assert got == brute_force(ROWS, LABELS)
    assert len(got) == 4 * 600


def test_empty_tables(spark):
    docs, labels = tables(spark)
    assert audit.interactions(docs.limit(0), labels).collect() == []
    assert held(audit.interactions(docs, labels.limit(0))) == brute_force(ROWS, [])


def test_fields_never_overflow():
    """Sums at the edge of a byte, of a part in which every document has the same outcome."""
    import pyarrow as pa

    for n in (255, 256, 65535, 65536, 1 << 40):
        table = pa.table({"part": ["p", "p"], "mask": [31, 0], "good": [True, False], "toxic": [False, True], "n": [n, 3]})
        rows = audit.step_counts(table).to_pylist()
        assert all(r["removed"] + r["redundant"] == n and r["kept"] == 3 and r["shapley"] == 24 * n for r in rows)
        assert all(r["good_lost"] == r["removed"] and r["toxic_lost"] == 0 for r in rows)


def test_wide_integer_holds_all_outcomes():
    for mask in range(32):
        fields = audit.unpack(audit.wide(mask, 16), 16)
        assert fields == [f for step in audit.outcomes(mask) for f in step]


def test_query_against_brute_force(spark, folder):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    assert held(catalog.op12_filter_audit(spark, folder)) == brute_force(docs, labels)


def test_copies_are_not_gathered(spark):
    """The lookup of a text's first holder is keyed by digest and id, so copies spread over tasks."""
    docs, labels = tables(spark)
    plan = audit.mask_counts(docs, labels, "text", "doc_id", "source")._jdf.queryExecution().analyzed().toString()
    assert "Window" not in plan and "collect" not in plan
