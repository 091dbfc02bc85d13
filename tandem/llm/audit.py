"""How text filters act on each other: what each removes, in every order, counted in wide packed integers."""

from __future__ import annotations

from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tandem.llm.common import bound, digest, text_of, words

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: One field per count, order and step in a packed integer.
COUNTS = ("kept", "removed", "redundant", "unique_fails")
STEPS = [(order, step) for order in ORDERS for step in range(1, len(FILTERS) + 1)]
OUTPUTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def outcomes(mask: int) -> list[tuple[int, int, int, int]]:
    """(kept, removed, redundant, unique fail), 0 or 1 each, of a text that fails the filters in ``mask``, at all 600 steps."""
    out = []
    for order, step in STEPS:
        fails = mask >> FILTERS.index(order[step - 1]) & 1
        earlier = any(mask >> FILTERS.index(f) & 1 for f in order[: step - 1])
        out.append((int(not earlier and not fails), int(fails and not earlier), int(fails and earlier), int(fails and mask & (mask - 1) == 0)))
    return out


OUTCOMES = [outcomes(mask) for mask in range(1 << len(FILTERS))]


def wide(mask: int, width: int) -> int:
    """All step outcomes of a mask in one integer, ``width`` bits a field."""
    return sum(flag << (width * k) for k, flag in enumerate(f for step in OUTCOMES[mask] for f in step) if flag)


def unpack(total: int, width: int) -> list[int]:
    """The fields of a sum of wide integers."""
    data = total.to_bytes((width * len(STEPS) * len(COUNTS) + 7) // 8, "little")
    size = width // 8
    return [int.from_bytes(data[k * size : (k + 1) * size], "little") for k in range(len(STEPS) * len(COUNTS))]


def step_counts(masks: pa.Table) -> pa.Table:
    """All 600 rows of one part from its counts of (mask, good, toxic), at most 128 rows.

    Fields take whole bytes, enough for all documents of the part, so no sum runs into the next field.
    """
    rows = masks.to_pylist()
    width = 8 * ((sum(r["n"] for r in rows).bit_length() + 7) // 8)
    packed = {r["mask"]: wide(r["mask"], width) for r in rows}
    total, good, toxic = (
        unpack(sum(r["n"] * packed[r["mask"]] for r in rows if chosen(r)), width)
        for chosen in (lambda r: True, lambda r: r["good"], lambda r: r["toxic"])
    )
    n, removed = len(COUNTS), COUNTS.index("removed")
    share = dict.fromkeys(FILTERS, 0)
    for k, (order, step) in enumerate(STEPS):
        share[order[step - 1]] += total[n * k + removed]
    columns = {
        "part": [rows[0]["part"]] * len(STEPS), "filter_order": [o for o, _ in STEPS], "step": [s for _, s in STEPS],
        **{c: total[j::n] for j, c in enumerate(COUNTS)},
        "good_lost": good[removed::n], "toxic_lost": toxic[removed::n], "shapley": [share[o[s - 1]] for o, s in STEPS],
    }
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(OUTPUTS)]
    return pa.table([pa.array(c, t) for c, t in zip(columns.values(), kinds)], names=list(columns))


def failures(text: Column) -> list[Column]:
    """Filters A to D on ``w`` (the words) and the text: short, repetitive, shouting, odd signs."""
    w, size = F.col("w"), F.col("n_words")
    return [
        size < 200, 100 * F.size(F.array_distinct(w)) < 50 * size,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text), text.rlike(r"[#$%&*|]"),
    ]


def masked(docs: DataFrame, text: str, doc_id: str, part: str) -> DataFrame:
    """(id, part, key, mask): the text's digest and the filters A to D that it fails, a bit each."""
    body = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_of(text).alias("body"))
    read = bound(body.select("id", "part", "body", digest(F.col("body")).alias("key")), w=words(F.col("body")))
    read = read.withColumn("n_words", F.size("w"))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(failures(F.col("body")))), F.lit(0))
    return read.select("id", "part", "key", mask.alias("mask"))


def label_flags(labels: DataFrame, doc_id: str) -> DataFrame:
    """(id, good, toxic) once per labelled id: true if any of its label rows says so."""
    said = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    return labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(said("quality").alias("good"), said("toxic").alias("toxic"))


def mask_counts(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, part: str) -> DataFrame:
    """(part, mask, good, toxic, n): all five filters' masks, counted.

    A text's first holder is looked up by digest and id together, so a group of copies is spread over its ids; texts
    themselves are not shuffled.
    """
    read = masked(docs, text, doc_id, part)
    first = read.groupBy("key").agg(F.min("id").alias("id")).where("id is not null").withColumn("first", F.lit(True))
    told = read.join(first, ["key", "id"], "left").join(label_flags(labels, doc_id), "id", "left")
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return told.select("part", (F.col("mask") + copy).alias("mask"), flag("good"), flag("toxic")).groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))


def interactions(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    Five filters are run over the texts of every part in all 120 orders. They fail a text A: of under 200 words, B: whose
    distinct words are under half of its words, C: with capitals A-Z for over 2 % of its characters, D: with any of
    ``#$%&*|``, E: that a smaller id holds as well, anywhere in the table. Words lie between white space. Per step:
    documents kept after it, removed by it, failing its filter but removed before, failing no other filter, and removed
    ones that ``labels`` calls good (quality 1) or toxic; ``shapley`` is what its filter removes over all orders.

    What a text fails is one of 32 masks. A mask's outcomes at all 600 steps are the fields of one wide integer; these
    are added up per part, as often as the mask occurs, and unpacked.

    A null text is empty, a null part is the empty string. A row without id is nobody's copy, nor has it any label;
    rows with equal id and text are no copies of each other. An id counts as good or toxic if any of its label rows
    says so. Other columns are not read. An empty table gives no rows.
    """
    counted = mask_counts(docs, labels, text, doc_id, part)
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in OUTPUTS)
    return counted.groupBy("part").applyInArrow(step_counts, schema)
