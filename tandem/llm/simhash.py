"""SimHash fingerprints of word shingles, and near copies within a few bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tandem.llm.common import ascii_lower, packed, text_of, unpacked, words
from tandem.llm.linking import connect
from tandem.session import stage

#: Shingle hashes that are spread into bits at once: 64 bytes each.
CHUNK = 1 << 18


def shingle_hashes(text: Column, size: int) -> Column:
    """XXH64 (seed 42, UTF-8) of each run of ``size`` words; a shorter text is one run; none without words."""
    listed = words(ascii_lower(text))
    run = lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - (size - 1))), lambda i: F.xxhash64(F.array_join(F.slice(w, i, size), " "))
    )
    # The words are bound to a lambda's variable once, or every shingle would split the text again.
    return F.element_at(F.transform(F.array(listed), lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(run(w))), 1)


@F.pandas_udf(T.LongType())
def majority_bits(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The bits set in over half of each row's hashes. Long rows are read in chunks, so memory stays bounded."""
    for batch in hashes:
        out = np.zeros(len(batch), np.uint64)
        for row, values in enumerate(batch.to_numpy()):
            if len(values) == 0:
                continue
            counts = np.zeros(64, np.int64)
            for k in range(0, len(values), CHUNK):
                part = np.ascontiguousarray(values[k : k + CHUNK], "<i8").view(np.uint8).reshape(-1, 8)
                counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            bits = np.packbits(2 * counts > len(values), bitorder="little")
            out[row] = bits.view("<u8")[0]
        yield pd.Series(out.view(np.int64))


def block_keys(mark: Column, distance: int, blocks: int) -> Column:
    """Keys of which marks within ``distance`` bits share at least one.

    The mark is cut into ``blocks`` pieces. At most ``distance`` of them can differ, so some choice of
    blocks - distance pieces agrees; every choice is a key.
    """
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    keys = []
    for n, chosen in enumerate(combinations(masks, blocks - distance)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(n), mark.bitwiseAND(F.lit(signed))))
    return F.array(*keys)


def near_copies(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 4, distance: int = 4, blocks: int = 7, carry: list[str] | None = None
) -> DataFrame:
    """Input columns (those in ``carry``, if given), ``fingerprint`` (16 hex digits), ``component_id``, the smallest id reachable by links,
    and ``first``, true for one row of each component: one that has that id, if there is any.

    Documents are linked when their fingerprints differ in at most ``distance`` bits. Equal fingerprints are one
    node, so copies cost nothing; fingerprints that share a block key are verified bit by bit. More ``blocks`` make
    keys longer and more numerous: with 7 blocks and 4 bits there are 35 keys of 27 bits.

    A null or wordless text has fingerprint zero and links like any other. Rows without an id get a component if a
    linked row has an id, else null. An empty table gives no rows. Input columns named like an output are replaced.
    """
    if not 0 <= distance < blocks <= 64:
        raise ValueError("distance must be less than blocks, and blocks at most 64")
    # The generator keeps the lambda expressions out of the Python function's arguments, where Spark can't evaluate them.
    hashed = packed(docs, carry, id_=F.col(doc_id), all=F.array(shingle_hashes(text_of(text), size)))
    hashed = hashed.select("row", "id_", F.explode("all").alias("hashes"))
    # The number is fixed by the written table, so it tells repeated rows apart.
    numbered = hashed.select("row", F.struct(F.col("id_").isNull().alias("none"), "id_", F.monotonically_increasing_id().alias("number")).alias("rank"), majority_bits("hashes").alias("mark"))
    marked = stage(numbered, "simhash")
    marks = stage(marked.groupBy("mark").agg(F.min("rank").alias("low")), "marks")
    members = marks.select(F.explode(block_keys(F.col("mark"), distance, blocks)).alias("bucket"), F.col("mark").alias("id"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    found = connect(members, lambda pairs: pairs.where(near))
    labelled = marks.join(found, marks["mark"] == found["id"], "left").select("mark", "low", F.coalesce("component", "mark").alias("part"))
    labelled = stage(labelled, "labelled")
    lowest = labelled.groupBy("part").agg(F.min("low").alias("low"))
    final = labelled.drop("low").join(lowest, "part").select("mark", "low")
    out = marked.join(final, "mark").select(
        "row", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), F.col("low.id_").alias("component_id"), (F.col("rank") == F.col("low")).alias("first")
    )
    return unpacked(out, "fingerprint", "component_id", "first")
