"""Consistent hashing with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tandem.llm.common import POINT_BITS, local_rows, packed, point, ranked, slice_bits, unpacked

#: The ring has 2**CELL_BITS cells; a virtual node sits at the end of one.
CELL_BITS = 14


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise. Of nodes that share a cell the smaller shard stays."""
    at: dict[int, int] = {}
    for shard in range(shards):
        for node in range(vnodes):
            cell = int(hashlib.md5(f"shard {shard} node {node}".encode()).hexdigest()[:15], 16) >> (POINT_BITS - CELL_BITS)
            at[cell] = min(shard, at.get(cell, shard))
    return sorted(at.items())


def capacities(rows: int, shards: int, spare: float) -> list[int]:
    """Rows each shard may hold: even shares, the first ones rounded up, times 1 + ``spare``."""
    even = [rows // shards + (s < rows % shards) for s in range(shards)]
    return [int(n * (1 + spare)) for n in even]


def walk(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Fill shards cell by cell, clockwise: (cell, first rank, end rank, shard, shard's rows before).

    A cell's rows go to the next node's shard while it has room; the rest continues to the next shards.
    """
    room, used, out, at = list(room), [0] * len(room), [], 0
    for cell in sorted(counts):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        left, first, step = counts[cell], 0, at
        while left:
            shard = nodes[step % len(nodes)][1]
            take = min(left, room[shard])
            if take:
                out.append((cell, first, first + take, shard, used[shard]))
                room[shard] -= take
                used[shard] += take
                first, left = first + take, left - take
            step += 1
    return out


def shard(docs: DataFrame, key: Column, shards: int = 8, vnodes: int = 128, spare: float = 0.0) -> DataFrame:
    """Input columns, ``shard`` int (0 to shards - 1) and ``slot`` long (gapless from 0 in each shard).

    Rows are counted per ring cell; the ring is walked once on those counts, which are at most 2**14 however large
    the table is; rows find their stretch of a cell by rank. With ``spare`` 0 shard counts differ by one at most;
    with more, a shard holds at most 1 + spare times its even share and fewer keys move on.

    Null keys are placed like the empty key. Equal keys are neighbours, and a key with more rows than a shard has room
    for continues clockwise like any other; rows that agree in key and in everything else are interchangeable. An
    empty table gives no rows. Input columns named shard or slot are replaced.
    """
    if shards < 1 or vnodes < 1 or spare < 0:
        raise ValueError("shards and vnodes must be at least 1, spare at least 0")
    spark = docs.sparkSession
    whole = packed(docs, key=F.coalesce(key.cast("string"), F.lit(""))).withColumn("tie", F.xxhash64("row"))
    placed = whole.withColumn("at", point(F.col("key"))).withColumn("cell", F.shiftright("at", POINT_BITS - CELL_BITS).cast("int"))
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    rows = sum(counts.values())
    stretches = walk(counts, ring(shards, vnodes), capacities(rows, shards, spare))
    schema = pa.schema([("cell", pa.int32()), ("first", pa.int64()), ("end", pa.int64()), ("shard", pa.int32()), ("before", pa.int64())])
    table = local_rows(spark, schema, list(zip(*stretches)) or [[]] * 5)
    sliced = ranked(placed, "cell", "at", slice_bits(rows, least=CELL_BITS), ("tie",))
    found = (
        sliced.join(F.broadcast(table), "cell")
        .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
        .withColumn("slot", F.col("before") + F.col("rank") - F.col("first"))
    )
    return unpacked(found, "shard", "slot")
