"""Documents packed into fixed-length sequences by shortest-pack-first over the histogram of lengths."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tandem.llm.common import local_rows, packed, point, ranked, slice_bits, text_of, unpacked
from tandem.llm.tokens import encoder
from tandem.session import stage

#: Pieces in one Arrow batch.
BATCH_PIECES = 4096


def cut_documents(docs: DataFrame, path: str, size: int, end_id: int, text: str, carry: list[str] | None, with_ids: bool) -> DataFrame:
    """(row, start, length, ids_crc32, doc_tokens[, ids]): each document's ids and the end id, in pieces of ``size``."""
    ending = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            rows, made = batch.column("row"), []

            def flush(made: list) -> pa.RecordBatch:
                index, start, length, crc, total, ids = zip(*made)
                columns = [rows.take(pa.array(index)), pa.array(start), pa.array(length), pa.array(crc), pa.array(total)]
                if with_ids:
                    flat = np.frombuffer(b"".join(ids), "<i4")
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)).astype(np.int32)), pa.array(flat)))
                return pa.RecordBatch.from_arrays(columns, names)

            for k, value in enumerate(batch.column("text")):
                data = encode(value.as_py()) + ending
                for at in range(0, len(data), 4 * size):
                    part = data[at : at + 4 * size]
                    made.append((k, at // 4, len(part) // 4, zlib.crc32(part), len(data) // 4, part if with_ids else b""))
                    if len(made) == BATCH_PIECES:
                        yield flush(made)
                        made = []
            if made:
                yield flush(made)

    names = ["row", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    whole = packed(docs, carry, text=text_of(text))
    schema = T.StructType([whole.schema["row"], *[T.StructField(n, T.LongType()) for n in names[1:5]], *[T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids])
    return whole.mapInArrow(run, schema)


def fill(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a pack, number of such packs): longest lengths first, each into the packs that are shortest so far.

    Equal packs are counted, never listed, so the work follows the number of lengths and patterns.
    """
    open_packs: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in open_packs.items() if packs), default=0)
            if room < length:
                # Nothing fits: each new pack takes as many as it holds before the next is opened.
                take = min(left, size // length)
                made = max(1, left // take)
                grown = open_packs[size - take * length]
                grown[(length,) * take] = grown.get((length,) * take, 0) + made
                left -= take * made
                continue
            pattern, there = next(iter(open_packs[room].items()))
            take = min(left, there)
            if take == there:
                del open_packs[room][pattern]
            else:
                open_packs[room][pattern] = there - take
            grown = open_packs[room - length]
            grown[(*pattern, length)] = grown.get((*pattern, length), 0) + take
            left -= take
    return sorted((p, n) for packs in open_packs.values() for p, n in packs.items())


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): where the pieces of a length go, by their rank."""
    used, base, out = defaultdict(int), 0, []
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            out.append((length, used[length], used[length] + count, base, offset))
            used[length] += count
            offset += length
        base += count
    return out


def pack(
    docs: DataFrame, path: str, size: int = 1024, end_id: int = 0, text: str = "text", doc_id: str = "doc_id",
    carry: list[str] | None = None, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: input columns (those in ``carry``, if given), ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, if asked, ``ids``.

    Every document becomes its ids and ``end_id``, cut into pieces of ``size``; only the last can be shorter. The
    histogram of piece lengths, at most ``size`` numbers, is filled shortest pack first on the driver; pieces then join
    the patterns by their rank among the pieces of their length. No sequence is longer than ``size``.

    A null or empty text is the end id alone. Repeated rows are packed as often as they occur. An empty table gives no
    rows. Input columns named like an output are replaced.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    outputs = ["start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    key = ["key_"] if carry is not None and doc_id not in carry else []
    kept = None if carry is None else [*carry]
    source = docs.withColumn("key_", F.col(doc_id)) if key else docs
    pieces = stage(cut_documents(source, path, size, end_id, text, None if kept is None else [*kept, *key], with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = places(fill(histogram, size))
    schema = pa.schema([("length", pa.int64()), ("first", pa.int64()), ("end", pa.int64()), ("sequence", pa.int64()), ("offset", pa.int64())])
    where = local_rows(docs.sparkSession, schema, list(zip(*table)) or [[]] * 5)
    name = key[0] if key else doc_id
    at = point(F.concat_ws("|", F.col("row").getField(name).cast("string"), F.col("start").cast("string")))
    by_rank = ranked(pieces.withColumn("at", at).withColumn("tie", F.hash("ids_crc32", "doc_tokens")), "length", "at", slice_bits(sum(histogram.values())), ("tie",))
    found = by_rank.join(F.broadcast(where), "length").where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    found = found.withColumn("sequence_id", F.col("sequence") + F.col("rank") - F.col("first"))
    return unpacked(found, *outputs, "sequence_id", "offset").drop(*key)
