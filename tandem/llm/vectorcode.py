"""Vectors as short codes: k-means codebooks for each part of a vector, through dictionaries of its values."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tandem.llm.common import packed, unpacked
from tandem.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors that share a block's dictionaries, and vectors whose distances are summed up at once.
BLOCK, STRIP = 4096, 512


def usable(vector) -> "F.Column":
    """Neither null nor with a null, infinite or undefined component."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))


def integers(vectors: list[np.ndarray], dims: int) -> np.ndarray:
    """floor(SCALE * x), a row a vector; shorter ones end in zeros.

    Numbers are kept in the range in which no distance of two vectors leaves 63 bits.
    """
    out = np.zeros((len(vectors), dims), np.float64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    most = math.isqrt((1 << 63) // max(dims, 1)) // 2 - 1
    return np.clip(np.floor(out * SCALE), -most, most).astype(np.int64)


def to_block(whole: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(dictionary sizes, distinct values, codes) of vectors: per dimension its values in order, and each vector's place among them."""
    sizes, values, codes = [], [], []
    for column in whole.T:
        found, place = np.unique(column, return_inverse=True)
        sizes.append(len(found))
        values.append(found)
        codes.append(place)
    return np.array(sizes, "<i4").tobytes(), np.concatenate(values).astype("<i8").tobytes(), np.stack(codes).astype("<u2").tobytes()


def nearest(sizes: bytes, values: bytes, codes: bytes, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts x vectors) nearest entries and their squared distances; ``books``: parts x entries x places.

    For every dimension the squared differences of each distinct value to all entries are tabulated; a vector's
    distances are sums of the table rows that its codes name.
    """
    parts, entries, places = books.shape
    size = np.frombuffer(sizes, "<i4")
    first = np.cumsum(size) - size
    value = np.frombuffer(values, "<i8")
    code = np.frombuffer(codes, "<u2").reshape(len(size), -1)
    n = code.shape[1]
    span = max(int(abs(value).max(initial=0)), int(abs(books).max(initial=0)))
    kind = np.int32 if places * (2 * span) ** 2 < 1 << 31 else np.int64
    best, distance = np.zeros((parts, n), np.int64), np.zeros((parts, n), np.int64)
    for p in range(parts):
        tables = []
        for j in range(places):
            d = p * places + j
            difference = value[first[d] : first[d] + size[d], None].astype(kind) - books[p, :, j].astype(kind)
            tables.append(difference * difference)
        for k in range(0, n, STRIP):
            total = np.zeros((min(STRIP, n - k), entries), kind)
            for j, table in enumerate(tables):
                total += table[code[p * places + j, k : k + STRIP]]
            best[p, k : k + STRIP] = total.argmin(axis=1)
            distance[p, k : k + STRIP] = total.min(axis=1)
    return best, distance


def decoded(sizes: bytes, values: bytes, codes: bytes) -> np.ndarray:
    """The vectors of a block, a row a dimension."""
    size = np.frombuffer(sizes, "<i4")
    first = np.cumsum(size) - size
    return np.frombuffer(values, "<i8")[np.frombuffer(codes, "<u2").reshape(len(size), -1) + first[:, None]]


def block_writer(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            edges, flat = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
            for k in range(0, batch.num_rows, BLOCK):
                end = min(k + BLOCK, batch.num_rows)
                whole = integers([flat[edges[i] : edges[i + 1]] for i in range(k, end)], dims)
                rows = batch.column("row").slice(k, end - k)
                held = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
                yield pa.RecordBatch.from_arrays([held, *[pa.array([c], pa.binary()) for c in to_block(whole)]], ["rows", "sizes", "values", "codes"])

    return run


def blocks_of(kept: DataFrame, dims: int) -> DataFrame:
    """(rows, sizes, values, codes): input rows in blocks, with their vectors as dictionaries and codes; stored."""
    schema = T.StructType([T.StructField("rows", T.ArrayType(kept.schema["row"].dataType)), *[T.StructField(c, T.BinaryType()) for c in ("sizes", "values", "codes")]])
    return stage(kept.select("row", "vector").mapInArrow(block_writer(dims), schema), "vector-blocks")


def adder(model):
    """A mapInArrow function: per task, each entry's number of parts and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = model.value
        parts, entries, places = books.shape
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, places), np.int64)
        for batch in batches:
            for sizes, values, codes in zip(*[[x.as_py() for x in batch.column(c)] for c in ("sizes", "values", "codes")]):
                best, _ = nearest(sizes, values, codes, books)
                whole = decoded(sizes, values, codes)
                for p in range(parts):
                    count[p] += np.bincount(best[p], minlength=entries)
                    order = np.argsort(best[p], kind="stable")
                    used, start = np.unique(best[p][order], return_index=True)
                    total[p, used] += np.add.reduceat(whole[p * places : (p + 1) * places, order], start, axis=1).T
        part, entry = np.nonzero(count)
        if len(part):
            sums = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * places, pa.int32()), pa.array(total[part, entry].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(count[part, entry]), sums], ["part", "entry", "n", "sums"])

    return run


def improved(spark: SparkSession, blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by floor(sum / count) of the parts nearest to it; unused ones stay."""
    places = books.shape[2]
    sums = blocks.select("sizes", "values", "codes").mapInArrow(adder(spark.sparkContext.broadcast(books)), "part long, entry long, n long, sums array<long>")
    table = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(places)]).toArrow()
    out = books.copy()
    part, entry = table["part"].to_numpy(), table["entry"].to_numpy()
    for j in range(places):
        out[part, entry, j] = table[f"s{j}"].to_numpy() // table["n"].to_numpy()
    return out


def coder(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                best, distance = nearest(*[batch.column(c)[k].as_py() for c in ("sizes", "values", "codes")], model.value)
                rows = batch.column("rows")[k].values
                codes = [row.tobytes().hex() for row in best.T.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([rows, pa.array(codes), pa.array(distance.sum(axis=0))], ["row", "code", "error"])

    return run


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label", rounds: int = ROUNDS, carry: list[str] | None = None
) -> DataFrame:
    """Input columns (those in ``carry``, if given), ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Components become floor(1024 * x). A vector is cut into four equal parts, and each part is coded by the nearest of
    256 entries (least squared distance, then lowest index) of its place's codebook: two hex digits. Codebooks begin
    as the parts of the vectors with the smallest ids and are improved ``rounds`` times, an entry becoming the floor of
    its parts' mean; unused entries stay. ``error`` is the squared distance of a vector to its entries, ``label_error``
    its sum over rows of equal label (null ones together), both at most 2**63 - 1.

    Vectors are stored once, in blocks: per dimension a dictionary of the block's distinct values, and codes of two
    bytes. Memory follows the block and the 256 entries, never the table or the range of values.

    Rows whose vector is null or has a null or non-finite component are left out. Vectors shorter than the longest, or
    than a multiple of four, end in zeros; components beyond what 63 bits allow for a distance count as that bound
    (2**18 at 32 dimensions). Rows without id come last, and equal ids by vector, when codebooks begin; fewer than 256
    rows give shorter codebooks. Repeated rows get equal codes. An empty table gives no rows. Input columns named like
    an output are replaced.
    """
    spark = vectors.sparkSession
    kept = packed(vectors, carry, id=F.col(vec_id), label=F.col(label), vector=F.col(vector)).where(usable(F.col("vector")))
    kept = kept.withColumn("row", F.struct("row", "label"))
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    dims = max(PARTS, -(-longest // PARTS) * PARTS)
    begin = kept.orderBy(F.col("id").asc_nulls_last(), "vector").select("vector").limit(ENTRIES).collect()
    blocks = blocks_of(kept, dims)
    books = integers([np.array(r["vector"], np.float64) for r in begin], dims).reshape(len(begin), PARTS, dims // PARTS).transpose(1, 0, 2)
    books = np.ascontiguousarray(books)
    for _ in range(rounds if len(begin) else 0):
        books = improved(spark, blocks, books)
    schema = T.StructType([T.StructField("row", blocks.schema["rows"].dataType.elementType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = stage(blocks.mapInArrow(coder(spark.sparkContext.broadcast(books)), schema), "vector-codes")
    coded = coded.select(F.col("row.row").alias("row"), F.col("row.label").alias("label"), "code", "error")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    totals = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(20,0)")), most).cast("long").alias("label_error"))
    both = coded.alias("c").join(totals.alias("t"), F.col("c.label").eqNullSafe(F.col("t.label"))).select("c.*", "t.label_error")
    return unpacked(both.withColumn("codebooks_sha256", F.lit(books_digest(books))), "code", "error", "label_error", "codebooks_sha256")
