"""Expressions and small helpers that several operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space that separates words, and everything that is neither digit, a-z nor above ASCII.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), 0x20]))
NON_WORD = "".join(chr(c) for c in range(0x80) if not chr(c).isdigit() and not chr(c).islower())
POINT_BITS = 60


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("*",)))


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts without other letters take the shorter way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column, gaps: str = SPACES) -> Column:
    """Words of a text between runs of the characters in ``gaps``; none are empty."""
    inner = F.btrim(text, F.lit(gaps))
    some = "[" + "".join(f"\\x{ord(c):02X}" for c in gaps) + "]+"
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, some))


def digest(text: Column) -> Column:
    """16 bytes that stand for a text in joins."""
    return F.unhex(F.md5(text))


def unsigned_crc32(data: Column) -> Column:
    return F.crc32(data.cast("binary")).cast("long")


def point(key: Column) -> Column:
    """A stable place for a key on a ring of 2**60 points."""
    return F.conv(F.substring(F.md5(key), 1, POINT_BITS // 4), 16, 10).cast("long")


def packed(docs: DataFrame, carry: list[str] | None = None, **columns: Column) -> DataFrame:
    """Input columns (those in ``carry``, else all) as one struct ``row``, beside working columns that can't clash with them."""
    row = F.struct(*[docs[f"`{c}`"] for c in (docs.columns if carry is None else carry)])
    return docs.select(row.alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, *outputs: str) -> DataFrame:
    """Input columns, then the outputs. An input column named like an output is replaced by it."""
    taken = {name.lower() for name in outputs}
    kept = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col("row").getField(c).alias(c) for c in kept], *[F.col(c) for c in outputs])


def bound(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once.

    A plain column may be pasted into every lambda that reads it and then computed for each element; behind a
    generator it is a value.
    """
    once = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", once.alias("once_")).select("*", *[F.col("once_").getField(n).alias(n) for n in columns]).drop("once_")


def local_rows(spark: SparkSession, schema: pa.Schema, columns: list) -> DataFrame:
    """A table of driver-made columns."""
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema))


def slice_bits(rows: int, per_slice: int = 4096, least: int = 0) -> int:
    """Bits of a point that cut ``rows`` rows into slices of about ``per_slice``."""
    return max(least, (max(rows, 1) // per_slice).bit_length())


def ranked(df: DataFrame, group: str, at: str, bits: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``rank``, gapless from 0 in each group, in order of the point ``at``.

    No group is sorted as a whole: slices of the point are counted, each slice is ranked by itself, and the
    counts of the slices before it are added.
    """
    cut = df.withColumn("slice", F.shiftright(F.col(at), POINT_BITS - bits) if bits else F.lit(0).cast("long"))
    before = Window.partitionBy(group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(group, "slice").agg(F.count(F.lit(1)).alias("in_slice"))
        .select(group, "slice", F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy(group, "slice").orderBy(at, *ties)
    return (
        cut.withColumn("in_slice", F.row_number().over(inside).cast("long") - 1)
        .join(offsets, [group, "slice"])
        .withColumn("rank", F.col("offset") + F.col("in_slice"))
        .drop("slice", "offset", "in_slice")
    )
