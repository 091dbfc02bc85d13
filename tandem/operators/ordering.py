"""Global order without a global sort: running totals and exact quantiles.

Running totals cut the range of distinct values at approximate quantiles, total
each slice, and do ordered work only inside a slice; equal values are merged into
one row before, so a value shared by a third of the table is a single row.
Quantiles order only what lies in narrow brackets around the asked ranks.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tandem.session import stage


def slice_count(spark: SparkSession) -> int:
    """Slices follow the session's shuffle parallelism."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slice_bounds(df: DataFrame, columns, slices: int) -> dict[str, list[float]]:
    """Approximate quantiles per column: one pass, at most ``slices`` numbers each."""
    probs = [i / slices for i in range(1, slices)]
    # NaN is no number to cut at.
    row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), probs, 10 * slices).alias(c)
                   for c in columns]).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def with_slices(df: DataFrame, bounds: dict[str, list[float]], suffix: str = "_slice") -> DataFrame:
    """Add ``<column>_slice``; slice k holds values in [bound k, bound k+1)."""
    columns = list(bounds)
    cut = Bucketizer(
        inputCols=[f"{c}{suffix}_in" for c in columns],
        outputCols=[f"{c}{suffix}" for c in columns],
        splitsArray=[[float("-inf"), *(b or [0.0]), float("inf")] for b in bounds.values()],
        handleInvalid="keep",
    )
    doubled = df.withColumns({f"{c}{suffix}_in": F.col(c).cast("double") for c in columns})
    out = cut.transform(doubled).drop(*[f"{c}{suffix}_in" for c in columns])
    return out.withColumns({f"{c}{suffix}": F.col(f"{c}{suffix}").cast("int") for c in columns})


def running_totals(df: DataFrame, value: str, measures: dict[str, Column],
                   groups: tuple[str, ...] = (), slices: int | None = None,
                   descending: bool = False) -> DataFrame:
    """Per distinct ``value``: each measure, and its total over the values before it.

    Returns ``groups, value, m, m_before`` for every measure ``m`` (summed); before
    means smaller, or larger with ``descending``. The rows are read once.
    """
    known = df.where(F.col(value).isNotNull())
    state = stage(known.groupBy(*groups, value).agg(*[F.sum(m).alias(name) for name, m in measures.items()]), "per-value")
    return totals_before(state, value, tuple(measures), groups, slices, descending).drop(*[f"{n}_all" for n in measures])


def totals_before(state: DataFrame, value: str, measures: tuple[str, ...], groups: tuple[str, ...] = (),
                  slices: int | None = None, descending: bool = False) -> DataFrame:
    """Running totals of a stored table with one row per group and ``value``.

    Adds ``m_before`` and ``m_all``, the total of the group, for every measure ``m``.
    """
    direction = F.desc if descending else F.asc
    slices = slices or slice_count(state.sparkSession)
    cut = with_slices(state, slice_bounds(state, [value], slices), "_slice").withColumnRenamed(f"{value}_slice", "slice")
    per_slice = cut.groupBy(*groups, "slice").agg(*[F.sum(n).alias(f"{n}_slice") for n in measures])

    # At most (groups x slices) rows are ordered here.
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(direction("slice")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(*groups, "slice", *[c for n in measures for c in (
        F.coalesce(F.sum(f"{n}_slice").over(earlier), F.lit(0)).alias(f"{n}_offset"), F.sum(f"{n}_slice").over(whole).alias(f"{n}_all"))])

    inside = (Window.partitionBy(*groups, "slice").orderBy(direction(value))
              .rowsBetween(Window.unboundedPreceding, -1))
    ordered = cut.withColumns({f"{n}_inside": F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in measures})
    joined = ordered.join(offsets, [*groups, "slice"])
    return joined.select(
        *groups, value,
        *[c for n in measures for c in
          (F.col(n), (F.col(f"{n}_offset") + F.col(f"{n}_inside")).alias(f"{n}_before"), F.col(f"{n}_all"))])


#: A sketch misses a rank by one in so many rows at most.
SKETCH_ACCURACY = 10_000
#: Brackets around a rank, in shares of the rows to either side.
BRACKETS = (2 / SKETCH_ACCURACY, 0.02, 1.0)


def sketches(columns, probs) -> list[Column]:
    """Aggregates, one per column: its known values counted, and the bounds of brackets around the asked ranks.

    They merge like any aggregate, so they can ride along with others in one scan.
    """
    asked = [x for p in probs for w in BRACKETS for x in (max(0.0, p - w), min(1.0, p + w))]
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None))
    return [F.struct(F.count(value(c)).alias("n"), F.percentile_approx(value(c), asked, SKETCH_ACCURACY).alias("bounds")).alias(f"sketch_{c}")
            for c in columns]


def exact_quantiles(df: DataFrame, columns, probs, sketched=None) -> DataFrame:
    """Exact linear-interpolation quantiles: rows of ``(column, prob, value)``.

    A mergeable rank sketch brackets every asked rank, for all columns in one scan; a second scan counts what
    lies between the brackets and the distinct values inside them. A rank that its bracket missed is looked for
    again in the next wider one, the last of which holds all rows, so values are exact whatever the sketch does.
    Nulls and NaN are skipped. ``sketched`` is a row of ``sketches`` taken before.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    if sketched is None:
        sketched = df.agg(*sketches(columns, probs)).first()
    known = {c: sketched[f"sketch_{c}"] for c in columns if sketched[f"sketch_{c}"]["n"]}
    # A bracket has to reach a row beyond the rank on either side.
    level = {(c, p): next(k for k, w in enumerate(BRACKETS) if w == 1.0 or w * s["n"] >= 2) for c, s in known.items() for p in probs}
    found: dict[tuple[str, float], float] = {}
    while left := {key: k for key, k in level.items() if key not in found}:
        brackets: dict[str, list[tuple[float, float]]] = {}
        for (c, p), k in left.items():
            at = 2 * (len(BRACKETS) * probs.index(p) + min(k, len(BRACKETS) - 1))
            brackets.setdefault(c, []).append(tuple(known[c]["bounds"][at : at + 2]))
        found |= _inside_brackets(df, {c: s["n"] for c, s in known.items()}, brackets, list(left))
        level = {key: k + 1 for key, k in left.items()}
    rows = [(c, p, v) for (c, p), v in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def _inside_brackets(df: DataFrame, n: dict[str, int], brackets: dict[str, list[tuple[float, float]]], asked: list[tuple[str, float]]) -> dict:
    """Value of each asked (column, prob) whose ranks lie in a bracket."""
    bounds = {}
    for c, pairs in brackets.items():
        edges: list[float] = []
        for low, high in sorted(pairs):
            beyond = math.nextafter(high, math.inf)
            if edges and low <= edges[-1]:
                edges[-1] = max(edges[-1], beyond)
            else:
                edges += [low, beyond]
        bounds[c] = edges
    # Slices 2 k + 1 are the brackets, the even ones lie between them.
    cut = with_slices(df.select(*bounds), bounds)
    cells = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{c}_slice").alias("segment"), F.col(c).cast("double").alias("x")) for c in bounds])
    cells = cut.select(F.explode(cells).alias("cell")).select("cell.*").where(F.col("x").isNotNull() & ~F.isnan("x"))
    cells = cells.withColumn("value", F.when(F.col("segment") % 2 == 1, F.col("x")))
    counted = stage(cells.groupBy("column", "segment", "value").agg(F.count("*").alias("n")), "brackets")
    per_segment: dict[str, dict[int, int]] = {}
    for r in counted.groupBy("column", "segment").agg(F.sum("n").alias("n")).collect():
        per_segment.setdefault(r["column"], {})[r["segment"]] = r["n"]
    targets, ranks = [], {}
    for c, p in asked:
        place = (n[c] - 1) * p
        ranks[c, p] = math.floor(place), math.ceil(place), place - math.floor(place)
        for rank in set(ranks[c, p][:2]):
            before = 0
            for segment, held in sorted(per_segment.get(c, {}).items()):
                if before <= rank < before + held and segment % 2:
                    targets.append((c, segment, rank - before, rank))
                before += held
    if not targets:
        return {}
    wanted = df.sparkSession.createDataFrame(sorted(set(targets)), "column string, segment int, inside long, rank long")
    window = Window.partitionBy("column", "segment").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ordered = counted.where("value is not null").withColumn("start", F.coalesce(F.sum("n").over(window), F.lit(0)))
    hits = ordered.join(F.broadcast(wanted), ["column", "segment"]).where("inside >= start and inside < start + n")
    at = {(r["column"], r["rank"]): r["value"] for r in hits.select("column", "rank", "value").collect()}
    return {(c, p): at[c, low] + (at[c, high] - at[c, low]) * weight
            for (c, p), (low, high, weight) in ranks.items() if (c, low) in at and (c, high) in at}


def quantile_values(df: DataFrame, column: str, probs) -> list[float]:
    """The same for one column as plain numbers (one per asked probability)."""
    found = {r["prob"]: r["value"]
             for r in exact_quantiles(df, [column], probs).collect()}
    return [found[float(p)] for p in probs if float(p) in found]


def numbered(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """Number the distinct ``order`` values of each group from 0, at any size.

    The table is range-partitioned and written with its piece numbers, which are
    then fixed; each piece is numbered on its own and shifted by the earlier ones.
    """
    pieces = stage(df.select(group, order).repartitionByRange(slice_count(df.sparkSession), group, order)
                   .withColumn("slice", F.spark_partition_id()), "pieces")
    earlier = (Window.partitionBy(group).orderBy("slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = pieces.groupBy(group, "slice").agg(F.count("*").alias("n")).select(
        group, "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy(group, "slice").orderBy(order)) - 1
    return pieces.withColumn("place", place).join(offsets, [group, "slice"]).select(
        group, order, (F.col("place") + F.col("offset")).cast("int").alias(name))


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
