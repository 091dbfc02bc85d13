"""Connected components of links, found on executors only.

Nodes are any ordered values. Links, labels and buckets stay in tables; nothing but counts reaches the driver.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tandem.session import stage

#: Sketches are sent to pairs and members in so many parts, one after the other, so that only one part is shuffled at a time.
SLICES = 6
#: Members of a bucket's largest component that all members outside it are held against, while the pairs that straddle such
#: components of CROWD and more would be over PAIRS a member.
HEADS, CROWD, PAIRS = 4, 8, 16


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """One half step of the alternating star algorithm on links (a, b) with a > b.

    Large star: every neighbour above a node is hung on the node's smallest neighbour.
    Small star: a node and its neighbours below it are hung on the smallest of them.
    The minimum of a node is an aggregate and a join, so a hub is neither sorted nor collected.
    """
    if larger:
        near = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links
    low = near.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    hung = near.join(low, "a")
    if larger:
        return hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    below = hung.where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return below.union(low.select("a", F.col("low").alias("b"))).distinct()


def _is_done(links: DataFrame) -> bool:
    """True if every node has one link to a smaller one, or only links from larger ones."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("up")).union(links.select(F.col("b").alias("id"), F.lit(0).alias("up")))
    each = ends.groupBy("id").agg(F.sum("up").alias("up"), F.min("up").alias("under"))
    return each.where("up > 1 or (up > 0 and under = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of links (a, b); the component is its smallest node.

    Each round is written to the shared folder, so lost executors cost one round at most. No links: no rows.
    """
    ordered = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(ordered.distinct(), "links")
    while not _is_done(now):
        now = stage(_stars(_stars(now, True), False), "links")
    leaves = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)


def _straddling(members: DataFrame, possible: Callable[[str, str], Column] | None) -> DataFrame:
    """Distinct pairs (a, b), a < b, of members (bucket, id, component, main[, sketch]) in one bucket and two components.

    One of the two is always outside the bucket's largest component, ``main``, so members of that never meet each other,
    and no more pairs are looked at than a few times those that straddle.
    """
    columns = [c for c in members.columns if c not in ("bucket", "main")]
    beside = F.col("component") != F.col("main")
    x, y = (members.select("bucket", beside.alias(f"beside_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in columns]) for side in "xy")
    met = x.where("beside_x").join(y, "bucket")
    met = met.where((F.col("component_x") != F.col("component_y")) & (~F.col("beside_y") | (F.col("id_x") < F.col("id_y"))))
    if possible is not None:
        met = met.where(possible("sketch_x", "sketch_y"))
    return met.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def _parted(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members (bucket, id, a) of buckets with several components: their component, the bucket's largest one, ``main``, and its
    members there, ``crowd``."""
    labelled = shared.join(found, "id", "left").select("bucket", "id", "a", F.coalesce("component", "id").alias("component"))
    parts = labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    split = (
        parts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1").select("bucket", F.col("most.component").alias("main"), F.col("most.n").alias("crowd"))
    )
    return labelled.join(split, "bucket")


def _pairs(parted: DataFrame) -> int:
    """How many pairs of one bucket have a member outside its largest component, about."""
    each = parted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.first("crowd").alias("crowd"))
    return each.agg(F.sum(F.expr("n * (n - crowd)"))).first()[0] or 0


def _against_largest(parted: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of each member outside its bucket's largest component with HEADS members of that."""
    within = parted.where(F.col("component") == F.col("main"))
    heads = within.groupBy("bucket").agg(*[F.min_by("id", F.xxhash64(F.lit(k), "id")).alias(f"h{k}") for k in range(HEADS)])
    met = parted.where(F.col("component") != F.col("main")).join(heads, "bucket").select("id", F.explode(F.array_distinct(F.array(*[f"h{k}" for k in range(HEADS)]))).alias("head"))
    return met.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()


def _joined(found: DataFrame, more: DataFrame) -> DataFrame:
    """``found`` (id, component) with further links (a, b)."""
    return components(found.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))


def connect(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], sketches: DataFrame | None = None, possible: Callable[[str, str], Column] | None = None
) -> DataFrame:
    """(id, component) over members (bucket, id): nodes that share a bucket and pass ``verify`` are linked.

    ``verify`` takes distinct candidates (a, b), a < b, and returns those that are true links. First each bucket's
    members are held against its smallest one. While pairs across large components would outgrow the members, those outside
    a bucket's largest component are held against some of its members. Where that leaves a bucket with several components,
    every pair that straddles two of them is verified as well, so no link is lost, yet a bucket of copies or near copies
    never becomes all its pairs. Nodes without any link are not returned.

    With ``sketches`` (id, sketch), candidates are only pairs whose sketches are ``possible``; that must hold for every
    true link. Straddling pairs are held against it where they meet, so the others are neither shuffled nor stored.
    """
    heads = stage(members.groupBy("bucket").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "heads")
    shared = stage(members.join(heads, "bucket"), "members")

    def sought(pairs: DataFrame) -> DataFrame:
        """Those of distinct pairs (a, b) that can be links."""
        if sketches is None:
            return pairs
        pieces = [pairs.where(F.pmod(F.hash("a"), F.lit(SLICES)) == k).join(sketches.toDF("a", "x"), "a").join(sketches.toDF("b", "y"), "b") for k in range(SLICES)]
        return functools.reduce(DataFrame.union, [stage(x.where(possible("x", "y")).select("a", "b"), "possible") for x in pieces])

    first = shared.where(F.col("id") != F.col("a")).select("a", F.col("id").alias("b")).distinct()
    found = stage(components(verify(sought(first)).select("a", "b")), "components")
    parted = stage(_parted(shared, found), "parted")
    if parted.isEmpty():
        return found
    # A bucket of near copies whose smallest member is unlike the rest would become all its pairs.
    crowded, most = parted.where(F.col("crowd") >= CROWD), None
    while True:
        size = _pairs(crowded)
        if size <= PAIRS * shared.count() or (most is not None and size > most / 2):
            break
        more = stage(verify(sought(_against_largest(crowded))).select("a", "b"), "verified")
        most, found = size, stage(_joined(found, more), "components")
        crowded = stage(_parted(crowded.select("bucket", "id", "a"), found), "parted")
    parted = parted.where(F.col("crowd") < CROWD).union(crowded.select(*parted.columns)).drop("crowd")
    # Pairs with a bucket's head were candidates before.
    others = parted.where(F.col("id") != F.col("a")).drop("a")
    pieces = [others]
    if sketches is not None:
        pieces = [others.where(F.pmod("bucket", F.lit(SLICES)) == k).join(sketches, "id") for k in range(SLICES)]
    made = [_straddling(x, possible) for x in pieces]
    straddling = made[0] if sketches is None else functools.reduce(DataFrame.union, [stage(x, "straddling") for x in made]).distinct()
    more = stage(verify(straddling).select("a", "b"), "verified")
    if more.isEmpty():
        return found
    return _joined(found, more)
