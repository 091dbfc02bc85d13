"""Benchmark passages in documents, found through a positional inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tandem.llm.common import NON_WORD, ascii_lower, bound, digest, packed, text_of, unpacked, words
from tandem.session import stage


def terms_of(text: Column) -> Column:
    """Lower-case runs of digits, a-z and everything above ASCII."""
    return words(ascii_lower(text), NON_WORD)


def windows(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(window, item, terms): every run of ``size`` words of an item; a shorter item is one window, a wordless one none."""
    listed = items.select(F.col(item_id).cast("string").alias("item"), terms_of(text_of(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    cut = listed.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s"), size).alias("terms"))
    return cut.select(digest(F.array_join("terms", " ")).alias("window"), "item", "terms").distinct()


def probes(asked: DataFrame, frequency: DataFrame) -> DataFrame:
    """(window, t1, o1, t2, o2, size): each window's two rarest corpus terms and their offsets.

    A window with a term that the corpus lacks can't occur and gets no probe; one of a single word has no t2.
    """
    spread = asked.select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("o", "term"))
    known = spread.join(frequency, "term")
    order = Window.partitionBy("window").orderBy("n", "term", "o")
    ranked = known.select("*", F.row_number().over(order).alias("r"), F.count(F.lit(1)).over(Window.partitionBy("window")).alias("found"))
    chosen = ranked.where((F.col("found") == F.col("size")) & (F.col("r") <= 2))
    pick = lambda r, c: F.max(F.when(F.col("r") == r, F.col(c)))
    return chosen.groupBy("window").agg(
        pick(1, "term").alias("t1"), pick(1, "o").alias("o1"), pick(2, "term").alias("t2"), pick(2, "o").alias("o2"), F.max("size").alias("size")
    )


def build_index(docs: DataFrame, text: Column, wanted: DataFrame) -> DataFrame:
    """Postings (term, doc, at) of the wanted terms; ``doc`` is the digest of a text, so copies share postings."""
    # Selected before the explode: beside it, the digest would be computed once a word.
    keyed = docs.select(digest(text).alias("doc"), text.alias("body"))
    tokens = keyed.select("doc", F.posexplode(terms_of(F.col("body"))).alias("at", "term"))
    return tokens.join(wanted, "term", "left_semi").distinct()


def candidates(index: DataFrame, asked: DataFrame, slack: int) -> DataFrame:
    """(doc, window, start, exact): places where a window's two rarest terms stand within ``slack`` words of their
    distance in the phrase; ``exact`` where they stand at that distance.

    Windows that overlap share their pair of rarest terms, so the lists are intersected once per pair and distance.
    """
    pair = ["t1", "t2", "apart"]
    paired = asked.withColumn("apart", F.coalesce(F.col("o2") - F.col("o1"), F.lit(0))).withColumn("t2", F.coalesce("t2", "t1"))
    first = index.select(F.col("term").alias("t1"), "doc", F.col("at").alias("p1"))
    second = index.select(F.col("term").alias("t2"), "doc", F.col("at").alias("p2"))
    off = F.col("p2") - F.col("p1") - F.col("apart")
    met = (
        first.join(paired.select(*pair).distinct(), "t1").join(second, ["t2", "doc"]).where(F.abs(off) <= slack)
        .groupBy("doc", *pair, "p1").agg(F.max(off == 0).alias("exact"))
    )
    return met.join(paired.select("window", "o1", *pair), pair).select("doc", "window", (F.col("p1") - F.col("o1")).alias("start"), "exact")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, slack: int = 3, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", carry: list[str] | None = None,
) -> DataFrame:
    """Input columns (those in ``carry``, if given), ``n_words``, ``n_hit``, ``item_ids``, ``hits`` and ``n_near``.

    A window is ``size`` consecutive words of a benchmark item, or the whole of a shorter one. Corpus frequencies of
    the windows' terms choose each window's two rarest; their postings are stored; offset-adjusted position lists are
    intersected; what is left is compared word by word. ``hits`` are the exact phrase matches (first word, length);
    ``n_hit`` counts the words under any of them, ``item_ids`` their items, as sorted strings. ``n_near`` counts
    proximity matches that are no phrase: a window's two rarest terms, up to ``slack`` words off their distance in it.

    Null texts have no words. Repeated and equal texts share one set of postings and get equal results; items without
    words or id match nothing. Empty tables, on either side, give no hits. Input columns named like an output are
    replaced.
    """
    body = text_of(text)
    cut = windows(benchmark.where(F.col(item_id).isNotNull()), item_id, item_text, size)
    cut = stage(cut, "windows")
    asked = stage(cut.select("window", "terms").dropDuplicates(["window"]), "asked")
    terms = stage(asked.select(F.explode("terms").alias("term")).distinct(), "terms")
    spread = docs.select(F.explode(terms_of(body)).alias("term"))
    frequency = stage(spread.join(terms, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "frequency")
    chosen = stage(probes(asked, frequency), "probes")
    wanted = stage(chosen.select(F.explode(F.array("t1", "t2")).alias("term")).where("term is not null").distinct(), "wanted")
    index = stage(build_index(docs, body, wanted), "postings")
    places = candidates(index, chosen, slack)
    items = cut.groupBy("window").agg(F.collect_set("item").alias("items"))
    listed = places.join(asked, "window").join(items, "window").groupBy("doc").agg(
        F.collect_list(F.when(F.col("exact") & (F.col("start") >= 0), F.struct("start", "terms", "items"))).alias("found"),
        F.count(F.lit(1)).alias("near"),
    )
    listed = stage(listed, "places")
    held = carry is None or text in carry
    whole = packed(docs, carry, doc=digest(body), **({} if held else {"body": body})).join(listed, "doc", "left")
    joined = bound(whole, w=terms_of(text_of(f"row.`{text}`") if held else F.col("body")))
    checked = bound(joined, true=F.filter("found", lambda f: F.slice("w", f["start"] + 1, F.size(f["terms"])) == f["terms"]))
    spans = F.transform("true", lambda f: F.struct(f["start"].alias("first"), F.size(f["terms"]).alias("length")))
    holders = F.flatten(F.transform("true", lambda f: f["items"]))
    none = lambda kind: F.array().cast(kind)
    found = bound(
        checked,
        hits=F.coalesce(F.sort_array(spans), F.expr("cast(array() as array<struct<first: int, length: int>>)")),
        item_ids=F.coalesce(F.sort_array(F.array_distinct(holders)), none("array<string>")),
    )
    # Hits are in order of their first word: each adds what reaches beyond the last covered word.
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).alias("words"), F.lit(0).alias("end")),
        lambda acc, h: F.struct(
            (acc["words"] + F.greatest(F.lit(0), h["first"] + h["length"] - F.greatest(acc["end"], h["first"]))).alias("words"),
            F.greatest(acc["end"], h["first"] + h["length"]).alias("end"),
        ),
        lambda acc: acc["words"].cast("long"),
    )
    out = found.select("row", F.size("w").cast("long").alias("n_words"), covered.alias("n_hit"), "item_ids", "hits", (F.coalesce("near", F.lit(0)) - F.when(F.col("true").isNull(), 0).otherwise(F.size("true"))).cast("long").alias("n_near"))
    return unpacked(out, "n_words", "n_hit", "item_ids", "hits", "n_near")
