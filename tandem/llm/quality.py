"""Document quality from overlapping heuristic labellers: their accuracies by EM, then a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tandem.llm.common import POINT_BITS, packed, point, text_of, unpacked
from tandem.session import stage

#: At most about this many documents teach the scorer, and this many labelled ones of either kind the word list.
SAMPLE, LABELLED = 12_000, 4_000
#: A listed word is in so many harmful texts at least, with so much log likelihood of being more than chance.
LEAST, SURE = 4, 8.0
FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
#: Bytes of text read at once.
CHUNK = 1 << 20
#: Bytes of whole texts whose words are held at once; each word takes some 50 bytes while it is counted.
PART = 1 << 22
#: Votes: bad where a share is at least the second number, good where it is at most the first, else none.
CUTS = {
    "capitals": (0.3, 0.5),  # of letters
    "symbols": (0.03, 0.1),  # of what is not blank
    "echoes": (0.05, 0.2),  # words that repeat the word before
    "lone_marks": (0.02, 0.2),  # words without letter or digit
    "top_word": (0.15, 0.3),  # the most frequent word, of texts with 20 words or more
    "listed": (0.0, 1e-12),  # words that labelled rows show in harmful texts only
}
_KIND = np.full(256, 3, np.uint8)  # 0 lower case and beyond ASCII, 1 capital, 2 digit, 3 symbol, 4 blank, 5 stop
_KIND[97:123], _KIND[128:], _KIND[65:91], _KIND[48:58], _KIND[[32, 9, 10, 11, 12, 13]] = 0, 0, 1, 2, 4
for _mark in b".,;:'\"?()-":
    _KIND[_mark] = 5
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


@dataclass
class Words:
    """The words of some texts: owning row, 64-bit hash of the bare word in lower case, and whether it has a letter or digit."""

    row: np.ndarray
    hash: np.ndarray
    solid: np.ndarray


def read_texts(texts: pa.Array) -> tuple[np.ndarray, Words]:
    """(rows x 6 counts of byte kinds, the words) of whole texts; longer ones are read in pieces cut at blanks."""
    kinds = np.zeros((len(texts), 6), np.int64)
    rows, hashes, solid, group, size = [], [], [], [], 0

    def read() -> None:
        data = np.frombuffer(b"".join(p + b" " for _, p in group), np.uint8)
        owner = np.repeat(np.array([r for r, _ in group]), [len(p) + 1 for _, p in group])
        kind = _KIND[data]
        kinds.ravel()[:] += np.bincount(owner * 6 + kind, minlength=kinds.size)
        blank = kind == 4
        first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        if not len(first):
            return
        bare = (kind < 3).astype(np.int64)
        place, starts = np.cumsum(bare), np.append(first, len(data))
        # Place of each letter within its word; the hash is a sum over letters, so it needs no loop over words.
        inside = place.copy()
        inside[first[0] :] -= np.repeat(place[first] - bare[first], np.diff(starts))
        lower = np.where(kind == 1, data + 32, data).astype(np.uint64)
        value = np.where(kind < 3, lower * _POWERS[np.minimum(np.maximum(inside - 1, 0), 63)], 0)
        rows.append(owner[first])
        hashes.append(np.add.reduceat(value, first))
        solid.append(np.add.reduceat(bare, first) > 0)

    for row, text in enumerate(texts):
        whole = text.as_buffer().to_pybytes() if text.is_valid else b""
        k = 0
        while k < len(whole):
            end = len(whole)
            if end - k > CHUNK:
                end = max(whole.rfind(b" ", k, k + CHUNK), k) + 1 if whole.rfind(b" ", k, k + CHUNK) > k else k + CHUNK
            group.append((row, whole[k:end]))
            size += end - k
            k = end
            if size >= CHUNK:
                read()
                group, size = [], 0
    if group:
        read()
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return kinds, Words(join(rows, np.int64), join(hashes, np.uint64), join(solid, bool))


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in stretches of about PART bytes of ``text``, at least one row each. All that is made of them is made row by row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        k = 0
        while k < batch.num_rows:
            end = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + PART, side="right")))
            yield batch.slice(k, end - k)
            k = end


def shares_of(kinds: np.ndarray, words: Words, listed: np.ndarray) -> np.ndarray:
    """(rows x labellers) shares that the labellers vote on; NaN where there is nothing to vote on."""
    n = len(kinds)
    letters, seen = kinds[:, 0] + kinds[:, 1], kinds[:, [0, 1, 2, 3, 5]].sum(axis=1)
    per_row = lambda flag: np.bincount(words.row[flag], minlength=n)
    count = np.bincount(words.row, minlength=n)
    echo = np.zeros(len(words.row), bool)
    echo[1:] = (words.row[1:] == words.row[:-1]) & (words.hash[1:] == words.hash[:-1]) & words.solid[1:]
    top = np.zeros(n)
    if len(words.row):
        order = np.lexsort((words.hash, words.row))
        row, value = words.row[order], words.hash[order]
        start = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])]))
        np.maximum.at(top, row[start], np.diff(np.append(start, len(row))))
    found = np.isin(words.hash, listed)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.stack([
            kinds[:, 1] / letters, kinds[:, 3] / seen, per_row(echo) / count, per_row(~words.solid) / count,
            np.where(count >= 20, top / count, np.nan), per_row(found) / count,
        ], axis=1)
    return out


def votes_of(shares: np.ndarray) -> np.ndarray:
    """1 bad, 0 good, -1 none."""
    low, high = np.array(list(CUTS.values())).T
    return np.where(shares >= high, 1, np.where(shares <= low, 0, -1)).astype(np.int64)


def pattern_of(votes: np.ndarray) -> np.ndarray:
    return (votes + 1) @ (3 ** np.arange(votes.shape[1]))


def features_of(shares: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) without repeats: hashed words, and each share's step on a logarithmic scale."""
    n, m = shares.shape
    step = np.where(np.isnan(shares), 15, np.clip(np.ceil(np.log2(np.maximum(np.nan_to_num(shares), 2.0**-12))) + 12, 0, 12)).astype(np.int64)
    solid = words.solid
    bucket = ((words.hash[solid] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    bucket = np.where(bucket < 16 * m, bucket + 16 * m, bucket)  # the first buckets are the steps'
    row = np.concatenate([words.row[solid], np.repeat(np.arange(n), m)])
    feature = np.concatenate([bucket, (step + 16 * np.arange(m)).ravel()])
    both = np.unique(row * FEATURES + feature)
    return both // FEATURES, both % FEATURES


def fit_labellers(
    patterns: dict[int, int], labellers: int, rounds: int = 100, known: dict[tuple[int, int], int] | None = None
) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    """EM over counts of vote patterns: (share of each kind, rate of bad votes per kind and labeller, posterior of bad
    per pattern).

    Kind 0 is good. Documents go bad in different ways and each labeller sees some of them, so there is one bad kind per
    labeller, started from the documents that it votes against; votes are independent within a kind only. A labeller's
    accuracy on good documents is one less its rate at kind 0. A missing vote says nothing.

    ``known`` counts labelled documents by (pattern, 1 for bad): their class stays as labelled, and only the kind of the
    bad ones is estimated.
    """
    known = known or {}
    keys = np.array(sorted({*patterns, *(k for k, _ in known)}), np.int64)
    weight, good, bad = (
        np.array([counts(k) for k in keys.tolist()], float)
        for counts in (lambda k: patterns.get(k, 0), lambda k: known.get((k, 0), 0), lambda k: known.get((k, 1), 0))
    )
    votes = keys[:, None] // 3 ** np.arange(labellers) % 3 - 1
    against = votes == 1
    q = np.concatenate([np.where(against.any(axis=1), 0.05, 0.95)[:, None], against * 0.95 / np.maximum(against.sum(axis=1), 1)[:, None] + 0.05 / labellers], axis=1)
    q /= q.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        mass = weight[:, None] * q
        mass[:, 0] += good
        mass[:, 1:] += bad[:, None] * q[:, 1:] / q[:, 1:].sum(axis=1, keepdims=True)
        share = (mass.sum(axis=0) + 1e-3) / (mass.sum() + 1e-3 * (labellers + 1))
        rate = (mass.T @ against + 0.01) / (mass.T @ (votes >= 0) + 1.0)
        rate = np.clip(rate, 1e-4, 1 - 1e-4)
        log = np.log(share) + against @ np.log(rate).T + (votes == 0) @ np.log(1 - rate).T
        q = np.exp(log - log.max(axis=1, keepdims=True)) + 1e-300
        q /= q.sum(axis=1, keepdims=True)
    return share, rate, dict(zip(keys.tolist(), (1 - q[:, 0]).tolist()))


def fit_scorer(row: np.ndarray, feature: np.ndarray, target: np.ndarray, rounds: int = 80, least: float = 2.0) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by accelerated proximal steps. The absolute penalty, ``least`` documents'
    worth, keeps words at zero that only a few documents share by chance."""
    weights, bias = np.zeros(FEATURES), 0.0
    wide = np.bincount(row, minlength=len(target))
    # A coordinate's step is bounded by the sizes of the rows that hold it, so the steps never overshoot.
    rate = 4.0 / np.maximum(np.bincount(feature, weights=wide[row], minlength=FEATURES), 1.0)
    ahead, momentum = weights.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=ahead[feature], minlength=len(target)) + bias, -50, 50)))
        error = p - target
        new = ahead - rate * np.bincount(feature, weights=error[row], minlength=FEATURES)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * least, 0)
        step = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead, weights, momentum = new + (momentum - 1) / step * (new - weights), new, step
        bias -= 4.0 * error.sum() / max(wide.sum(), 1)
    return weights, bias


def known_labels(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(id, bad) once per labelled id; of labels that differ the largest counts."""
    said = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("bad")).where("id is not null and bad is not null")
    return said.groupBy("id").agg(F.max("bad").alias("bad"))


def known_classes(labels: DataFrame, doc_id: str, label: str, good: str) -> DataFrame:
    """(id, truth) once per labelled id: 1 if any of its labels calls it harmful or no good, 0 if one calls it good and none bad."""
    bad = F.coalesce(F.col(label) == 1, F.lit(False)) | F.coalesce(F.col(good) == 0, F.lit(False))
    said = labels.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.when(bad, 1).when(F.col(good) == 1, 0).alias("truth"))
    return said.where("truth is not null").groupBy("id").agg(F.max("truth").alias("truth"))


def harmful_words(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, most: int) -> np.ndarray:
    """Hashes of words that harmful sampled texts hold significantly more often (SURE) and clean ones 50 times less often.

    No word has to reach a share of all harmful texts, so a language with few of them has its words, too. The sample is
    about ``most`` labelled rows of either kind, those whose id comes first on a ring of hashes.
    """
    known = known_labels(labels, doc_id, label)
    counts = {r["bad"]: r["count"] for r in known.groupBy("bad").count().collect()}
    if not counts.get(1):
        return np.zeros(0, np.uint64)
    share = F.lit(0.0)
    for kind, n in counts.items():
        share = F.when(F.col("bad") == kind, min(1.0, most / n)).otherwise(share)
    drawn = known.where(point(F.col("id").cast("string")) < share * float(1 << POINT_BITS))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            _, found = read_texts(batch.column("text"))
            both = np.unique(np.stack([found.row[found.solid].astype(np.uint64), found.hash[found.solid]]), axis=1)
            bad = batch.column("bad").to_numpy(zero_copy_only=False)[both[0].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(both[1].view(np.int64)), pa.array((bad == 1).astype(np.int64)), pa.array((bad != 1).astype(np.int64))], ["word", "bad", "fine"])

    held = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text")).join(F.broadcast(drawn), "id").select("text", "bad")
    table = held.mapInArrow(words, "word long, bad long, fine long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
    weight = min(counts[1], most) / max(1, sum(min(n, most) for k, n in counts.items() if k != 1))
    base = weight / (1 + weight)
    # Log likelihood of a word's share of harmful texts against the share of all: n times their divergence.
    q = F.col("bad") / (F.col("bad") + F.col("fine"))
    evidence = F.col("bad") * F.log(q / base) + F.when(F.col("fine") > 0, F.col("fine") * F.log((1 - q) / max(1 - base, 1e-9))).otherwise(0.0)
    kept = table.where((F.col("bad") >= LEAST) & (F.col("fine") * 50 * weight <= F.col("bad")) & (evidence >= SURE)).toArrow()
    return np.sort(kept["word"].to_numpy().view(np.uint64))


def judge(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", good: str = "quality",
    sample: int = SAMPLE, labelled: int = LABELLED, carry: list[str] | None = None,
) -> DataFrame:
    """Input columns (those in ``carry``, if given), ``p_bad``, ``score``, and ``keep`` (score at least 0.5).

    Six labellers vote good, bad or nothing on each whole text; the sixth looks for words that a bounded sample of
    ``labels`` shows in harmful texts. Vote patterns of all documents are counted, and EM over these at most 3**6 counts
    estimates each labeller's accuracy on good documents and on each kind of bad ones; documents that ``labels`` calls
    harmful, or good or no good, keep that class in it. ``p_bad`` is the posterior of a document's votes. A logistic
    scorer over hashed words and stepped shares learns the posteriors of about ``sample`` documents, drawn by hash of id
    and text, and of up to 2 * ``labelled`` labelled ones. It gives ``score``, the probability that a document is good.

    A null or empty text has no votes but is judged like any other. Without label rows the word list is empty. Repeated rows are
    judged alike. An empty table gives no rows. Input columns named like an output are replaced.
    """
    spark = docs.sparkSession
    listed = harmful_words(docs, labels, text, doc_id, label, labelled)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            kinds, words = read_texts(batch.column("text"))
            pattern = pattern_of(votes_of(shares_of(kinds, words, listed)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(pattern)], ["id", "pattern"])

    at = point(F.concat_ws("|", F.col(doc_id).cast("string"), text_of(text)))
    ids = docs.schema[doc_id].dataType.simpleString()
    cast = stage(docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text")).mapInArrow(vote, f"id {ids}, pattern long"), "votes")
    known = known_classes(labels, doc_id, label, good)
    counted = cast.join(known, "id", "left").groupBy("pattern", "truth").count().collect()
    patterns = {r["pattern"]: r["count"] for r in counted if r["truth"] is None}
    _, _, posterior = fit_labellers(patterns, len(CUTS), known={(r["pattern"], r["truth"]): r["count"] for r in counted if r["truth"] is not None})
    share = min(1.0, sample / max(1, sum(r["count"] for r in counted)))
    posteriors = np.array([posterior.get(k, 0.0) for k in range(3 ** len(CUTS))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            kinds, words = read_texts(batch.column("text"))
            shares = shares_of(kinds, words, listed)
            row, feature = features_of(shares, words)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            listed_features = pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.astype(np.int32)))
            truth = batch.column("truth").to_numpy(zero_copy_only=False)
            target = np.where(truth < 0, posteriors[pattern_of(votes_of(shares))], truth)
            yield pa.RecordBatch.from_arrays([batch.column("at"), listed_features, pa.array(target)], ["at", "features", "target"])

    # Labelled rows teach as well, both classes at one rate, so they do not shift the share of bad texts.
    rate = min(1.0, 2 * labelled / max(1, known.count()))
    told = known.where(point(F.col("id").cast("string")) < rate * float(1 << POINT_BITS))
    rows = docs.select(F.col(doc_id).alias("id"), at.alias("at"), text_of(text).alias("text")).join(F.broadcast(told), "id", "left")
    drawn = rows.where((F.col("at") < share * float(1 << POINT_BITS)) | F.col("truth").isNotNull())
    drawn = drawn.select("at", "text", F.coalesce("truth", F.lit(-1)).alias("truth"))
    # Equal rows draw one example, so a hot group of copies can't fill the sample.
    taught = drawn.mapInArrow(encode, "at long, features array<int>, target double").dropDuplicates(["at"]).orderBy("at").toArrow().combine_chunks()
    flat = taught["features"].combine_chunks() if taught.num_rows else None
    if flat is None or not len(flat):
        weights, bias = np.zeros(FEATURES), -10.0
    else:
        sizes = pc.list_value_length(flat).to_numpy()
        weights, bias = fit_scorer(np.repeat(np.arange(len(sizes)), sizes), flat.flatten().to_numpy(), taught["target"].to_numpy())
    model = spark.sparkContext.broadcast((weights.astype(np.float32), bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt, base = model.value
        for batch in parts_of(batches):
            kinds, words = read_texts(batch.column("text"))
            shares = shares_of(kinds, words, listed)
            row, feature = features_of(shares, words)
            total = np.bincount(row, weights=learnt[feature], minlength=batch.num_rows) + base
            good = 1 / (1 + np.exp(np.clip(total, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(posteriors[pattern_of(votes_of(shares))]), pa.array(good)], ["row", "p_bad", "score"])

    whole = packed(docs, carry, text=text_of(text))
    schema = T.StructType([whole.schema["row"], T.StructField("p_bad", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return unpacked(whole.mapInArrow(score, schema).withColumn("keep", F.col("score") >= 0.5), "p_bad", "score", "keep")
