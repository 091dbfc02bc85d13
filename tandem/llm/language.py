"""Language identification by error-correcting output codes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tandem.llm.common import packed, text_of, unpacked
from tandem.session import stage

GRAM, BUCKET_BITS = 4, 16
BUCKETS = 1 << BUCKET_BITS
#: Text bytes whose n-grams are held at once.
CHUNK = 1 << 20
#: Languages whose counts a task holds at once.
HELD = 16
_GAP = b" " * GRAM
_LETTERS = np.full(256, 32, np.uint8)
for _first, _last in ((65, 90), (97, 122), (128, 255)):
    _LETTERS[_first : _last + 1] = np.arange(_first, _last + 1)


def gram_pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of each gram, its bucket), piece by piece: 4-byte n-grams of lower-case letters with blanks between words."""
    rows, parts, size = [], [], 0

    def cut() -> tuple[np.ndarray, np.ndarray]:
        data = _LETTERS[np.frombuffer(_GAP + _GAP.join(parts) + _GAP, np.uint8)]
        blank = data == 32
        a = data.astype(np.uint32)
        code = a[:-3] | a[1:-2] << 8 | a[2:-1] << 16 | a[3:] << 24
        good = ~((blank[:-3] & blank[1:-2]) | (blank[2:-1] & blank[3:]))
        owner = np.repeat(np.array(rows), [len(p) + GRAM for p in parts])[: len(code)]
        owner = np.concatenate([owner, np.full(len(code) - len(owner), rows[-1])])
        return owner[good], (code[good] * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)

    for row, text in enumerate(pc.utf8_lower(texts)):
        whole = text.as_buffer() if text.is_valid else None
        for k in range(0, whole.size if whole else 0, CHUNK):
            # A long text goes on in the next piece, with the bytes that make its n-grams whole.
            parts.append(bytes(whole[max(0, k - GRAM + 1) : k + CHUNK]))
            rows.append(row)
            size += len(parts[-1])
            if size >= CHUNK:
                yield cut()
                rows, parts, size = [], [], 0
    if parts:
        yield cut()


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of the labelled texts of a partition."""
    held: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "bucket", "n"])
        held.clear()

    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
        for owner, bucket in gram_pieces(batch.column("text")):
            of = codes[owner]
            for k in np.unique(of):
                if names[k] not in held and len(held) >= HELD:
                    yield from flush()
                held.setdefault(names[k], np.zeros(BUCKETS, np.int64))[:] += np.bincount(bucket[of == k], minlength=BUCKETS)
    yield from flush()


def codewords(classes: int, seed: int = 1) -> np.ndarray:
    """A row of +1 and -1 per class. All ways to part up to five classes; beyond that random columns, 15 log2 of the
    classes, of the tried tables the one whose closest rows are farthest apart."""
    if classes <= 5:
        parts = [p for p in product((1, -1), repeat=classes) if p[0] == 1 and -1 in p]
        return np.array(parts, np.int8).T.reshape(classes, -1)
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(200):
        table = rng.choice(np.array([1, -1], np.int8), (classes, int(np.ceil(15 * np.log2(classes)))))
        table = table[:, np.abs(table.sum(axis=0)) < classes]
        differ = (table.shape[1] - table.astype(int) @ table.T.astype(int)) // 2 + np.eye(classes, dtype=int) * 10**6
        if differ.min() > apart:
            best, apart = table, differ.min()
    return best


def bit_weights(counts: np.ndarray, code: np.ndarray) -> np.ndarray:
    """(bits, buckets): log-odds of a bucket between the languages at +1 and those at -1, each language weighing alike."""
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    side = lambda s: (code.T == s) @ share / (code.T == s).sum(axis=1, keepdims=True)
    return (np.log(side(1)) - np.log(side(-1))).astype(np.float32)


def margins_of(weights: np.ndarray):
    """A mapInArrow function: adds each text's mean log-odds per bit; null without n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, seen = np.zeros((batch.num_rows, len(weights))), np.zeros(batch.num_rows, np.int64)
            for owner, bucket in gram_pieces(batch.column("text")):
                seen += np.bincount(owner, minlength=len(seen))
                for b, w in enumerate(weights):
                    total[:, b] += np.bincount(owner, weights=w[bucket], minlength=len(seen))
            mean = total / np.maximum(seen, 1)[:, None]
            listed = pa.array([m if n else None for m, n in zip(mean, seen)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("row", "lang")], listed], ["row", "lang", "margins"])

    return run


def decoder(names: list[str], code: np.ndarray, trust: np.ndarray, scale: np.ndarray, gap: float):
    """Loss-weighted decoding: (lang, score, ambiguous) of the codeword with the least weighted exponential loss."""

    @F.pandas_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]))
    def decode(margins: pd.Series) -> pd.DataFrame:
        known = margins.notna().to_numpy()
        f = np.stack([m if ok else np.zeros(code.shape[1]) for m, ok in zip(margins, known)]) / scale if len(margins) else np.zeros((0, code.shape[1]))
        loss = np.stack([(np.exp(-np.clip(f * row, -30, 30)) * w).sum(axis=1) for row, w in zip(code, trust)], axis=1)
        order = np.argsort(loss, axis=1, kind="stable")
        best = np.take_along_axis(loss, order, axis=1)
        second = best[:, 1] if len(names) > 1 else np.full(len(best), np.inf)
        score = np.where(np.isinf(second), 1.0, second / np.where(np.isinf(second), 1.0, np.maximum(best[:, 0] + second, 1e-300)))
        return pd.DataFrame({"lang": [names[k] for k in order[:, 0]], "score": score, "ambiguous": score < 0.5 + gap})

    return decode


def identify(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", gap: float = 0.05, carry: list[str] | None = None) -> DataFrame:
    """Input columns (those in ``carry``, if given), ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``.

    Rows where ``learn`` holds and the language is not null are counted: byte n-grams of their whole texts, per
    language. Each bit of the languages' codewords gets a naive Bayes classifier between the languages at +1 and those
    at -1; its accuracy on every language, over all rows learnt from, weighs its loss. A text goes to the language
    whose codeword loses least; it is ambiguous if the runner-up is within ``gap`` of an even score. The model
    (languages x 65536 counts) is what reaches the driver; language, id and other columns are no input of a prediction.

    A null text or one without letters is ``und`` with score 0, and so is any text if nothing was learnt. Letters
    too few for an n-gram, and ties, go to the language with more rows. Repeated rows count as often as they occur. An
    empty table gives no rows. Input columns named like an output are replaced.
    """
    spark = docs.sparkSession
    usable = F.when(learn, F.col(lang))
    known = docs.select(usable.alias("lang"), text_of(text).alias("text")).where("lang is not null")
    table = known.mapInArrow(count_grams, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    frequent = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    names = sorted(frequent, key=lambda n: (-frequent[n], n))
    body = text_of(text)
    if not names:
        return unpacked(packed(docs, carry).withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "ambiguous": F.lit(True)}), "lang_pred", "score", "ambiguous")
    counts, fitted = np.zeros((len(names), BUCKETS)), table.toArrow()
    at = {n: k for k, n in enumerate(names)}
    counts[[at[n] for n in fitted["lang"].to_pylist()], fitted["bucket"].to_numpy()] = fitted["n"].to_numpy()
    code = codewords(len(names))
    marked = packed(docs, carry, lang=usable, text=F.when(body.rlike(r"\p{L}"), body))
    schema = T.StructType([marked.schema["row"], marked.schema["lang"], T.StructField("margins", T.ArrayType(T.DoubleType())), T.StructField("letters", T.BooleanType())])
    run = margins_of(bit_weights(counts, code))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.column("text").is_valid()
            for out in run(iter([batch])):
                yield out.append_column("letters", letters)

    margins = stage(marked.mapInArrow(add, schema), "margins")
    each = margins.where("lang is not null and margins is not null").select("lang", F.posexplode("margins").alias("bit", "f"))
    seen = each.groupBy("lang", "bit").agg(F.avg((F.col("f") > 0).cast("double")).alias("positive"), F.avg(F.abs("f")).alias("size")).collect()
    right, size = np.full(code.shape, 0.5), np.ones(code.shape)
    for r in seen:
        k = at[r["lang"]], r["bit"]
        right[k] = r["positive"] if code[k] > 0 else 1 - r["positive"]
        size[k] = r["size"]
    trust = np.maximum(right, 1e-6) / np.maximum(right, 1e-6).sum(axis=1, keepdims=True)
    scale = np.maximum(size.mean(axis=0), 1e-9)
    decoded = margins.withColumn("out", decoder(names, code, trust, scale, gap)("margins"))
    pick = lambda f, other: F.when(F.col("letters"), F.col("out").getField(f)).otherwise(F.lit(other))
    done = decoded.select("row", pick("lang", "und").alias("lang_pred"), pick("score", 0.0).alias("score"), pick("ambiguous", True).alias("ambiguous"))
    return unpacked(done, "lang_pred", "score", "ambiguous")
