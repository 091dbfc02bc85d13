"""Queries of this subpackage, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from tandem.llm import audit, decontaminate, idfiles, language, lines, ngram_score, packing, pieces, quality, sharding, simhash, vectorcode, winnow
from tandem.llm.common import documents, text_of, unsigned_crc32
from tandem.session import stage_path

SHARDS = 8
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def held_out(parts: int) -> Column:
    """Documents that nothing may be learnt from: a fixed part of the hashed ids."""
    return F.coalesce(unsigned_crc32(F.col("doc_id").cast("string")) % parts == 2, F.lit(False))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law rows: counts of the shards differ by one at most."""
    text = text_of()
    docs = documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), unsigned_crc32(text).alias("text_crc32")
    )
    placed = sharding.shard(docs, F.col("doc_id"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = language.identify(docs, ~held_out(4), carry=["doc_id"])
    return found.select("doc_id", held_out(4).alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what is left of its text; the first of each group of near-equal lines stays."""
    return lines.drop_near_lines(documents(spark, sf_dir, "doc_id", "text"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to files in the shared folder and read back from them."""
    out = stage_path(spark, "token-ids")
    idfiles.write_ids(documents(spark, sf_dir, "doc_id", "text"), out, TOKENIZER, end_id=2)
    return idfiles.read_ids(spark, out)


def op6_ngram_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    found = ngram_score.score(docs, ~held_out(7), carry=["doc_id"])
    return found.select("doc_id", held_out(7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return simhash.near_copies(docs, carry=["doc_id"]).select("doc_id", "fingerprint", "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir, "doc_id", "text"), TOKENIZER, size=1024, end_id=0, carry=["doc_id"])
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compare_next(documents(spark, sf_dir, "doc_id", "text"), carry=["doc_id"])


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=["doc_id"])


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_texts(documents(spark, sf_dir, "doc_id", "text"), PIECES, carry=["doc_id"])
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("begins", "ends").alias("spans_xxhash64"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "source")
    return audit.interactions(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vectorcode.compress(vectors, carry=["vec_id"])


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_language, op3_line_dedup, op4_decontamination, op5_token_files, op6_ngram_score, op7_simhash, op8_packing, op9_winnowing,
        op10_quality, op11_pieces, op12_filter_audit, op13_vector_codes,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES: dict[str, str] = {
    "op4_decontamination": f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT CAST(item_id AS varchar) AS item, {_TERMS} AS w FROM benchmark),
bs AS (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, array_to_string(list_slice(w, s, s + 9), ' ') AS k, len(list_slice(w, s, s + 9)) AS n FROM bs),
sizes AS (SELECT DISTINCT n FROM bw),
ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
dw AS (SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS k FROM ds),
hit AS (SELECT DISTINCT doc_id, s, n, item FROM dw JOIN bw USING (k, n)),
spots AS (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hit) x),
covered AS (SELECT doc_id, count(*) AS n_hit FROM spots GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hit) y GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS bigint) AS n_words, CAST(coalesce(n_hit, 0) AS bigint) AS n_hit,
       CAST(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id
""",
    "op12_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
        regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > low, false)] AS fails FROM w),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(range(1, 6)) AS x),
orders AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, array_to_string(list_transform(o, lambda x: substr('ABCDE', CAST(x AS integer), 1)), '') AS filter_order, unnest(range(1, 6)) AS step FROM orders),
s AS (SELECT m.*, filter_order, step, o[step] AS x, fails[o[step]] AS bad, coalesce(list_bool_or(list_transform(o[1:step - 1], lambda x: fails[x])), false) AS earlier,
        len(list_filter(fails, lambda b: b)) AS n_fails FROM m, steps),
c AS (SELECT part, filter_order, step, x, sum(CASE WHEN NOT bad AND NOT earlier THEN n ELSE 0 END) AS kept, sum(CASE WHEN bad AND NOT earlier THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN bad AND earlier THEN n ELSE 0 END) AS redundant, sum(CASE WHEN bad AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN bad AND NOT earlier AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN bad AND NOT earlier AND toxic THEN n ELSE 0 END) AS toxic_lost
      FROM s GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS integer) AS step, CAST(kept AS bigint) AS kept, CAST(removed AS bigint) AS removed, CAST(redundant AS bigint) AS redundant,
       CAST(unique_fails AS bigint) AS unique_fails, CAST(good_lost AS bigint) AS good_lost, CAST(toxic_lost AS bigint) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS bigint) AS shapley
FROM c
""",
}


def _vector_sql(parts: int = vectorcode.PARTS, entries: int = vectorcode.ENTRIES, rounds: int = vectorcode.ROUNDS) -> str:
    """All rounds of the codebooks, one after the other."""

    def assign(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (SELECT id, part, min((dist, e)) AS best FROM
  (SELECT x.id, x.part, c.e, sum((x.v - c.v) * (x.v - c.v)) AS dist FROM x JOIN c{k} c USING (part, place) GROUP BY x.id, x.part, c.e) GROUP BY id, part),"""

    steps = "".join(
        f"""{assign(k)}
c{k + 1} AS MATERIALIZED (SELECT c.part, c.e, c.place, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN
  (SELECT x.part, a.best[2] AS e, x.place, CAST(floor(CAST(sum(x.v) AS double) / count(*)) AS bigint) AS v
   FROM x JOIN a{k} a ON a.id = x.id AND a.part = x.part GROUP BY x.part, a.best[2], x.place) m USING (part, e, place)),"""
        for k in range(rounds)
    )
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label,
    list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS double)) AS bigint)) AS v, len(embedding) // {parts} AS places
  FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda c: coalesce(isfinite(c), false)))),
flat AS (SELECT id, places, unnest(v) AS v, unnest(range(len(v))) AS d FROM kept),
x AS MATERIALIZED (SELECT id, d // places AS part, d % places AS place, v FROM flat),
c0 AS MATERIALIZED (SELECT part, id - 1 AS e, place, v FROM x WHERE id <= {entries}),{steps}{assign(rounds)}
coded AS MATERIALIZED (SELECT id, string_agg(printf('%02x', CAST(best[2] AS integer)), '' ORDER BY part) AS code, CAST(sum(best[1]) AS bigint) AS error FROM a{rounds} GROUP BY id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS varchar), ',' ORDER BY part, e, place)) FROM c{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (id)
"""


ORACLES["op13_vector_codes"] = _vector_sql()
