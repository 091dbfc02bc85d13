"""Queries: scorecard tables, scoring, explanations, what-if, streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem import config as cfg
from tandem.catalog import base as b
from tandem.catalog.base import hash_coef, query, r, rnd, sql
from tandem.functions import numeric as num
from tandem.catalog.models import linear
from tandem.operators import learn, scorecard as sc
from tandem.operators.fusion import FeatureSpec, fit_features
from tandem.plans import export, training
from tandem.session import stage, stage_path
from tandem.sources import tables as t
from tandem.streaming import scoring

_CARD_ROWS = f"""
    SELECT 'text' AS kind, term AS name, {hash_coef("concat('text__', term)")} AS coef FROM cvocab
    UNION ALL SELECT 'numeric', "column", {hash_coef("concat('num__', \"column\")")} FROM stats
    UNION ALL SELECT 'level', concat("column", '=', level),
              {hash_coef("concat('cat__', \"column\", '_', level)")} FROM levels"""


@query("sc_build", sql(_CARD_ROWS, "cvocab", "stats", "levels"))
def sc_build(spark, d):
    return b.hashed_card(spark, d).table(spark)


@query("sc_build_stats", sql(f"""
    SELECT 'idf' AS kind, term AS name, round(idf, 6) AS a, 0::DOUBLE AS b FROM cvocab
    UNION ALL SELECT 'scale', "column", {r('mean')}, {r('scale')} FROM stats""", "cvocab", "stats"))
def sc_build_stats(spark, d):
    card = b.hashed_card(spark, d)
    idf = card.term_table(spark).select(F.lit("idf").alias("kind"), F.col("term").alias("name"),
                                        F.col("idf").alias("a"), F.lit(0.0).alias("b"))
    scale = card.numeric_table(spark).select(F.lit("scale").alias("kind"), F.col("column").alias("name"),
                                             rnd("mean").alias("a"), rnd("scale").alias("b"))
    return idf.unionByName(scale)


_Z = f"""SELECT id, {r('z')} AS z, {r('1.0::DOUBLE / (1.0::DOUBLE + exp(-z))')} AS proba FROM zs"""


@query("sc_score", sql(_Z, "zs"))
def sc_score(spark, d):
    return sc.score_records(b.hashed_card(spark, d), b.records(spark, d)).select(
        "id", rnd("z").alias("z"), rnd("proba").alias("proba"))


@query("sc_contrib", sql(f"""
    SELECT id, place::INTEGER AS rank, feature, {r('c')} AS contribution FROM
    (SELECT id, feature, c, row_number() OVER (PARTITION BY id ORDER BY abs(c) DESC,
            CASE WHEN starts_with(feature, 'cat__') THEN 0 WHEN starts_with(feature, 'num__') THEN 1 ELSE 2 END,
            feature) AS place FROM parts) WHERE place <= 5""", "parts"))
def sc_contrib(spark, d):
    out = sc.contributions(b.hashed_card(spark, d), b.records(spark, d), top=5)
    return out.withColumn("contribution", rnd("contribution"))


def _unseen(model, column: str) -> str:
    """A level that training never saw: all its known ones joined."""
    return "+".join(model.tabular.levels[column]) + "+"


@query("sc_whatif", sql(f"""
    WITH w AS (SELECT id, z, log_goal, scale, {hash_coef("'num__log_goal'")} AS wg, main_category,
                      {hash_coef("concat('cat__main_category_', main_category)")} AS wm
               FROM zs JOIN rec USING (id), (SELECT scale FROM stats WHERE "column" = 'log_goal')),
    v AS (SELECT id, 'as is' AS scenario, z FROM w
          UNION ALL SELECT id, 'goal of a million', z + (ln(1000001.0::DOUBLE) - log_goal) / scale * wg FROM w
          UNION ALL SELECT id, 'unknown category', z - wm FROM w)
    SELECT id, scenario, {r('z')} AS z FROM v""", "zs", "rec", "stats"))
def sc_whatif(spark, d):
    """Every record as it is, with a larger goal, and under an unseen category."""
    import math
    changes = {"goal of a million": {"log_goal": math.log1p(1_000_000)},
               "unknown category": {"main_category": _unseen(b.features(spark, d), "main_category")}}
    out = sc.what_if(b.hashed_card(spark, d), b.records(spark, d), changes)
    return out.select("id", "scenario", rnd("z").alias("z"))


@query("sc_unknown_level", sql(f"""
    SELECT country, count(*) AS n, {r("max(" + hash_coef("concat('cat__country_', country)") + ")")} AS shift
    FROM rec JOIN levels ON "column" = 'country' AND level = country GROUP BY country""", "rec", "levels"))
def sc_unknown_level(spark, d):
    """Losing a known level moves the log-odds by exactly its coefficient."""
    card = b.hashed_card(spark, d)
    rec = b.records(spark, d).withColumn("known_country", F.col("country"))
    out = sc.what_if(card, rec, {"gone": {"country": _unseen(b.features(spark, d), "country")}})

    def z(scenario):
        return F.max(F.when(F.col("scenario") == scenario, num.logit(F.col("proba"))))

    per_id = out.groupBy("id", "known_country").agg((z("as is") - z("gone")).alias("shift"))
    return per_id.groupBy(F.col("known_country").alias("country")).agg(
        F.count("*").alias("n"), rnd(F.max("shift")).alias("shift"))


_STOPS = " ".join(cfg.STOP_WORDS[:5])
_SHIFT = """CASE variant WHEN 4 THEN (0 - log_goal) / scale * wg
     WHEN 5 THEN (ln(1000000000001.0::DOUBLE) - log_goal) / scale * wg WHEN 6 THEN -wc WHEN 7 THEN -wy ELSE -wm END"""


@query("sc_edge_cases", sql(f"""
    WITH e AS (SELECT id, unnest(['', '{_STOPS}', concat(name, ' ', name, ' ', name), regexp_replace(upper(name), ' ', ' ~+ ', 'g')]) AS title,
                      unnest([0, 1, 2, 3]) AS variant FROM rec),
    tok AS (SELECT id, variant, unnest({b.term_list(b.cleaned('title'))}) AS term FROM e),
    cnt AS (SELECT id, variant, term, count(*) AS tf FROM tok GROUP BY ALL),
    w AS (SELECT id, variant, term, c.tf * round(idf, 6) AS w, {hash_coef("concat('text__', term)")} AS k
          FROM cnt c JOIN cvocab USING (term)),
    zt AS (SELECT id, variant, sum(w * k) / sqrt(sum(w * w)) AS zt FROM w GROUP BY ALL),
    tab AS (SELECT id, sum(c) AS c FROM parts WHERE NOT starts_with(feature, 'text__') GROUP BY id),
    f AS (SELECT id, z, log_goal, scale, {hash_coef("'num__log_goal'")} AS wg, unnest([4, 5, 6, 7, 8]) AS variant,
                 {hash_coef("concat('cat__country_', country)")} AS wc,
                 {hash_coef("concat('cat__launch_year_', launch_year)")} AS wy,
                 {hash_coef("concat('cat__category_', category)")} AS wm
          FROM zs JOIN rec USING (id), (SELECT scale FROM stats WHERE "column" = 'log_goal'))
    SELECT id, variant::INTEGER AS variant,
           {r(hash_coef("'intercept'") + " + tab.c + coalesce(zt, 0)")} AS z
    FROM e JOIN tab USING (id) LEFT JOIN zt USING (id, variant)
    UNION ALL SELECT id, variant::INTEGER, {r("z + " + _SHIFT)} FROM f""", "rec", "cvocab", "parts", "zs", "stats"))
def sc_edge_cases(spark, d):
    """Every record under an empty, an all-stop-word and a repeating title, and one of capitals with signs between the words, a goal of nothing and of a million
    millions, an unseen country, an unseen year and no category."""
    rec = b.records(spark, d)
    name, kinds = F.col("name"), dict(rec.dtypes)
    changes = [
        {"name": F.lit("")}, {"name": F.lit(_STOPS)}, {"name": F.concat_ws(" ", name, name, name)},
        {"name": F.replace(F.upper(name), F.lit(" "), F.lit(" ~+ "))},
        {"log_goal": F.lit(0.0)}, {"log_goal": F.log(F.lit(1000000000001.0))},
        {"country": F.lit(_unseen(b.features(spark, d), "country"))}, {"launch_year": F.lit(_unseen(b.features(spark, d), "launch_year"))}, {"category": F.lit(None)},
    ]
    fields = sorted({f for c in changes for f in c})
    variants = F.array(*[F.struct(F.lit(i).alias("variant"), *[c.get(f, F.col(f)).cast(kinds[f]).alias(f) for f in fields]) for i, c in enumerate(changes)])
    rest = [c for c in rec.columns if c not in fields]
    rows = rec.select(*rest, F.explode(variants).alias("v")).select(*rest, "v.*")
    return sc.score_records(b.hashed_card(spark, d), rows).select("id", "variant", rnd("z").alias("z"))


@query("sc_current", sql("""
    SELECT (SELECT count(*) FROM cvocab) + (SELECT count(*) FROM stats) + (SELECT count(*) FROM levels) AS "rows",
           0::BIGINT AS stale""", "cvocab", "stats", "levels"))
def sc_current(spark, d):
    """A stored scorecard against one whose vocabulary, scaling and levels are fitted anew on the tables."""
    stored = stage(b.hashed_card(spark, d).table(spark), "card")
    records = training.split_records(t.campaigns(spark, d))
    model = fit_features(records.where(F.col("split") == "train"), FeatureSpec())
    fresh = sc.build(model, [b.hashed_coef(n) for n in model.names], b.hashed_coef("intercept"))
    wrong = sc.stale_rows(stored, fresh.table(spark)).agg(F.count("*"))
    return stored.agg(F.count("*").alias("rows")).withColumn("stale", wrong.scalar())


@query("snk_scorecard", sql(f"""
    SELECT kind, name, coef FROM ({_CARD_ROWS})
    UNION ALL SELECT 'intercept', '', {hash_coef("'intercept'")}
    UNION ALL SELECT 'idf', term, round(idf, 6) FROM cvocab
    UNION ALL SELECT 'fact', concat('n_', split), count(*)::DOUBLE FROM rec GROUP BY split
    UNION ALL SELECT 'fact', 'n_features', count(*)::DOUBLE FROM features
    UNION ALL SELECT 'fact', 'majority_accuracy', {r('greatest(avg(target), 1.0::DOUBLE - avg(target))')} FROM rec WHERE split = 'test'
    """ + "".join(f"""
    UNION ALL SELECT 'form', (SELECT concat('{c}=', {c}) FROM rec WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), 0.0::DOUBLE"""
    for c in export.FORM_COLUMNS), "cvocab", "stats", "levels", "rec", "features"))
def snk_scorecard(spark, d):
    """The scorecard out to one JSON document and back."""
    path = stage_path(spark, "scorecard")
    export.document(b.hashed_card(spark, d), b.records(spark, d)).coalesce(1).write.json(path)
    card = export.load(spark, path)
    idf = card.term_table(spark).select(F.lit("idf").alias("kind"), F.col("term").alias("name"),
                                        F.col("idf").alias("coef"))
    rows = [("intercept", "", card.intercept), *[("fact", k, v) for k, v in card.facts.items()], *[("form", f"{k}={v}", 0.0) for k, v in card.form.items()]]
    one = spark.createDataFrame(rows, "kind string, name string, coef double").withColumn(
        "coef", F.when(F.col("name") == "majority_accuracy", rnd("coef")).otherwise(F.col("coef")))
    return card.table(spark).unionByName(idf).unionByName(one)


@query("sc_parity", sql("""
    SELECT count(*) AS "rows", 0::BIGINT AS unmatched, true AS ok FROM rec""", "rec"))
def sc_parity(spark, d):
    """A fitted model against its scorecard on every record."""
    data, model = b.prepared(spark, d), linear(spark, d)
    card = export.from_logistic(data.model, model)
    preds = learn.predict(model, data.rows, "linear")
    out = sc.parity(preds, sc.score_records(card, b.records(spark, d)))
    return out.select("rows", "unmatched", (F.col("max_abs_diff") <= 1e-6).alias("ok"))


@query("stream_score", sql(f"""
    SELECT id, {r('z')} AS z, {r('1.0::DOUBLE / (1.0::DOUBLE + exp(-z))')} AS proba FROM zs""", "zs"))
def stream_score(spark, d):
    """Every campaign, arriving as files on a stream. Returned are those that the SQL beside it covers: the records."""
    return _stream_scores(spark, d).join(b.records(spark, d).select("id"), "id", "left_semi")


def _stream_scores(spark, d):
    """(id, z, proba) of every campaign, whatever its state: scoring needs no label."""
    card = b.hashed_card(spark, d)
    inbox, out, marks = (stage_path(spark, x) for x in ("inbox", "scored", "marks"))
    t.campaigns(spark, d).select(*t.CAMPAIGN_SCHEMA.names).write.parquet(inbox)
    stream = scoring.score_stream(scoring.campaign_stream(spark, inbox, 4), card)
    scoring.write_scores(stream, out, marks).awaitTermination()
    return spark.read.schema("id long, z double, proba double").parquet(out).select(
        "id", rnd("z").alias("z"), rnd("proba").alias("proba"))
