"""Models on the driver tables.  Their fitted numbers have no SQL form; the metrics they report do (see features)."""

from pyspark.sql import functions as F

from ..functions import det
from ..operators import models as M
from ..operators.series import lag_linear
from ..session import settle
from .aggregates import rounded
from .registry import query, table

TEXT = ["n_chars", "n_words", "word_length", "distinct_share", "digit_share", "symbol_share", "n_lines"]
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _labelled(spark, sf):
    feats = M.text_features(table(spark, sf, "documents"), "doc_id", "text")
    return feats.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


@query("classify_report")
def classify_report(spark, sf):
    return M.supervised_report(_labelled(spark, sf), "doc_id", TEXT, "quality")


@query("regress_report")
def regress_report(spark, sf):
    feats = M.text_features(table(spark, sf, "documents"), "doc_id", "text")
    return M.supervised_report(feats, "doc_id", [c for c in TEXT if c != "n_words"], "n_words")


@query("classify_language")
def classify_language(spark, sf):
    """Four classes, and the later documents held out."""
    d = table(spark, sf, "documents")
    feats = M.text_features(d, "doc_id", "text").join(d.select("doc_id", "lang", F.col("doc_id").alias("at")), "doc_id")
    return M.supervised_report(feats, "doc_id", TEXT, "lang", models=["logistic", "random_forest"], time_col="at")


@query("model_select")
def model_select(spark, sf):
    return M.model_select(_labelled(spark, sf), "doc_id", TEXT, "quality", {"numTrees": [5, 15], "maxDepth": [3, 6]}, k=3)


@query("importance_prune")
def importance_prune(spark, sf):
    li = table(spark, sf, "lineitem").select(*NUM, (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    return M.importance_prune(li, NUM, "returned", 0.25)


@query("oof_scores")
def oof_scores(spark, sf):
    return M.oof_scores(_labelled(spark, sf), "doc_id", TEXT, "quality", k=3, n_models=2)


@query("oof_oversampled")
def oof_oversampled(spark, sf):
    return M.oof_scores(_labelled(spark, sf), "doc_id", TEXT, "quality", k=3, n_models=1, oversample=True)


@query("model_search")
def model_search(spark, sf):
    """Three of twelve settings, drawn at random."""
    return M.model_select(_labelled(spark, sf), "doc_id", TEXT, "quality", {"numTrees": [5, 10, 15], "maxDepth": [2, 3, 4, 6]}, k=3, draws=3)


@query("oof_bagged", "SELECT doc_id, quality::DOUBLE AS label, 5 AS n_models, true AS in_range FROM labels JOIN documents USING (doc_id)")
def oof_bagged(spark, sf):
    """Five folds of five models."""
    scored = M.oof_scores(_labelled(spark, sf), "doc_id", TEXT, "quality", k=5, n_models=5)
    return scored.select("doc_id", "label", "n_models", F.col("proba").between(0, 1).alias("in_range"))


_WIDE = {
    "numTrees": [5, 10, 20, 40], "maxDepth": [2, 4, 6, 10], "minInstancesPerNode": [1, 2, 5], "featureSubsetStrategy": ["sqrt", "log2", "all"], "maxBins": [16, 32]
}


@query("model_search_rules", "SELECT 6 AS n, 21 AS places, true AS falling, true AS in_range, 6 AS settings")
def model_search_rules(spark, sf):
    """Six of 288 settings in five folds: places 1 to 6 by falling F1, each setting once."""
    found = M.model_select(_labelled(spark, sf), "doc_id", TEXT, "quality", _WIDE, k=5, draws=6)
    pairs = found.agg(F.sort_array(F.collect_list(F.struct("place", "f1"))).alias("p"), F.sum("place").alias("places"), F.count_distinct("settings").alias("settings"))
    f1 = F.col("p.f1")
    falling = F.forall(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.get(f1, i) <= F.get(f1, i - 1))
    return pairs.select(F.size("p").alias("n"), "places", falling.alias("falling"), F.forall(f1, lambda x: x.between(0, 1)).alias("in_range"), "settings")


@query("class_weights", "SELECT doc_id, quality, round((SELECT count(*) FROM labels) / (2.0 * count(*) OVER (PARTITION BY quality)), 9) AS weight FROM labels")
def class_weights(spark, sf):
    return rounded(M.balance(table(spark, sf, "labels").select("doc_id", "quality"), "quality"), 9, "weight")


def _draw(salt):
    return det.uniform_sql("(label || ':' || j)", f"42{salt}")


@query(
    "smote",
    f"""WITH e AS (SELECT vec_id::VARCHAR AS id, label, embedding AS x, row_number() OVER (PARTITION BY label ORDER BY vec_id::VARCHAR) AS pos FROM embeddings),
    n AS (SELECT label, count(*) AS n, max(count(*)) OVER () - count(*) AS need FROM embeddings GROUP BY label),
    d AS (SELECT label, n, unnest(generate_series(1, need)) AS j FROM n WHERE need > 0),
    r AS (SELECT label, j, floor({_draw("a")} * n)::BIGINT + 1 AS pos, floor({_draw("b")} * least(5, n - 1))::BIGINT + 1 AS rank, {_draw("c")} AS gap FROM d),
    p AS (SELECT a.id, b.id AS other, a.label, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x::DOUBLE[], b.x::DOUBLE[]), b.id) AS rank
      FROM e a JOIN e b ON a.label = b.label AND a.id <> b.id WHERE a.label IN (SELECT label FROM n WHERE need > 0))
    SELECT id AS vec_id, label, round(x[1]::DOUBLE, 6) AS first_value, round(x[64]::DOUBLE, 6) AS last_value FROM e
    UNION ALL SELECT 'new-' || r.label || '-' || j, r.label, round(a.x[1] + (b.x[1]::DOUBLE - a.x[1]) * gap, 6), round(a.x[64] + (b.x[64]::DOUBLE - a.x[64]) * gap, 6)
    FROM r JOIN e a ON a.label = r.label AND a.pos = r.pos JOIN p ON p.id = a.id AND p.rank = r.rank JOIN e b ON b.id = p.other""",
)
def smote(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", F.col("label"), "embedding")
    out = M.smote(v, "vec_id", "label", "embedding")
    ends = out.select("vec_id", "label", F.col("embedding")[0].alias("first_value"), F.col("embedding")[63].alias("last_value"))
    return rounded(ends, 6, "first_value", "last_value")


@query(
    "smote_whole",
    f"""WITH e AS (SELECT vec_id::VARCHAR AS id, label, embedding::DOUBLE[] AS x, row_number() OVER (PARTITION BY label ORDER BY vec_id::VARCHAR) AS pos FROM embeddings),
    n AS (SELECT label, count(*) AS n, max(count(*)) OVER () - count(*) AS need FROM embeddings GROUP BY label),
    d AS (SELECT label, n, unnest(generate_series(1, need)) AS j FROM n WHERE need > 0),
    r AS (SELECT label, j, floor({_draw("a")} * n)::BIGINT + 1 AS pos, floor({_draw("b")} * least(5, n - 1))::BIGINT + 1 AS rank, {_draw("c")} AS gap FROM d),
    p AS (SELECT a.id, b.id AS other, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) AS rank
      FROM e a JOIN e b ON a.label = b.label AND a.id <> b.id WHERE a.label IN (SELECT label FROM n WHERE need > 0))
    SELECT 'new-' || r.label || '-' || j AS vec_id, i::INTEGER AS at, round(a.x[i + 1] + (b.x[i + 1] - a.x[i + 1]) * gap, 5) AS v
    FROM r JOIN e a ON a.label = r.label AND a.pos = r.pos JOIN p ON p.id = a.id AND p.rank = r.rank JOIN e b ON b.id = p.other, range(64) t(i)""",
)
def smote_whole(spark, sf):
    """All 64 numbers of every made row."""
    v = table(spark, sf, "embeddings").select("vec_id", F.col("label"), "embedding")
    made = M.smote(v, "vec_id", "label", "embedding").filter(F.startswith(F.col("vec_id"), F.lit("new")))
    return rounded(made.select("vec_id", F.posexplode("embedding").alias("at", "v")), 5, "v")


@query(
    "smote_balance",
    """SELECT label, count(*)::BIGINT AS n_before, (SELECT max(n) FROM (SELECT count(*) AS n FROM embeddings GROUP BY label))::BIGINT AS n_after
    FROM embeddings GROUP BY label""",
)
def smote_balance(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    out = M.smote(v, "vec_id", "label", "embedding")
    return out.groupBy("label").agg(
        F.count_if(~F.startswith(F.col("vec_id"), F.lit("new"))).alias("n_before"), F.count(F.lit(1)).alias("n_after")
    )


@query("isolation_rules", "SELECT l_orderkey, l_linenumber, count(*) AS n, true AS in_range FROM lineitem GROUP BY l_orderkey, l_linenumber")
def isolation_rules(spark, sf):
    """One score from 0 to 1 for every row."""
    scored = M.isolation_scores(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], NUM)
    return scored.groupBy("l_orderkey", "l_linenumber").agg(F.count("score").alias("n"), F.every(F.col("score").between(0, 1)).alias("in_range"))


@query("isolation_planted", "SELECT count(*) AS n_planted, true AS on_top FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 500 = 0")
def isolation_planted(spark, sf):
    """Rows with forty times their numbers stand among the highest scores: nine in ten at least."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *[c for c in NUM if c != "l_linenumber"])
    planted = (F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 500 == 0)
    feats = [c for c in NUM if c != "l_linenumber"]
    moved = li.withColumns({c: F.when(planted, F.col(c).cast("double") * 40 + 40).otherwise(F.col(c).cast("double")) for c in feats})
    scored = settle(M.isolation_scores(moved, ["l_orderkey", "l_linenumber", "l_partkey"], feats).withColumn("planted", planted))
    n = scored.filter("planted").count()
    top = scored.orderBy(F.desc("score"), "l_orderkey", "l_partkey").limit(n)
    return top.agg(F.lit(n).cast("bigint").alias("n_planted"), (F.count_if("planted") >= 0.9 * n).alias("on_top"))


@query("oof_rules", "SELECT doc_id, quality::DOUBLE AS label, 2 AS n_models, true AS in_range FROM labels JOIN documents USING (doc_id)")
def oof_rules(spark, sf):
    """Every labelled row is held out once and scored by each model of that fold."""
    scored = M.oof_scores(_labelled(spark, sf), "doc_id", TEXT, "quality", k=3, n_models=2)
    return scored.select("doc_id", "label", "n_models", F.col("proba").between(0, 1).alias("in_range"))


@query("prune_rules", "SELECT count(*) AS n, sum(place) AS places, 4 AS kept, true AS whole FROM (SELECT unnest([1, 2, 3, 4, 5]) AS place)")
def prune_rules(spark, sf):
    """Places 1 to n, the bottom quarter not kept, importances that sum to 1."""
    li = table(spark, sf, "lineitem").select(*NUM, (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    pruned = M.importance_prune(li, NUM, "returned", 0.25)
    whole = F.abs(F.sum("importance") - 1) < 1e-9
    return pruned.agg(F.count("*").alias("n"), F.sum("place").alias("places"), F.sum(F.col("kept").cast("int")).alias("kept"), whole.alias("whole"))


@query("isolation_scores")
def isolation_scores(spark, sf):
    li = table(spark, sf, "lineitem")
    return rounded(M.isolation_scores(li, ["l_orderkey", "l_linenumber", "l_partkey"], NUM), 9, "score")


@query("retrain_lag_linear")
def retrain_lag_linear(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id", "ts", "value")
    late = F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return M.retrain_lag_linear(e.withColumn("late", late), "value", ["ts", "event_id"], "event_type", 4, "late")


def _orthogonal(spark, sf, seq_len):
    """Least squares holds when what is left of a series has nothing in common with any of its lags."""
    e = table(spark, sf, "events").select("event_type", "event_id", "ts", "value")
    late = F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    fits = M.retrain_lag_linear(e.withColumn("late", late), "value", ["ts", "event_id"], "event_type", seq_len, "late")
    weights = fits.filter("phase = 'retrained'").select("event_type", "weights")
    made = M.supervised_windows(e, "value", ["ts", "event_id"], "event_type", seq_len).select("event_type", "x", "y")
    left = made.join(weights, "event_type").select("event_type", "x", "y", (F.col("y") - lag_linear(F.col("x"))).alias("left"))
    cells = left.select("event_type", "y", "left", F.posexplode("x").alias("lag", "v")).groupBy("event_type", "lag")
    small = F.abs(F.sum(F.col("left") * F.col("v"))) <= 1e-6 * F.sqrt(F.sum(F.col("y") * F.col("y")) * F.sum(F.col("v") * F.col("v")))
    return cells.agg(F.count(F.lit(1)).alias("n"), small.alias("orthogonal"))


def _orthogonal_sql(seq_len):
    return f"""SELECT event_type, lag::INTEGER AS lag, n - {seq_len} AS n, true AS orthogonal
    FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type), range({seq_len}) r(lag) WHERE n > {seq_len}"""


@query("retrain_lag_60", _orthogonal_sql(60))
def retrain_lag_60(spark, sf):
    return _orthogonal(spark, sf, 60)


@query("retrain_lag_180", _orthogonal_sql(180))
def retrain_lag_180(spark, sf):
    return _orthogonal(spark, sf, 180)


@query(
    "retrain_lag_one",
    """WITH l AS (SELECT event_type, value AS y, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS x, ts FROM events),
    p AS (SELECT *, 'original' AS phase FROM l WHERE ts < TIMESTAMP '2024-01-20' UNION ALL SELECT *, 'retrained' FROM l)
    SELECT event_type, phase, count(*)::BIGINT AS n, round(regr_intercept(y, x), 5) AS intercept, round(regr_slope(y, x), 5) AS slope,
      round(sqrt(regr_syy(y, x) * (1 - regr_r2(y, x)) / count(*)), 5) AS rmse FROM p WHERE x IS NOT NULL GROUP BY event_type, phase""",
)
def retrain_lag_one(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id", "ts", "value")
    late = F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    out = M.retrain_lag_linear(e.withColumn("late", late), "value", ["ts", "event_id"], "event_type", 1, "late")
    flat = out.select("event_type", "phase", "n", F.get("weights", 0).alias("intercept"), F.get("weights", 1).alias("slope"), "rmse")
    return rounded(flat, 5, "intercept", "slope", "rmse")
