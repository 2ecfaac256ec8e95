"""Feature preparation and score metrics on the driver tables."""

from itertools import combinations

from pyspark.sql import functions as F

from ..functions import det
from ..operators import features as M
from .aggregates import rounded
from .registry import query, table

NUM = ["l_quantity", "l_extendedprice", "l_discount"]
IDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
IDS_SQL = ", ".join(IDS)
_GAP = "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE {c} END"


def _gappy(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*IDS, "l_shipdate", *[F.when(F.col("l_orderkey") % 7 != 0, F.col(c)).alias(c) for c in NUM])


@query(
    "median_impute",
    "WITH g AS (SELECT l_shipdate, " + IDS_SQL + ", " + ", ".join(f"{_GAP.format(c=c)} AS {c}" for c in NUM) + " FROM lineitem), "
    + "m AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m{i}" for i, c in enumerate(NUM)) + " FROM g WHERE l_shipdate < TIMESTAMP '1999-01-01') "
    + f"SELECT {IDS_SQL}, " + ", ".join(f"round(coalesce({c}, m{i}), 6) AS {c}" for i, c in enumerate(NUM)) + " FROM g, m",
)
def median_impute(spark, sf):
    g = _gappy(spark, sf)
    train = g.filter("l_shipdate < TIMESTAMP_NTZ'1999-01-01 00:00:00'")
    return rounded(M.impute(g, M.fit_medians(train, NUM), NUM).drop("l_shipdate"), 6, *NUM)


@query(
    "standard_scale",
    "WITH m AS (SELECT " + ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(NUM)) + " FROM lineitem) "
    + f"SELECT {IDS_SQL}, " + ", ".join(f"round(({c} - m{i}) / s{i}, 6) AS {c}" for i, c in enumerate(NUM)) + " FROM lineitem, m",
)
def standard_scale(spark, sf):
    li = table(spark, sf, "lineitem").select(*IDS, *NUM)
    return rounded(M.standardize(li, M.fit_standard(li, NUM), NUM), 6, *NUM)


@query(
    "interactions",
    f"SELECT {IDS_SQL}, " + ", ".join(f'round({a} * {b}, 6) AS "{a}*{b}"' for a, b in combinations(NUM, 2)) + " FROM lineitem",
)
def interactions(spark, sf):
    made = M.interactions(table(spark, sf, "lineitem").select(*IDS, *NUM), NUM).drop(*NUM)
    return made.select(*IDS, *[F.round(F.col(f"`{a}*{b}`"), 6).alias(f"{a}*{b}") for a, b in combinations(NUM, 2)])


@query("label_encode", "SELECT event_id, (dense_rank() OVER (ORDER BY event_type) - 1)::BIGINT AS code FROM events")
def label_encode(spark, sf):
    return M.label_encode(table(spark, sf, "events").select("event_id", "event_type"), "event_type").drop("event_type")


_RANKED = f"""(SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {det.hash52_sql("doc_id", "42")}, doc_id) AS rn,
  count(*) OVER (PARTITION BY quality) AS n FROM labels)"""


@query("stratified_split", f"SELECT doc_id, quality, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM {_RANKED}")
def stratified_split(spark, sf):
    return M.split(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality")


@query(
    "time_split",
    """SELECT event_id, CASE WHEN rn > n - ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM
    (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () AS n FROM events)""",
)
def time_split(spark, sf):
    return M.split(table(spark, sf, "events").select("event_id", "ts"), "event_id", time_col="ts").drop("ts")


@query("stratified_folds", f"SELECT doc_id, quality, ((rn - 1) % 5)::BIGINT AS fold FROM {_RANKED}")
def stratified_folds(spark, sf):
    return M.stratified_folds(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality")


@query(
    "bootstrap",
    "SELECT * FROM (SELECT doc_id, seed, ("
    + " + ".join(f"(u >= {p!r})::INT" for p in M.POISSON1)
    + f")::INTEGER AS weight FROM (SELECT doc_id, seed::INTEGER AS seed, {det.uniform_sql("(seed || ':' || doc_id)")} AS u FROM labels, (SELECT unnest([42, 43, 44]) AS seed))) WHERE weight > 0",
)
def bootstrap(spark, sf):
    return M.bootstrap(table(spark, sf, "labels").select("doc_id"), "doc_id", [42, 43, 44])


_SCORED = f"(SELECT doc_id, quality, 0.6 * {det.uniform_sql('doc_id', 's')} + 0.4 * quality * {det.uniform_sql('doc_id', 't')} AS score FROM labels)"


def scored(spark, sf):
    """Labels with a fixed score, so that metrics can be compared exactly."""
    score = 0.6 * det.uniform("doc_id", "s") + 0.4 * F.col("quality") * det.uniform("doc_id", "t")
    return table(spark, sf, "labels").select("doc_id", "quality", score.alias("score"))


@query(
    "f1_threshold_sweep",
    f"""WITH t AS (SELECT i, i * {(0.95 - 0.05) / 180!r} + 0.05 AS threshold FROM range(181) x(i)),
    c AS (SELECT i, any_value(threshold) AS threshold, sum((score >= threshold AND quality = 1)::INT)::BIGINT AS tp,
      sum((score >= threshold AND quality <> 1)::INT)::BIGINT AS fp, sum((score < threshold AND quality = 1)::INT)::BIGINT AS fn FROM {_SCORED}, t GROUP BY i),
    f AS (SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM c)
    SELECT round(threshold, 6) AS threshold, tp, fp, fn, round(f1, 6) AS f1, row_number() OVER (ORDER BY f1 DESC, i) = 1 AS is_best FROM f""",
)
def f1_threshold_sweep(spark, sf):
    return rounded(M.f1_threshold_sweep(scored(spark, sf), "quality", "score"), 6, "threshold", "f1")


@query(
    "ensemble_vote",
    f"""SELECT doc_id, round(p, 6) AS proba, (p >= 0.5)::INTEGER AS output FROM (SELECT doc_id, avg(u) AS p FROM
    (SELECT doc_id, {det.uniform_sql("(m || ':' || doc_id)")} AS u FROM labels, (SELECT unnest([0, 1, 2, 3, 4]) AS m)) GROUP BY doc_id)""",
)
def ensemble_vote(spark, sf):
    models = table(spark, sf, "labels").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("m"))
    proba = det.uniform(F.concat_ws(":", F.col("m").cast("string"), F.col("doc_id").cast("string")))
    return rounded(M.ensemble_vote(models.withColumn("proba", proba), "doc_id", "proba", 0.5), 6, "proba")


_PROBS = [0.90 + i * (0.995 - 0.90) / 11 for i in range(12)]


@query(
    "quantile_flags",
    " UNION ALL ".join(
        f"""SELECT round({p!r}, 6) AS quantile, round(any_value(t), 4) AS threshold, sum((l_extendedprice >= t)::INT)::BIGINT AS flagged
        FROM lineitem, (SELECT quantile_cont(l_extendedprice, {p!r}) AS t FROM lineitem)"""
        for p in _PROBS
    ),
)
def quantile_flags(spark, sf):
    return rounded(rounded(M.quantile_flags(table(spark, sf, "lineitem"), "l_extendedprice"), 4, "threshold"), 6, "quantile")


@query(
    "confusion",
    f"SELECT quality AS actual, (score >= 0.4)::INTEGER AS predicted, count(*)::BIGINT AS n FROM {_SCORED} GROUP BY 1, 2",
)
def confusion(spark, sf):
    s = scored(spark, sf).select(F.col("quality").alias("actual"), (F.col("score") >= 0.4).cast("int").alias("predicted"))
    return M.confusion(s, "actual", "predicted")


@query(
    "class_report",
    f"""WITH s AS (SELECT quality AS a, (score >= 0.4)::INTEGER AS p FROM {_SCORED}), l AS (SELECT unnest([0, 1]) AS label),
    r AS (SELECT label, sum((a = label)::INT)::BIGINT AS support, sum((a = label AND p = label)::INT) / sum((p = label)::INT)::DOUBLE AS precision,
      sum((a = label AND p = label)::INT) / sum((a = label)::INT)::DOUBLE AS recall FROM s, l GROUP BY label)
    SELECT label, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(2 * precision * recall / (precision + recall), 6) AS f1 FROM r""",
)
def class_report(spark, sf):
    s = scored(spark, sf).select(F.col("quality").alias("actual"), (F.col("score") >= 0.4).cast("int").alias("predicted"))
    return rounded(M.class_report(s, "actual", "predicted"), 6, "precision", "recall", "f1")


_COARSE = f"(SELECT quality, round(score, 2) AS score FROM {_SCORED})"


def _coarse(spark, sf):
    return scored(spark, sf).withColumn("score", F.round("score", 2))


@query(
    "roc_auc",
    f"""SELECT round(sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) / count(*), 6) AS roc_auc
    FROM {_COARSE} a, {_COARSE} b WHERE a.quality = 1 AND b.quality = 0""",
)
def roc_auc(spark, sf):
    return rounded(M.roc_auc(_coarse(spark, sf), "quality", "score"), 6, "roc_auc")


_CUM = f"""(SELECT score, p, q, sum(p) OVER (ORDER BY score DESC) AS tp, sum(q) OVER (ORDER BY score DESC) AS fp FROM
  (SELECT score, sum((quality = 1)::INT) AS p, sum((quality <> 1)::INT) AS q FROM {_COARSE} GROUP BY score))"""


@query("avg_precision", f"SELECT round(sum(p * tp / (tp + fp)::DOUBLE) / sum(p), 6) AS avg_precision FROM {_CUM}")
def avg_precision(spark, sf):
    return rounded(M.avg_precision(_coarse(spark, sf), "quality", "score"), 6, "avg_precision")


@query(
    "roc_curve",
    f"SELECT score, round(fp / (SELECT sum(q) FROM {_CUM})::DOUBLE, 6) AS fpr, round(tp / (SELECT sum(p) FROM {_CUM})::DOUBLE, 6) AS tpr FROM {_CUM}",
)
def roc_curve(spark, sf):
    return rounded(M.roc_curve(_coarse(spark, sf), "quality", "score"), 6, "fpr", "tpr")


_FIT = "(SELECT o_orderkey, o_totalprice AS a, avg(o_totalprice) OVER (PARTITION BY o_orderpriority, o_orderstatus) AS p FROM orders)"


def _fitted(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    keys = ["o_orderpriority", "o_orderstatus"]
    return o.join(o.groupBy(*keys).agg(F.avg("o_totalprice").alias("predicted")), keys)


@query(
    "regression_report",
    f"""SELECT count(*)::BIGINT AS n, round(1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)), 6) AS r2, round(avg(abs(a - p)), 4) AS mae,
      round(sqrt(avg((a - p) * (a - p))), 4) AS rmse FROM {_FIT}""",
)
def regression_report(spark, sf):
    out = M.regression_report(_fitted(spark, sf), "o_totalprice", "predicted")
    return rounded(rounded(out, 4, "mae", "rmse"), 6, "r2")


@query("residuals", f"SELECT o_orderkey, round(p, 4) AS predicted, round(a - p, 4) AS residual FROM {_FIT}")
def residuals(spark, sf):
    out = _fitted(spark, sf).withColumn("residual", F.col("o_totalprice") - F.col("predicted"))
    return rounded(out.select("o_orderkey", "predicted", "residual"), 4, "predicted", "residual")


@query(
    "run_log_latest",
    """SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, count(*)::BIGINT AS n_logged FROM events GROUP BY user_id, event_type""",
)
def run_log_latest(spark, sf):
    return M.latest_runs(table(spark, sf, "events"), ["user_id", "event_type"], "value", ["ts", "event_id"])
