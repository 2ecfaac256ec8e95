"""Time-series operators; a sensor is an event type, an as-of key a user."""

from pyspark.sql import functions as F

from ..functions import det
from ..operators import series as T
from .aggregates import K_SQL, k_value, rounded
from .registry import query, table

MINUTE, HOUR = 60_000_000, 3_600_000_000
W = "(PARTITION BY event_type ORDER BY ts, event_id)"


def _events(spark, sf):
    return table(spark, sf, "events").select("event_type", "event_id", "ts", "user_id", "value")


def _sparse(spark, sf):
    return _events(spark, sf).withColumn("value", F.when(F.col("event_id") % 3 != 0, F.col("value")))


@query("lag_feature", f"SELECT event_id, lag(value) OVER {W} AS input, value FROM events")
def lag_feature(spark, sf):
    return T.lag_feature(_events(spark, sf), "value", ["ts", "event_id"], "event_type").select("event_id", "input", "value")


@query(
    "ffill_bfill",
    f"""SELECT event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id),
      first_value(v IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled
    FROM (SELECT *, CASE WHEN event_id % 3 <> 0 THEN value END AS v FROM events)""",
)
def ffill_bfill(spark, sf):
    return T.fill_both(_sparse(spark, sf), "value", ["ts", "event_id"], "event_type").select("event_id", "filled")


@query(
    "median_gap",
    """WITH g AS (SELECT event_type, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts) AS gap
      FROM (SELECT DISTINCT event_type, ts FROM events))
    SELECT event_type, count(*)::BIGINT AS n_times, quantile_cont(gap::DOUBLE, 0.5) AS median_gap_us FROM g GROUP BY event_type""",
)
def median_gap(spark, sf):
    return T.median_gap(_events(spark, sf), "ts", "event_type")


@query(
    "asof_nearest",
    """WITH l AS (SELECT user_id, event_id AS left_id, ts AS left_ts FROM events WHERE event_type IN ('click', 'view')),
    r AS (SELECT user_id, event_id AS right_id, ts AS right_ts FROM events WHERE event_type = 'purchase'),
    g AS (SELECT user_id, left_ts, epoch_us(left_ts) - lag(epoch_us(left_ts)) OVER (PARTITION BY user_id ORDER BY left_ts) AS gap
      FROM (SELECT DISTINCT user_id, left_ts FROM l)),
    tol AS (SELECT user_id, CASE WHEN count(*) >= 3 AND median(gap) > 0 THEN floor(median(gap) * 0.6)::BIGINT ELSE 1000000 END AS tol
      FROM g GROUP BY user_id),
    u AS (SELECT user_id, epoch_us(right_ts) AS t, 0 AS tag, right_id AS id FROM r UNION ALL SELECT user_id, epoch_us(left_ts), 1, left_id FROM l),
    w AS (SELECT *, last_value(CASE WHEN tag = 0 THEN t END IGNORE NULLS) OVER a AS bt, last_value(CASE WHEN tag = 0 THEN id END IGNORE NULLS) OVER a AS bid,
      first_value(CASE WHEN tag = 0 THEN t END IGNORE NULLS) OVER z AS ft, first_value(CASE WHEN tag = 0 THEN id END IGNORE NULLS) OVER z AS fid FROM u
      WINDOW a AS (PARTITION BY user_id ORDER BY t, tag, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        z AS (PARTITION BY user_id ORDER BY t, tag, id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    c AS (SELECT user_id, id AS left_id, CASE WHEN ft IS NULL OR t - bt <= ft - t THEN bid ELSE fid END AS right_id,
      CASE WHEN ft IS NULL OR t - bt <= ft - t THEN t - bt ELSE ft - t END AS gap_us FROM w WHERE tag = 1)
    SELECT c.user_id, left_id, right_id, gap_us FROM c JOIN tol USING (user_id) WHERE gap_us <= tol""",
)
def asof_nearest(spark, sf):
    e = _events(spark, sf)
    left = e.filter(F.col("event_type").isin("click", "view")).select("user_id", F.col("event_id").alias("left_id"), F.col("ts").alias("left_ts"))
    right = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("right_id"), F.col("ts").alias("right_ts"))
    out = T.asof_nearest(left, right, ("left_ts", "right_ts"), ("left_id", "right_id"), "user_id")
    return out.select("user_id", "left_id", "right_id", "gap_us")


@query(
    "supervised_windows",
    """SELECT event_id, event_type, y, x[1] AS x_first, x[8] AS x_last, round(list_sum(x), 4) AS x_sum FROM
    (SELECT event_id, event_type, value AS y, list(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS x
     FROM events) WHERE len(x) = 8""",
)
def supervised_windows(spark, sf):
    out = T.supervised_windows(_events(spark, sf), "value", ["ts", "event_id"], "event_type", 8)
    return out.select(
        "event_id", "event_type", "y", F.get("x", 0).alias("x_first"), F.get("x", 7).alias("x_last"),
        F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 4).alias("x_sum"),
    )


_MM = "(SELECT event_type, min(value) AS lo, max(value) AS hi FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY event_type)"


def _minmax(spark, sf):
    e = _events(spark, sf)
    train = e.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return e, T.fit_minmax(train, "value", "event_type", (-1.0, 1.0))


@query(
    "minmax_scale",
    f"SELECT event_id, round((value - lo) / (hi - lo) * 2 - 1, 6) AS scaled FROM events JOIN {_MM} USING (event_type)",
)
def minmax_scale(spark, sf):
    e, params = _minmax(spark, sf)
    return rounded(T.scale(e, params, "value", "event_type").select("event_id", "scaled"), 6, "scaled")


@query("minmax_inverse", "SELECT event_id, round(value, 6) AS restored FROM events")
def minmax_inverse(spark, sf):
    e, params = _minmax(spark, sf)
    out = T.unscale(T.scale(e, params, "value", "event_type"), params, "scaled", "event_type")
    return rounded(out.select("event_id", "restored"), 6, "restored")


def _grid_sql(width, aggs):
    return f"""WITH b AS (SELECT event_type, epoch_us(ts) // {width} AS b, * EXCLUDE (event_type) FROM events),
    s AS (SELECT event_type, min(b) AS lo, max(b) AS hi FROM b GROUP BY event_type),
    g AS (SELECT event_type, unnest(generate_series(lo, hi)) AS b FROM s),
    a AS (SELECT event_type, b, {aggs} FROM b GROUP BY event_type, b)"""


@query(
    "resample_mean",
    _grid_sql(MINUTE, "round(avg(value), 6) AS mean")
    + f" SELECT event_type, make_timestamp(b * {MINUTE}) AS bin, mean FROM g LEFT JOIN a USING (event_type, b)",
)
def resample_mean(spark, sf):
    out = T.resample(_events(spark, sf), "ts", MINUTE, {"mean": F.avg("value")}, "event_type")
    return rounded(out, 6, "mean")


@query(
    "hourly_defect_rate",
    _grid_sql(HOUR, "sum((event_id % 7 = 0)::INT)::BIGINT AS flagged, count(*)::BIGINT AS total")
    + f""" SELECT event_type, make_timestamp(b * {HOUR}) AS bin, coalesce(flagged, 0) AS flagged, coalesce(total, 0) AS total,
      round(100.0 * flagged / total, 6) AS rate FROM g LEFT JOIN a USING (event_type, b)""",
)
def hourly_defect_rate(spark, sf):
    out = T.rate_per_bin(_events(spark, sf), "ts", F.col("event_id") % 7 == 0, HOUR, "event_type")
    return rounded(out, 6, "rate")


@query(
    "densify_index",
    f"""SELECT event_type, ((rn - 1) * 3 + i)::BIGINT AS at, round(value + coalesce((nxt - value) * i / 3, 0), 6) AS value FROM
    (SELECT event_type, value, row_number() OVER {W} AS rn, lead(value) OVER {W} AS nxt FROM events), (SELECT unnest([0, 1, 2]) AS i)
    WHERE i = 0 OR nxt IS NOT NULL""",
)
def densify_index(spark, sf):
    return rounded(T.densify_index(_events(spark, sf), "value", ["ts", "event_id"], "event_type", 3), 6, "value")


@query(
    "densify_time",
    f"""WITH p AS (SELECT event_type, epoch_us(ts) AS t, value, lead(epoch_us(ts)) OVER {W} AS t2, lead(value) OVER {W} AS v2,
      min(epoch_us(ts)) OVER (PARTITION BY event_type) AS s FROM events),
    m AS (SELECT event_type, greatest(1, floor(floor(median(t2 - t)) / 2))::BIGINT AS step FROM p GROUP BY event_type),
    r AS (SELECT *, ceil((t - s) / step::DOUBLE)::BIGINT AS lo,
      CASE WHEN t2 IS NULL THEN floor((t - s) / step::DOUBLE)::BIGINT ELSE ceil((t2 - s) / step::DOUBLE)::BIGINT - 1 END AS hi
      FROM p JOIN m USING (event_type)),
    k AS (SELECT *, unnest(generate_series(lo, hi)) AS k FROM r WHERE hi >= lo)
    SELECT event_type, k AS at, make_timestamp(s + k * step) AS ts,
      round(value + coalesce((v2 - value) * ((s + k * step - t) / (t2 - t)::DOUBLE), 0), 6) AS value FROM k""",
)
def densify_time(spark, sf):
    return rounded(T.densify_time(_events(spark, sf), "ts", "value", "event_type", 2, "event_id"), 6, "value")


@query(
    "ratio_split",
    f"""WITH r AS (SELECT event_type, event_id, row_number() OVER {W} AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events),
    c AS (SELECT *, greatest(1, floor(n * 0.75)) AS pre FROM r)
    SELECT event_type, event_id, CASE WHEN rn <= pre THEN 'pretrain' WHEN rn <= least(greatest(pre + 1, floor(n * 0.95)), n - 1) THEN 'finetune'
      ELSE 'holdout' END AS part FROM c""",
)
def ratio_split(spark, sf):
    return T.split_by_position(_events(spark, sf), ["ts", "event_id"], "event_type").select("event_type", "event_id", "part")


@query(
    "index_split",
    f"""SELECT event_type, event_id, CASE WHEN rn <= 100 THEN 'original' ELSE 'retrain' END AS part FROM
    (SELECT event_type, event_id, row_number() OVER {W} AS rn FROM events) WHERE rn <= 100 OR rn > 118""",
)
def index_split(spark, sf):
    return T.split_at(_events(spark, sf), ["ts", "event_id"], "event_type", 100, 18).select("event_type", "event_id", "part")


@query(
    "year_split_windows",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) < 2000 THEN 'train' ELSE 'test' END AS part, o_totalprice AS y, round(list_sum(x), 2) AS x_sum
    FROM (SELECT *, list(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS x FROM orders)
    WHERE len(x) = 60""",
)
def year_split_windows(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    made = T.supervised_windows(o, "o_totalprice", ["o_orderdate", "o_orderkey"], None, 60)
    out = T.split_by_year(made, "o_orderdate", 2000)
    return out.select("o_orderkey", "part", "y", F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 2).alias("x_sum"))


@query(
    "one_step_score",
    """SELECT event_id, round(predicted, 6) AS predicted, round(value - predicted, 6) AS error FROM
    (SELECT event_id, value, CASE WHEN count(*) OVER w = 8 THEN avg(value) OVER w ELSE value END AS predicted FROM events
     WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING))""",
)
def one_step_score(spark, sf):
    out = T.one_step_score(_events(spark, sf), "value", ["ts", "event_id"], "event_type", 8)
    return rounded(out.select("event_id", "predicted", "error"), 6, "predicted", "error")


@query(
    "multi_step",
    """WITH t AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS b FROM events),
    s AS (SELECT event_type, list(value ORDER BY b DESC) AS x FROM t WHERE b <= 4 GROUP BY event_type),
    p1 AS (SELECT *, (x[1] + x[2] + x[3] + x[4]) / 4 AS a FROM s),
    p2 AS (SELECT *, (x[2] + x[3] + x[4] + a) / 4 AS b FROM p1),
    p3 AS (SELECT *, (x[3] + x[4] + a + b) / 4 AS c FROM p2)
    SELECT event_type, 1 AS step, round(a, 6) AS predicted FROM p3 UNION ALL SELECT event_type, 2, round(b, 6) FROM p3
    UNION ALL SELECT event_type, 3, round(c, 6) FROM p3""",
)
def multi_step(spark, sf):
    return rounded(T.multi_step(_events(spark, sf), "value", ["ts", "event_id"], "event_type", 4, 3), 6, "predicted")


def _lag_fit_sql(n: int = 4) -> str:
    """Least squares on ``n`` lags by orthogonalising one lag after the other; ``fit`` has a row per event."""
    x = [f"x{k}" for k in range(1, n + 1)]
    names = [*x, "y"]
    lags = ", ".join(f"lag(value, {n + 1 - k}) OVER o AS x{k}" for k in range(1, n + 1))
    steps = [
        f"w AS (SELECT event_type, event_id, ts, value AS y, {lags}, row_number() OVER o AS rn FROM events WINDOW o AS {W})",
        "z0 AS (SELECT *, " + ", ".join(f"{c} - avg({c}) OVER p AS z_{c}, avg({c}) OVER p AS m_{c}" for c in names)
        + f" FROM w WHERE rn > {n} WINDOW p AS (PARTITION BY event_type))",
    ]
    for k, c in enumerate(x):
        rest = names[k + 1 :]
        ratio = ", ".join(f"sum(z_{c} * z_{d}) OVER p / sum(z_{c} * z_{c}) OVER p AS r_{c}_{d}" for d in rest)
        steps.append(f"r{k} AS (SELECT *, {ratio} FROM z{k} WINDOW p AS (PARTITION BY event_type))")
        less = ", ".join(f"z_{d} - r_{c}_{d} * z_{c} AS z_{d}" for d in rest)
        steps.append(f"z{k + 1} AS (SELECT * REPLACE ({less}) FROM r{k})")
    last = f"z{n}"
    for k in range(n - 1, -1, -1):
        c = x[k]
        later = "".join(f" - r_{c}_{d} * b_{d}" for d in x[k + 1 :])
        steps.append(f"b{k} AS (SELECT *, r_{c}_y{later} AS b_{c} FROM {last})")
        last = f"b{k}"
    steps.append(f"fit AS (SELECT *, m_y" + "".join(f" - b_{c} * m_{c}" for c in x) + f" AS b_0, y - z_y AS predicted FROM {last})")
    return ", ".join(steps)


def _lag_weights(spark, sf, e, seq_len):
    from ..operators import models as M

    stats = M.lag_statistics(e, "value", ["ts", "event_id"], "event_type", seq_len)
    return M.solve_lag_linear(stats, "event_type").select("event_type", "weights")


@query(
    "one_step_lag",
    f"""WITH {_lag_fit_sql()} SELECT event_id, round(coalesce(f.predicted, e.value), 4) AS predicted, round(e.value - coalesce(f.predicted, e.value), 4) AS error
    FROM events e LEFT JOIN fit f USING (event_id)""",
)
def one_step_lag(spark, sf):
    """Four lags, weighted by each type's own least-squares fit."""
    e = _events(spark, sf)
    out = T.one_step_score(e, "value", ["ts", "event_id"], "event_type", 4, T.lag_linear, params=_lag_weights(spark, sf, e, 4))
    return rounded(out.select("event_id", "predicted", "error"), 4, "predicted", "error")


@query(
    "multi_step_lag",
    f"""WITH {_lag_fit_sql()}, b AS (SELECT event_type, any_value(b_0) AS b0, any_value(b_x1) AS b1, any_value(b_x2) AS b2, any_value(b_x3) AS b3, any_value(b_x4) AS b4
      FROM fit GROUP BY event_type),
    t AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS back FROM events),
    s AS (SELECT event_type, list(value ORDER BY back DESC) AS x FROM t WHERE back <= 4 GROUP BY event_type),
    p1 AS (SELECT *, b0 + b1 * x[1] + b2 * x[2] + b3 * x[3] + b4 * x[4] AS f1 FROM s JOIN b USING (event_type)),
    p2 AS (SELECT *, b0 + b1 * x[2] + b2 * x[3] + b3 * x[4] + b4 * f1 AS f2 FROM p1),
    p3 AS (SELECT *, b0 + b1 * x[3] + b2 * x[4] + b3 * f1 + b4 * f2 AS f3 FROM p2)
    SELECT event_type, 1 AS step, round(f1, 4) AS predicted FROM p3 UNION ALL SELECT event_type, 2, round(f2, 4) FROM p3
    UNION ALL SELECT event_type, 3, round(f3, 4) FROM p3""",
)
def multi_step_lag(spark, sf):
    e = _events(spark, sf)
    out = T.multi_step(e, "value", ["ts", "event_id"], "event_type", 4, 3, T.lag_linear, _lag_weights(spark, sf, e, 4))
    return rounded(out, 4, "predicted")


@query(
    "supervised_windows_whole",
    """SELECT event_id, array_to_string(list_transform(x, lambda v: round(v * 10000)::BIGINT), ',') AS x FROM
    (SELECT event_id, list(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS x
     FROM events) WHERE len(x) = 8""",
)
def supervised_windows_whole(spark, sf):
    """Every value of every window."""
    out = T.supervised_windows(_events(spark, sf), "value", ["ts", "event_id"], "event_type", 8)
    return out.select("event_id", F.array_join(F.transform("x", lambda v: F.round(v * 10000).cast("bigint").cast("string")), ",").alias("x"))


@query(
    "resample_if_needed",
    f"""WITH n AS (SELECT *, row_number() OVER {W} AS rn FROM events),
    e2 AS (SELECT event_type, CASE WHEN event_type = 'view' THEN TIMESTAMP '2024-01-01' + to_seconds(rn * 90) ELSE ts END AS ts, value FROM n),
    b AS (SELECT event_type, epoch_us(ts) // {HOUR} AS b, value FROM e2 WHERE event_type <> 'view'),
    g AS (SELECT event_type, unnest(generate_series(min(b), max(b))) AS b FROM b GROUP BY event_type),
    a AS (SELECT event_type, b, avg(value) AS mean FROM b GROUP BY event_type, b)
    SELECT event_type, ts AS bin, round(value, 6) AS mean FROM e2 WHERE event_type = 'view'
    UNION ALL SELECT event_type, make_timestamp(b * {HOUR}), round(mean, 6) FROM g LEFT JOIN a USING (event_type, b)""",
)
def resample_if_needed(spark, sf):
    """One type is given even stamps and stays as it is."""
    placed = T.with_position(_events(spark, sf), ["ts", "event_id"], "event_type")
    even = T.from_micros(F.lit(1_704_067_200_000_000) + F.col("rn") * 90_000_000)
    e = placed.withColumn("ts", F.when(F.col("event_type") == "view", even).otherwise(F.col("ts").cast("timestamp_ntz")))
    return rounded(T.resample_if_needed(e, "ts", "value", HOUR, "event_type"), 6, "mean")


@query(
    "align_position",
    """WITH l AS (SELECT user_id, event_id AS left_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'click'),
    r AS (SELECT user_id, event_id AS right_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'purchase')
    SELECT user_id, left_id, right_id, NULL::BIGINT AS gap_us FROM l JOIN r USING (user_id, rn)""",
)
def align_position(spark, sf):
    """Purchases moved a year on match no click in time, so rows are paired by position."""
    e = _events(spark, sf)
    left = e.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("left_id"), F.col("ts").alias("left_ts"))
    late = T.from_micros(T.micros("ts") + 366 * 24 * HOUR)
    right = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("right_id"), late.alias("right_ts"))
    out, _ = T.align(left, right, ("left_ts", "right_ts"), ("left_id", "right_id"), "user_id")
    return out.select("user_id", "left_id", "right_id", "gap_us")


@query(
    "align_time",
    """WITH l AS (SELECT user_id, event_id AS left_id, epoch_us(ts) AS t FROM events),
    r AS (SELECT user_id, event_id AS right_id, epoch_us(ts) + event_id % 3 - 1 AS t FROM events)
    SELECT user_id, left_id, right_id, gap_us FROM (
      SELECT l.user_id, left_id, right_id, abs(r.t - l.t) AS gap_us, row_number() OVER (PARTITION BY left_id ORDER BY abs(r.t - l.t), r.t, right_id) AS place
      FROM l JOIN r ON l.user_id = r.user_id AND abs(r.t - l.t) <= 2) WHERE place = 1""",
)
def align_time(spark, sf):
    """Every event matches a copy of itself moved by a microsecond at most: all rows match, none is paired by position."""
    e = _events(spark, sf)
    left = e.select("user_id", F.col("event_id").alias("left_id"), F.col("ts").alias("left_ts"))
    moved = T.from_micros(T.micros("ts") + F.col("event_id") % 3 - 1)
    right = e.select("user_id", F.col("event_id").alias("right_id"), moved.alias("right_ts"))
    out, _ = T.align(left, right, ("left_ts", "right_ts"), ("left_id", "right_id"), "user_id", tolerance=2)
    return out.select("user_id", "left_id", "right_id", "gap_us")


@query(
    "future_stamps",
    f"""WITH l AS (SELECT user_id, max(ts) AS last FROM events GROUP BY user_id),
    s AS (SELECT user_id, last, i AS step, 15 + floor({det.uniform_sql("(user_id || '|' || i)")} * 6)::BIGINT AS sec FROM l, range(1, 11) x(i))
    SELECT user_id, step::INTEGER AS step, make_timestamp(epoch_us(last) + (sum(sec) OVER (PARTITION BY user_id ORDER BY step))::BIGINT * 1000000) AS ts FROM s""",
)
def future_stamps(spark, sf):
    return T.future_stamps(_events(spark, sf), "ts", "user_id", 10)


@query(
    "drift_report",
    f"""WITH r AS (SELECT event_type, value - {K_SQL} AS e, row_number() OVER {W} AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events),
    p AS (SELECT event_type, count(*) FILTER (rn <= n // 2)::BIGINT AS section1_n, avg(abs(e)) FILTER (rn <= n // 2) AS section1_mae,
      sqrt(avg(e * e) FILTER (rn <= n // 2)) AS section1_rmse, max(abs(e)) FILTER (rn <= n // 2) AS section1_max_error,
      count(*) FILTER (rn > n // 2)::BIGINT AS section2_n, avg(abs(e)) FILTER (rn > n // 2) AS section2_mae,
      sqrt(avg(e * e) FILTER (rn > n // 2)) AS section2_rmse, max(abs(e)) FILTER (rn > n // 2) AS section2_max_error FROM r GROUP BY event_type)
    SELECT event_type, section1_n, section2_n, round(section1_mae, 4) AS section1_mae, round(section1_rmse, 4) AS section1_rmse,
      round(section1_max_error, 4) AS section1_max_error, round(section2_mae, 4) AS section2_mae, round(section2_rmse, 4) AS section2_rmse,
      round(section2_max_error, 4) AS section2_max_error, round(section2_rmse - section1_rmse, 4) AS rmse_diff,
      round(100 * (section2_rmse - section1_rmse) / section1_rmse, 4) AS rmse_change_pct,
      CASE WHEN 100 * (section2_rmse - section1_rmse) / section1_rmse > 1 THEN 'retrain' ELSE 'keep' END AS recommendation FROM p""",
)
def drift_report(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id", "ts", "value", k_value().alias("k"))
    out = T.drift_report(e, "value", "k", ["ts", "event_id"], "event_type", warn_pct=1.0)
    nums = [c for c in out.columns if c not in ("event_type", "section1_n", "section2_n", "recommendation")]
    return rounded(out, 4, *nums)
