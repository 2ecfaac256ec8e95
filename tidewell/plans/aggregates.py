"""Grouped summaries, profiles and control checks on the driver tables."""

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..session import settle
from .registry import query, table

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
K_SQL = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"


def k_value():
    return F.get_json_object("props", "$.k").cast("double")


def rounded(df, digits, *cols):
    """Fixed digits, so that summation order does not show."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def _long_sql(expr, cols=NUM, table_name="lineitem"):
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {expr.format(c=c)} FROM {table_name}" for c in cols)


@query(
    "group_having",
    # The mean of whole numbers is rounded half up in integers: a cast from double would lose exact ties.
    """SELECT l_suppkey, ((200 * sum(l_linenumber) + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_rating, count(*)::BIGINT AS n
    FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 2""",
)
def group_having(spark, sf):
    li = table(spark, sf, "lineitem")
    out = li.groupBy("l_suppkey").agg(F.avg("l_linenumber").cast("decimal(3,2)").alias("avg_rating"), F.count(F.lit(1)).alias("n"))
    return out.filter("n >= 2").withColumn("avg_rating", F.col("avg_rating").cast("double"))


@query("group_mean", "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean FROM customer GROUP BY c_mktsegment")
def group_mean(spark, sf):
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.round(F.avg("c_acctbal"), 4).alias("mean"))


@query(
    "scalar_counts",
    """SELECT (SELECT count(*) FROM orders)::BIGINT AS n_orders, (SELECT count(*) FROM customer)::BIGINT AS n_customers,
      (SELECT count(*) FROM lineitem WHERE l_quantity > 25)::BIGINT AS n_large""",
)
def scalar_counts(spark, sf):
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    orders = table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n_orders"))
    big = table(spark, sf, "lineitem").filter("l_quantity > 25")
    return orders.select("n_orders", count(table(spark, sf, "customer")).alias("n_customers"), count(big).alias("n_large"))


@query(
    "value_distribution",
    """SELECT l_linenumber, count(*)::BIGINT AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct
    FROM lineitem GROUP BY l_linenumber""",
)
def value_distribution(spark, sf):
    return A.distribution(table(spark, sf, "lineitem"), "l_linenumber")


@query("value_counts", "SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY event_type")
def value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "events"), "event_type")


@query(
    "sum_even_squares",
    "SELECT sum(CAST(o_orderkey AS HUGEINT) * o_orderkey)::VARCHAR AS total FROM orders WHERE o_orderkey % 2 = 0",
)
def sum_even_squares(spark, sf):
    return A.even_square_sum(table(spark, sf, "orders"), "o_orderkey").select(F.col("total").cast("string").alias("total"))


@query(
    "distinct_summary",
    """SELECT count(DISTINCT event_type)::BIGINT AS n_types, count(DISTINCT user_id)::BIGINT AS n_users, count(*)::BIGINT AS n FROM events""",
)
def distinct_summary(spark, sf):
    return table(spark, sf, "events").agg(
        F.count_distinct("event_type").alias("n_types"), F.count_distinct("user_id").alias("n_users"), F.count(F.lit(1)).alias("n")
    )


@query(
    "distinct_values",
    """SELECT 'event_type' AS column_name, event_type AS value, count(*)::BIGINT AS n FROM events GROUP BY 2
    UNION ALL SELECT 'user_id', user_id::VARCHAR, count(*) FROM events GROUP BY 2""",
)
def distinct_values(spark, sf):
    return A.distinct_values(table(spark, sf, "events"), ["event_type", "user_id"])


_SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


@query(
    "distinct_sketch",
    "SELECT column_name, n_exact, true AS within_bound FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_exact FROM lineitem" for c in _SKETCHED)
    + ")",
)
def distinct_sketch(spark, sf):
    """Sketches stored per return flag and merged: within 3 % of the exact number."""
    li = table(spark, sf, "lineitem")
    stored = settle(A.distinct_sketches(li, _SKETCHED, ["l_returnflag"]))
    exact = li.agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED]).unpivot([], _SKETCHED, "column_name", "n_exact")
    merged = A.merge_sketches(stored).join(exact, "column_name")
    return merged.select("column_name", "n_exact", (F.abs(F.col("n_distinct") / F.col("n_exact") - 1) <= 0.03).alias("within_bound"))


@query(
    "column_profile",
    f"""SELECT column_name, count(v)::BIGINT AS n_values, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min, max(v) AS max,
      round(1.0 - count(v) / count(*)::DOUBLE, 6) AS missing_rate, round(quantile_cont(v, 0.25), 4) AS q0,
      round(quantile_cont(v, 0.5), 4) AS q1, round(quantile_cont(v, 0.75), 4) AS q2
    FROM ({_long_sql('CAST(CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE {c} END AS DOUBLE) AS v')}) GROUP BY column_name""",
)
def column_profile(spark, sf):
    li = table(spark, sf, "lineitem").select(
        *[F.when(F.col("l_orderkey") % 19 != 0, F.col(c).cast("double")).alias(c) for c in NUM]
    )
    out = A.column_profile(li, NUM)
    return rounded(rounded(out, 4, "mean", "std", "q0", "q1", "q2"), 6, "missing_rate")


@query(
    "param_summary",
    """SELECT event_type, count(*)::BIGINT AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min,
      max(value) AS max, round(100 * avg(CASE WHEN event_id % 7 = 0 THEN 1.0 ELSE 0.0 END), 4) AS flag_rate FROM events GROUP BY event_type""",
)
def param_summary(spark, sf):
    out = A.group_summary(table(spark, sf, "events"), "event_type", "value", F.col("event_id") % 7 == 0)
    return rounded(out, 4, "mean", "std", "flag_rate")


@query(
    "zscore_outliers",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, (SELECT count(*) FROM lineitem, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM lineitem)
        WHERE s > 0 AND abs({c} - m) / s > 1.5)::BIGINT AS n_outliers"""
        for c in NUM
    ),
)
def zscore_outliers(spark, sf):
    return A.zscore_outliers(table(spark, sf, "lineitem"), NUM, z=1.5)


@query(
    "top_std_cols",
    f"""SELECT column_name, round(stddev_samp(v), 4) AS std FROM ({_long_sql('CAST({c} AS DOUBLE) AS v')}) GROUP BY column_name
    ORDER BY stddev_samp(v) DESC LIMIT 3""",
)
def top_std_cols(spark, sf):
    return rounded(A.top_std(table(spark, sf, "lineitem"), NUM, 3), 4, "std")


@query(
    "spc_limits",
    """SELECT event_type, round(avg(value), 4) AS center, round(avg(value) - 3 * stddev_samp(value), 4) AS lcl,
      round(avg(value) + 3 * stddev_samp(value), 4) AS ucl, count(value)::BIGINT AS n FROM events GROUP BY event_type""",
)
def spc_limits(spark, sf):
    out = A.control_limits(table(spark, sf, "events"), "value", "event_type").drop("sigma")
    return rounded(out, 4, "center", "lcl", "ucl")


@query(
    "spc_points",
    """SELECT event_id, e.event_type, value FROM events e JOIN (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events
      GROUP BY event_type) l ON e.event_type = l.event_type WHERE value < m - 3 * s OR value > m + 3 * s""",
)
def spc_points(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    return A.out_of_control(e, "value", "event_type").select("event_id", "event_type", "value")


_PAIRS = [(a, b) for a in NUM for b in NUM if a != b]


@query(
    "corr_pairs",
    "SELECT col_a, col_b, round(r, 6) AS r FROM (VALUES "
    + ", ".join(f"({i}, '{a}', '{b}', (SELECT corr({a}, {b}) FROM lineitem))" for i, (a, b) in enumerate(_PAIRS))
    + ") t(i, col_a, col_b, r) WHERE abs(r) > 0.002 ORDER BY i LIMIT 15",
)
def corr_pairs(spark, sf):
    return rounded(A.corr_pairs(table(spark, sf, "lineitem"), NUM, min_abs=0.002), 6, "r")


@query(
    "corr_with_label",
    f"""SELECT column_name, round(r, 6) AS r FROM (SELECT 'value' AS column_name, corr(value, (value > 60)::INT) AS r FROM events
      UNION ALL SELECT 'k', corr({K_SQL}, (value > 60)::INT) FROM events
      UNION ALL SELECT 'user_id', corr(user_id, (value > 60)::INT) FROM events) WHERE abs(r) > 0.3""",
)
def corr_with_label(spark, sf):
    e = table(spark, sf, "events").select("value", k_value().alias("k"), "user_id")
    return rounded(A.corr_with_label(e, ["value", "k", "user_id"], F.col("value") > 60, 0.3), 6, "r")


LIMITS = [
    ("click", "value", 2.0, 150.0),
    ("click", "k", 5.0, 95.0),
    ("error", "value", 1.0, 120.0),
    ("error", "k", 10.0, 90.0),
    ("purchase", "value", 3.0, 200.0),
    ("view", "k", 1.0, 98.0),
]
LIMITS_SQL = "(VALUES " + ", ".join(f"('{g}', '{p}', {lo}, {hi})" for g, p, lo, hi in LIMITS) + ") l(event_type, param, lower, upper)"


def limits(spark):
    return spark.createDataFrame(LIMITS, "event_type string, param string, lower double, upper double")


_READ_SQL = f"""(SELECT event_id, event_type, 'value' AS param, value AS reading FROM events
  UNION ALL SELECT event_id, event_type, 'k', {K_SQL} FROM events)"""


@query(
    "threshold_join",
    f"SELECT event_id, r.event_type, r.param, reading FROM {_READ_SQL} r JOIN {LIMITS_SQL} USING (event_type, param) WHERE reading < lower OR reading > upper",
)
def threshold_join(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "value", k_value().alias("k"))
    return A.threshold_rows(e, limits(spark), "event_type", ["value", "k"], ["event_id"]).drop("lower", "upper")


@query(
    "threshold_violations",
    f"""SELECT event_type, param, max(lower IS NOT NULL) AS has_limits, count(*) FILTER (reading < lower)::BIGINT AS n_below,
      count(*) FILTER (reading > upper)::BIGINT AS n_above, min(reading) FILTER (reading < lower) AS min_below,
      max(reading) FILTER (reading > upper) AS max_above, count(*) FILTER (reading < lower OR reading > upper)::BIGINT AS n_total
    FROM {_READ_SQL} r LEFT JOIN {LIMITS_SQL} USING (event_type, param) GROUP BY event_type, param""",
)
def threshold_violations(spark, sf):
    e = table(spark, sf, "events").select("event_type", "value", k_value().alias("k"))
    return A.threshold_violations(e, limits(spark), "event_type", ["value", "k"])


@query(
    "defect_rate",
    """SELECT event_type, count(*)::BIGINT AS n, round(100 * avg(CASE WHEN event_id % 7 = 0 THEN 1.0 ELSE 0.0 END), 4) AS rate
    FROM events GROUP BY event_type UNION ALL SELECT '__all__', count(*), round(100 * avg(CASE WHEN event_id % 7 = 0 THEN 1.0 ELSE 0.0 END), 4) FROM events""",
)
def defect_rate(spark, sf):
    return rounded(A.flag_rate(table(spark, sf, "events"), "event_type", F.col("event_id") % 7 == 0), 4, "rate")


@query(
    "box_stats",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
      FROM events GROUP BY event_type),
    r AS (SELECT e.event_type, value, q1, median, q3, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM events e JOIN q USING (event_type))
    SELECT event_type, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
      min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside)::BIGINT AS n_outliers
    FROM r GROUP BY event_type""",
)
def box_stats(spark, sf):
    return rounded(A.box_stats(table(spark, sf, "events"), "value", "event_type"), 4, "q1", "median", "q3")


@query(
    "histogram",
    """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, (max(l_extendedprice) - min(l_extendedprice)) / 50 AS w FROM lineitem)
    SELECT bin::BIGINT AS bin, round(lo + bin * w, 4) AS left_edge, coalesce(n, 0)::BIGINT AS n FROM range(50) g(bin) CROSS JOIN e LEFT JOIN
      (SELECT least(floor((l_extendedprice - lo) / w), 49)::BIGINT AS bin, count(*) AS n FROM lineitem, e GROUP BY 1) c USING (bin)""",
)
def histogram(spark, sf):
    return rounded(A.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 50), 4, "left_edge")


@query(
    "error_metrics",
    f"""SELECT event_type, count(*)::BIGINT AS n, round(avg(abs(value - k)), 4) AS mae, round(sqrt(avg((value - k) * (value - k))), 4) AS rmse,
      round(max(abs(value - k)), 4) AS max_error, round(min(abs(value - k)), 4) AS min_error,
      round(100 * coalesce(avg(CASE WHEN abs(value) > 1e-8 THEN abs((value - k) / (value + 1e-8)) END), 0), 3) AS mape
    FROM (SELECT event_type, value, {K_SQL} AS k FROM events) GROUP BY event_type""",
)
def error_metrics(spark, sf):
    e = table(spark, sf, "events").select("event_type", "value", k_value().alias("k"))
    out = A.error_metrics(e, "value", "k", "event_type")
    return rounded(rounded(out, 4, "mae", "rmse", "max_error", "min_error"), 3, "mape")


@query(
    "column_lists",
    """WITH l AS (SELECT 's_name' AS column_name, s_suppkey, s_name AS v FROM supplier
      UNION ALL SELECT 's_nationkey', s_suppkey, CASE WHEN s_suppkey % 3 <> 0 THEN s_nationkey::VARCHAR END FROM supplier),
    r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY s_suppkey) AS rn FROM l WHERE v IS NOT NULL)
    SELECT column_name, ((rn - 1) // 40)::BIGINT AS part, string_agg(v, '|' ORDER BY rn) AS items FROM r GROUP BY column_name, part""",
)
def column_lists(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 3 != 0, F.col("s_nationkey")).alias("s_nationkey"))
    out = A.column_lists(s, ["s_name", "s_nationkey"], ["s_suppkey"], chunk=40)
    return out.withColumn("items", F.array_join("items", "|"))


@query(
    "variant_compare",
    """SELECT metric, coalesce(round(avg(score) FILTER (role = 'user'), 4), 0) AS "user",
      coalesce(round(avg(score) FILTER (role = 'assistant'), 4), 0) AS assistant, coalesce(round(avg(score) FILTER (role = 'tool'), 4), 0) AS tool
    FROM (SELECT role, 'chars' AS metric, length(text)::DOUBLE AS score FROM conversations
      UNION ALL SELECT role, 'turn', turn FROM conversations) GROUP BY metric""",
)
def variant_compare(spark, sf):
    c = table(spark, sf, "conversations").select("role", F.length("text").cast("double").alias("chars"), F.col("turn").cast("double").alias("turn"))
    scores = c.unpivot(["role"], ["chars", "turn"], "metric", "score")
    names = ["user", "assistant", "tool"]
    return rounded(A.side_by_side(scores, "metric", "role", "score", names), 4, *names)
