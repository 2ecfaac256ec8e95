"""Streaming jobs over the driver tables, read as file streams."""

from pyspark.sql import functions as F

from ..streaming import jobs as ST
from .aggregates import K_SQL, LIMITS_SQL, k_value, limits, rounded
from .registry import query, table

HOUR = 3_600_000_000


def _stream(spark, sf, name):
    return ST.stream_files(spark, sf, table(spark, sf, name), f"{name}.parquet")


@query(
    "stream_hourly_rate",
    """SELECT event_type, date_trunc('hour', ts) AS bin, sum((event_id % 7 = 0)::INT)::BIGINT AS flagged, count(*)::BIGINT AS total,
      round(100.0 * sum((event_id % 7 = 0)::INT) / count(*), 6) AS rate FROM events GROUP BY 1, 2""",
)
def stream_hourly_rate(spark, sf):
    s = ST.hourly_rate(_stream(spark, sf, "events"), "ts", "event_type", F.col("event_id") % 7 == 0)
    return rounded(ST.run_update(s, ST.job_folder(spark, "hourly"), ["event_type", "bin"]), 6, "rate")


@query(
    "stream_alerts",
    f"""SELECT event_id, r.event_type, r.param, reading FROM (SELECT event_id, event_type, 'value' AS param, value AS reading FROM events
      UNION ALL SELECT event_id, event_type, 'k', {K_SQL} FROM events) r JOIN {LIMITS_SQL} USING (event_type, param) WHERE reading < lower OR reading > upper""",
)
def stream_alerts(spark, sf):
    e = _stream(spark, sf, "events").withColumn("k", k_value())
    return ST.run_append(ST.alerts(e, limits(spark), "event_type", ["value", "k"], ["event_id"]), ST.job_folder(spark, "alerts"))


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type, date_trunc('day', ts)::TIMESTAMP AS day FROM events")
def stream_dedupe(spark, sf):
    s = ST.distinct_per_day(_stream(spark, sf, "events"), ["user_id", "event_type"], "ts")
    return ST.run_append(s, ST.job_folder(spark, "dedupe"))


@query(
    "stream_corpus_add",
    """SELECT doc_id, source FROM documents d WHERE lang <> 'en' AND text NOT IN (SELECT text FROM documents WHERE lang = 'en')
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def stream_corpus_add(spark, sf):
    s = _stream(spark, sf, "documents").select("doc_id", "text", "source")
    seed = table(spark, sf, "documents").filter("lang = 'en'")
    return ST.corpus_add(s, seed, "text", ["doc_id"], ST.job_folder(spark, "corpus")).select("doc_id", "source")


@query(
    "stream_session_history",
    """WITH r AS (SELECT user_id, ts, event_type || ':' || event_id AS line, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS b,
      count(*) OVER (PARTITION BY user_id) AS n FROM events)
    SELECT user_id, count(*)::BIGINT AS n_lines, any_value(n)::BIGINT AS n_total, string_agg(line, chr(10) ORDER BY ts) AS history FROM r WHERE b <= 20 GROUP BY user_id""",
)
def stream_session_history(spark, sf):
    e = _stream(spark, sf, "events").withColumn("line", F.concat_ws(":", "event_type", F.col("event_id").cast("string")))
    return ST.run_update(ST.session_history(e, "user_id", "ts", "line"), ST.job_folder(spark, "history"), ["user_id"])


def _question_log(spark, sf):
    """A folder of JSON lines, one for each user turn; some are logged again a day later, some are cut off."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    turn = lambda name, by: c.select("conv_id", (F.col("turn") + by).alias("turn"), F.col("role").alias(f"{name}_role"), F.col("text").alias(name))
    told = c.filter("role = 'user'").join(turn("answer", -1).filter("answer_role = 'assistant'"), ["conv_id", "turn"], "left")
    told = told.join(turn("context", 1), ["conv_id", "turn"], "left")
    days = F.explode(F.when(F.col("conv_id") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    told = told.withColumn("day", days)
    ts = F.timestamp_seconds(F.col("day") * 86_400 + F.col("conv_id") % 86_400 + F.col("turn"))
    entry = F.struct(ts.alias("ts"), F.col("text").alias("question"), "answer", F.array_compact(F.array("context")).alias("contexts"))
    line = F.when(F.col("conv_id") % 11 == 0, F.left(F.to_json(entry), F.lit(40))).otherwise(F.to_json(entry))
    folder = ST.job_folder(spark, "log")
    told.select(line.alias("value")).write.text(folder)
    return folder


@query(
    "stream_eval_set",
    """SELECT DISTINCT trim(u.text, ' ' || chr(9) || chr(10) || chr(13)) AS question, '' AS reference_answer, 0 AS n_gold
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
    JOIN conversations p ON p.conv_id = u.conv_id AND p.turn = u.turn - 1
    WHERE u.role = 'user' AND u.conv_id % 11 <> 0 AND p.text IS NOT NULL AND trim(u.text, ' ' || chr(9) || chr(10) || chr(13)) <> ''
      AND trim(a.text, ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
)
def stream_eval_set(spark, sf):
    log = spark.readStream.text(_question_log(spark, sf))
    made = ST.run_append(ST.question_set(log), ST.job_folder(spark, "eval"))
    return made.select("question", "reference_answer", F.size("gold_contexts").alias("n_gold"))


@query(
    "stream_sessions",
    """WITH l AS (SELECT user_id, ts, event_type || ':' || event_id AS line, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, event_id FROM events),
    s AS (SELECT *, sum((before IS NULL OR ts - before > INTERVAL 6 HOURS)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM l),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id, no ORDER BY ts DESC, line DESC) AS back FROM s)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_total, string_agg(line, chr(10) ORDER BY ts, line) FILTER (back <= 20) AS history
    FROM r GROUP BY user_id, no""",
)
def stream_sessions(spark, sf):
    e = _stream(spark, sf, "events").withColumn("line", F.concat_ws(":", "event_type", F.col("event_id").cast("string")))
    found = ST.run_update(ST.sessions(e, "user_id", "ts", "line", 6 * 3600), ST.job_folder(spark, "sessions"), ["user_id", "session_start"])
    return found.filter("n_total > 0")


@query(
    "stream_drift",
    f"""WITH s AS (SELECT event_type, value - {K_SQL} AS e, unnest([0, 1, 2, 3]) AS i, epoch_us(ts) AS t FROM events)
    SELECT event_type, make_timestamp((t // {6 * HOUR} - i) * {6 * HOUR}) AS bin, count(*)::BIGINT AS n, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse
    FROM s GROUP BY 1, 2""",
)
def stream_drift(spark, sf):
    e = _stream(spark, sf, "events").withColumn("k", k_value())
    s = ST.sliding_error(e, "ts", "event_type", "value", "k")
    return rounded(ST.run_update(s, ST.job_folder(spark, "drift"), ["event_type", "bin"]), 4, "mae", "rmse")
