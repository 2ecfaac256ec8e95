"""Conversation histories and evaluation scores on the driver tables."""

from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..operators.relational import top_per_key
from .aggregates import rounded
from .registry import query, table

_QA = """qa AS (SELECT q.conv_id, q.turn, trim(q.text, ' ' || chr(10)) AS question, trim(a.text, ' ' || chr(10)) AS answer FROM conversations q
  JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 WHERE q.role = 'user' AND a.role = 'assistant')"""


def _pairs(spark, sf):
    return E.question_answers(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


@query(
    "drop_empty_reasons",
    """SELECT coalesce(CASE WHEN turn % 7 = 0 THEN 'empty_question' WHEN turn % 5 = 0 THEN 'empty_answer' WHEN role = 'system' THEN 'empty_context' END, 'kept')
      AS reason, count(*)::BIGINT AS n FROM conversations GROUP BY 1""",
)
def drop_empty_reasons(spark, sf):
    c = table(spark, sf, "conversations")
    q = F.when(F.col("turn") % 7 != 0, F.col("text"))
    a = F.when(F.col("turn") % 5 != 0, F.col("text")).otherwise(" ")
    ctx = F.when(F.col("role") != "system", F.array("text")).otherwise(F.array().cast("array<string>"))
    reason = F.coalesce(E.drop_reason(q, a, ctx), F.lit("kept"))
    return c.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "history_last20",
    """WITH r AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN '사용자: ' ELSE '어시스턴트: ' END || trim(text, ' ' || chr(10)) AS line,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS b FROM conversations WHERE trim(text, ' ' || chr(10)) <> '')
    SELECT conv_id, count(*)::BIGINT AS n_lines, md5(string_agg(line, chr(10) ORDER BY turn)) AS history_md5 FROM r WHERE b <= 20 GROUP BY conv_id""",
)
def history_last20(spark, sf):
    out = E.history_text(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    return out.select("conv_id", "n_lines", F.md5("history").alias("history_md5"))


@query(
    "history_user",
    """SELECT conv_id, substr(string_agg(role || ':' || text, chr(10) ORDER BY turn), 1, 2000) AS history
    FROM conversations WHERE role = 'user' GROUP BY conv_id""",
)
def history_user(spark, sf):
    return E.user_history(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


def _cosine_sql(pairs):
    return f"""p AS ({pairs}),
    u AS (SELECT *, regexp_extract_all(lower(a), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS ta, regexp_extract_all(lower(b), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS tb FROM p),
    t AS (SELECT conv_id, turn, unnest(ta) AS t, 1 AS x, 0 AS y FROM u UNION ALL SELECT conv_id, turn, unnest(tb), 0, 1 FROM u
      UNION ALL SELECT conv_id, turn, unnest(list_transform(range(1, len(ta)), lambda i: ta[i] || ' ' || ta[i + 1])), 1, 0 FROM u
      UNION ALL SELECT conv_id, turn, unnest(list_transform(range(1, len(tb)), lambda i: tb[i] || ' ' || tb[i + 1])), 0, 1 FROM u),
    c AS (SELECT conv_id, turn, t, sum(x) AS x, sum(y) AS y, CASE WHEN sum(x) > 0 AND sum(y) > 0 THEN 1.0 ELSE 1 + ln(1.5) END AS idf FROM t GROUP BY conv_id, turn, t),
    s AS (SELECT conv_id, turn, sum(x * y * idf * idf) AS dot, sqrt(sum(x * x * idf * idf)) * sqrt(sum(y * y * idf * idf)) AS norm FROM c GROUP BY conv_id, turn),
    f AS (SELECT conv_id, turn, CASE WHEN norm > 0 THEN dot / norm ELSE 0 END AS cosine FROM p LEFT JOIN s USING (conv_id, turn))"""


@query(
    "tfidf_pair_cosine",
    f"WITH {_QA}, {_cosine_sql('SELECT conv_id, turn, question AS a, answer AS b FROM qa')} SELECT conv_id, turn, round(cosine, 6) AS cosine FROM f",
)
def tfidf_pair_cosine(spark, sf):
    out = E.tfidf_pairs(_pairs(spark, sf), ["conv_id", "turn"], {"qa": (F.col("question"), F.col("answer"))})
    return rounded(out.drop("pair"), 6, "cosine")


_CTX = """cx AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS ctx, count(*) AS n FROM (SELECT conv_id, turn, substr(text, 1, 800) AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations WHERE role = 'user') WHERE rn <= 4 GROUP BY conv_id)"""


def _contexts(spark, sf):
    """First four user texts and first four system texts of each conversation."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    top = top_per_key(c, ["conv_id", "role"], "turn", 4)
    pick = lambda role: F.sort_array(F.collect_list(F.when(F.col("role") == role, F.struct("turn", "text"))))
    out = top.groupBy("conv_id").agg(pick("system").alias("s"), pick("user").alias("u"))
    return out.select("conv_id", F.col("s.text").alias("ranked"), F.col("u.text").alias("docs"))


@query(
    "contexts_topk",
    """WITH r AS (SELECT conv_id, turn, role, substr(text, 1, 800) AS text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn FROM conversations),
    a AS (SELECT conv_id, string_agg(text, '|' ORDER BY turn) FILTER (role = 'system') AS s, string_agg(text, '|' ORDER BY turn) FILTER (role = 'user') AS u
      FROM r WHERE rn <= 4 GROUP BY conv_id) SELECT conv_id, coalesce(s, u, '') AS contexts FROM a""",
)
def contexts_topk(spark, sf):
    none = F.lit(None).cast("array<string>")
    picked = E.context_fallback([none, F.col("ranked"), F.col("docs")])
    return _contexts(spark, sf).select("conv_id", F.array_join(picked, "|").alias("contexts"))


@query(
    "fast_eval",
    f"""WITH {_QA}, {_CTX}, r AS (WITH {_cosine_sql('SELECT conv_id, turn, question AS a, answer AS b FROM qa')} SELECT * FROM f),
    l AS (WITH {_cosine_sql('SELECT conv_id, turn, answer AS a, ctx AS b FROM qa JOIN cx USING (conv_id)')} SELECT * FROM f)
    SELECT conv_id, turn, round(r.cosine, 6) AS answer_relevancy, round(l.cosine, 6) AS context_alignment, n::INTEGER AS ctx_count, length(answer)::INTEGER AS ans_len
    FROM qa JOIN cx USING (conv_id) JOIN r USING (conv_id, turn) JOIN l USING (conv_id, turn)""",
)
def fast_eval(spark, sf):
    ctx = _contexts(spark, sf).select("conv_id", E.context_fallback([F.col("docs")]).alias("contexts"))
    rows = _pairs(spark, sf).join(ctx, "conv_id")
    out = E.fast_eval(rows, ["conv_id", "turn"], "question", "answer", "contexts")
    return rounded(out, 6, "answer_relevancy", "context_alignment")


@query(
    "eval_records",
    f"""WITH {_QA} SELECT conv_id, turn, question, CASE WHEN turn % 3 = 0 THEN '' ELSE answer END AS reference_answer, 0::INTEGER AS n_gold
    FROM qa WHERE question <> ''""",
)
def eval_records(spark, sf):
    rows = _pairs(spark, sf).withColumn("ref", F.when(F.col("turn") % 3 != 0, F.col("answer")))
    out = E.eval_records(rows, "question", "ref")
    return out.select("conv_id", "turn", "question", "reference_answer", F.size("gold_contexts").alias("n_gold"))


@query(
    "eval_metric_list",
    f"""WITH {_QA} SELECT count(*)::BIGINT AS n, count(*) FILTER (turn % 3 <> 0 AND answer <> '')::BIGINT AS n_reference,
      'faithfulness,answer_relevancy,context_precision,context_recall' AS metrics FROM qa WHERE question <> ''""",
)
def eval_metric_list(spark, sf):
    rows = _pairs(spark, sf).withColumn("ref", F.when(F.col("turn") % 3 != 0, F.col("answer")))
    return E.has_reference(E.eval_records(rows, "question", "ref"))
