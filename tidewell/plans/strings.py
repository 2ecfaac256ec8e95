"""Scalar expressions on the driver tables."""

from pyspark.sql import functions as F

from ..functions import det
from ..functions import strings as S
from ..session import spread
from .registry import query, table


@query(
    "split_tags",
    "SELECT p_partkey, tag FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part)",
)
def split_tags(spark, sf):
    raw = F.concat(F.lit(" , "), F.replace("p_name", F.lit(" "), F.lit(" ,, ")), F.lit(","))
    return table(spark, sf, "part").select("p_partkey", F.explode(S.split_tags(raw)).alias("tag"))


_BLANKED = "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '  ' ELSE ' ' || source || ' ' END"


@query("safe_str", f"SELECT doc_id, coalesce(trim({_BLANKED}), '') AS s FROM documents")
def safe_str(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.safe_str(F.expr(_BLANKED)).alias("s"))


@query("join_parts", f"SELECT doc_id, concat_ws(' | ', nullif(trim({_BLANKED}), ''), lang) AS s FROM documents")
def join_parts(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.join_parts([F.expr(_BLANKED), "lang"], " | ").alias("s"))


@query(
    "coalesce_label",
    f"SELECT doc_id, coalesce(nullif(trim({_BLANKED}), ''), CASE WHEN doc_id % 2 = 0 THEN lang END, 'unknown') AS label FROM documents",
)
def coalesce_label(spark, sf):
    d = table(spark, sf, "documents")
    second = F.when(F.col("doc_id") % 2 == 0, F.col("lang"))
    return d.select("doc_id", S.first_non_empty([F.expr(_BLANKED), second]).alias("label"))


@query("truncate", "SELECT doc_id, substr(text, 1, 500) AS head, length(substr(text, 1, 1800)) AS n FROM documents")
def truncate(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.truncate("text", 500).alias("head"), F.length(S.truncate("text", 1800)).alias("n"))


@query("eq_ignore_case", "SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = 'building'")
def eq_ignore_case(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return c.filter(S.eq_ignore_case("c_mktsegment", F.lit("Building")))


@query(
    "tokenize",
    """SELECT doc_id, token, count(*)::BIGINT AS n FROM (SELECT doc_id,
      unnest(regexp_extract_all(lower(text), '[A-Za-z\\x{AC00}-\\x{D7A3}0-9]+')) AS token FROM documents)
    WHERE length(token) > 1 GROUP BY doc_id, token""",
)
def tokenize(spark, sf):
    d = spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.explode(S.tokens("text")).alias("token"))
    return d.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


@query(
    "strip_block",
    "SELECT doc_id, '[role]' || chr(10) || source || chr(10) || '[notes]' || chr(10) || md5(text) AS shown FROM documents",
)
def strip_block(spark, sf):
    d = table(spark, sf, "documents")
    head = F.concat(F.lit("[role]\n"), F.col("source"), F.lit("\n[task]\n"), F.col("text"))
    prompt = F.concat(head, F.lit("\n[notes]\n"), F.md5("text"), F.lit("\n[context]\n"), F.col("text"))
    shown = S.strip_block(S.strip_from(prompt, "context"), "task")
    return d.select("doc_id", shown.alias("shown"))


@query(
    "rewrite_links",
    """SELECT page_id, md5(regexp_replace(html, '(href|src)="/([^"]*)"', '\\1="https://site.example/\\2"', 'g')) AS html_md5,
      regexp_replace('see ![p](/figures/' || page_id || '.png)', '!\\[([^\\]]*)\\]\\(/figures/([^)]+)\\)',
        '![\\1](https://site.example/figures/\\2)', 'g') AS md FROM pages""",
)
def rewrite_links(spark, sf):
    md = F.concat(F.lit("see ![p](/figures/"), F.col("page_id"), F.lit(".png)"))
    return table(spark, sf, "pages").select(
        "page_id",
        F.md5(S.absolute_links("html", "https://site.example/")).alias("html_md5"),
        S.absolute_images(md, "figures", "https://site.example/").alias("md"),
    )


_SCORE_SQL = """CASE event_id % 4 WHEN 0 THEN '{"score": 0.' || json_extract_string(props, '$.k') || '}'
  WHEN 1 THEN 'about 0.' || json_extract_string(props, '$.k') || ' or so' WHEN 2 THEN props ELSE 'none' END"""


@query(
    "parse_score",
    f"""SELECT event_id, CASE WHEN event_id % 4 IN (0, 1) THEN
      CAST(regexp_extract(s, '(0(\\.[0-9]+)?|1(\\.0+)?)', 1) AS DOUBLE) ELSE 0.0 END AS score
    FROM (SELECT event_id, {_SCORE_SQL} AS s FROM events)""",
)
def parse_score(spark, sf):
    s = F.expr(_SCORE_SQL.replace("json_extract_string", "get_json_object"))
    return table(spark, sf, "events").select("event_id", S.parse_score(s).alias("score"))


@query("strip_fences", "SELECT conv_id, turn, trim(text, ' \n\t\r') AS text FROM conversations")
def strip_fences(spark, sf):
    c = table(spark, sf, "conversations")
    body = S.strip("text")
    fenced = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("```markdown\n"), body, F.lit("\n```\n"))).otherwise(body)
    return c.select("conv_id", "turn", S.strip_fences(fenced).alias("text"))


@query(
    "rule_failures",
    """SELECT c_custkey, array_to_string(list_filter([
      CASE WHEN NOT regexp_matches(c_name, '[a-z]') THEN 'lowercase' END,
      CASE WHEN NOT regexp_matches(c_name, '[A-Z]') THEN 'uppercase' END,
      CASE WHEN NOT regexp_matches(c_name, '[0-9]') THEN 'digit' END,
      CASE WHEN NOT regexp_matches(c_name, '[!@$%^&*]') THEN 'symbol' END], lambda x: x IS NOT NULL), ',') AS failed
    FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN lower(replace(c_name, '#', '')) WHEN 1 THEN upper(replace(c_name, '#', '!'))
      WHEN 2 THEN 'Customer' ELSE replace(c_name, '#', '@') END AS c_name FROM customer)""",
)
def rule_failures(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey",
        F.expr(
            """CASE c_custkey % 4 WHEN 0 THEN lower(replace(c_name, '#', '')) WHEN 1 THEN upper(replace(c_name, '#', '!'))
            WHEN 2 THEN 'Customer' ELSE replace(c_name, '#', '@') END"""
        ).alias("c_name"),
    )
    return c.select("c_custkey", F.array_join(S.failed_rules("c_name"), ",").alias("failed"))


@query(
    "validate_form",
    """SELECT doc_id, length(trim(name)) >= 2 AND regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') AND length(text) >= 6 AS ok
    FROM (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN ' ' || substr(source, 1, 1) ELSE source END AS name,
      CASE WHEN doc_id % 4 = 0 THEN source || '@mail' ELSE source || '@mail.example' END AS email FROM documents)""",
)
def validate_form(spark, sf):
    d = table(spark, sf, "documents")
    name = F.expr("CASE WHEN doc_id % 3 = 0 THEN ' ' || substr(source, 1, 1) ELSE source END")
    email = F.expr("CASE WHEN doc_id % 4 = 0 THEN source || '@mail' ELSE source || '@mail.example' END")
    return d.select("doc_id", S.valid_form(name, "lang", email, "text", "text").alias("ok"))


@query(
    "script_class",
    """WITH w AS (SELECT unnest(string_split(text, ' ')) AS w FROM documents),
    c AS (SELECT CASE WHEN regexp_matches(w, '^[\\x{C0}-\\x{24F}]+$') THEN 'first' WHEN regexp_matches(w, '^[a-zA-Z]+$') THEN 'second'
      WHEN regexp_matches(w, '[\\x{C0}-\\x{24F}]') AND regexp_matches(w, '[a-zA-Z]') THEN 'mixed'
      WHEN regexp_matches(w, '[\\x{C0}-\\x{24F}]') THEN 'has_first' WHEN regexp_matches(w, '[a-zA-Z]') THEN 'has_second'
      ELSE 'other' END AS script FROM (SELECT regexp_replace(w, '^[\\s]+|[\\s]+$', '', 'g') AS w FROM w))
    SELECT script, count(*)::BIGINT AS n FROM c GROUP BY script""",
)
def script_class(spark, sf):
    words = spread(table(spark, sf, "documents").select("text")).select(F.explode(F.split("text", " ", -1)).alias("w"))
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    kind = S.script_class("w", first=r"\x{C0}-\x{24F}")
    return counts.groupBy(kind.alias("script")).agg(F.sum("n").alias("n"))


@query(
    "band_case",
    """SELECT p_partkey, bmi, CASE WHEN bmi < 18.5 THEN 'underweight' WHEN bmi < 22.9 THEN 'normal' WHEN bmi < 24.9 THEN 'overweight'
      ELSE 'obese' END AS label FROM (SELECT p_partkey, round((40 + p_size) / pow(1.7, 2), 2) AS bmi FROM part)""",
)
def band_case(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", S.bmi(F.lit(40) + F.col("p_size"), F.lit(170.0)).alias("bmi"))
    return p.withColumn("label", S.band("bmi"))


_U1, _U2 = det.uniform_sql("o_orderkey", "c"), det.uniform_sql("o_orderkey", "r")


@query(
    "skewed_reviews",
    f"""SELECT o_orderkey AS review_id, floor(pow({_U1}, 2) * 1000)::BIGINT + 1 AS creator_id,
      floor({_U2} * 5)::BIGINT + 1 AS rating, 'auto review #' || o_orderkey AS review_text FROM orders""",
)
def skewed_reviews(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        S.skewed_index(det.uniform("o_orderkey", "c"), 1000).alias("creator_id"),
        (F.floor(det.uniform("o_orderkey", "r") * 5) + 1).alias("rating"),
        F.concat(F.lit("auto review #"), F.col("o_orderkey")).alias("review_text"),
    )


@query(
    "date_formats",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ymd, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp,
      CAST(o_orderdate AS DATE) AS parsed, CAST(o_orderdate AS DATE) AS short_parsed,
      o_orderdate + INTERVAL 18 HOUR AS evening FROM orders""",
)
def date_formats(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyyMMdd").alias("ymd"))
    return o.select(
        "o_orderkey",
        "ymd",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.to_date("ymd", "yyyyMMdd").alias("parsed"),
        S.short_year_date(F.date_format("o_orderdate", "yy/MM/dd")).alias("short_parsed"),
        F.to_timestamp_ntz(F.concat(F.col("ymd"), F.lit("1800")), F.lit("yyyyMMddHHmm")).alias("evening"),
    )


@query("token_estimate", "SELECT doc_id, greatest(1, floor(length(text) * 0.5))::BIGINT AS n FROM documents")
def token_estimate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.token_estimate("text").cast("bigint").alias("n"))
