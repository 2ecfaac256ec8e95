"""Projections, filters, joins, ranking, paging and set operations on the driver tables."""

from pyspark.sql import functions as F

from ..functions import jsontext as J
from ..operators import relational as R
from .registry import query, table

META_SQL = """CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '{"z": 1}'
 WHEN event_id % 5 = 0 THEN '{"k": "x", "n": {"a": [1, 2]}}' ELSE props END"""


def _meta(events):
    """Events with JSON text that also has null, missing-key and nested documents."""
    return events.withColumn("metadata", F.expr(META_SQL))


@query("select_alias", "SELECT p_name AS product, p_retailprice AS list_price FROM part")
def select_alias(spark, sf):
    return R.select_as(table(spark, sf, "part"), {"p_name": "product", "p_retailprice": "list_price"})


@query(
    "ilike_and_eq",
    "SELECT p_partkey, p_name, p_type FROM part WHERE p_name ILIKE '%RED%' AND p_type = 'ECONOMY'",
)
def ilike_and_eq(spark, sf):
    p = table(spark, sf, "part")
    return p.filter(F.col("p_name").ilike("%RED%") & (F.col("p_type") == "ECONOMY")).select("p_partkey", "p_name", "p_type")


@query("ilike_or", "SELECT doc_id, source FROM documents WHERE text ILIKE '%license%' OR text ILIKE '%TION%'")
def ilike_or(spark, sf):
    d = table(spark, sf, "documents")
    return d.filter(F.col("text").ilike("%license%") | F.col("text").ilike("%TION%")).select("doc_id", "source")


@query(
    "json_not_contains",
    f"""SELECT event_id FROM (SELECT event_id, {META_SQL} AS m FROM events)
    WHERE m IS NOT NULL AND NOT coalesce(json_extract_string(m, '$.k') = 'x'
      AND json_extract_string(m, '$.n.a[0]') = '1', false)""",
)
def json_not_contains(spark, sf):
    e = _meta(table(spark, sf, "events"))
    return e.filter(~J.json_contains("metadata", {"k": "x", "n": {"a": [1]}})).select("event_id")


@query(
    "json_extract_eq",
    f"SELECT event_id FROM (SELECT event_id, {META_SQL} AS m FROM events) WHERE json_extract_string(m, '$.k') = '69'",
)
def json_extract_eq(spark, sf):
    e = _meta(table(spark, sf, "events"))
    return e.filter(J.json_text("metadata", "k") == "69").select("event_id")


@query(
    "json_has_key",
    f"SELECT event_id FROM (SELECT event_id, {META_SQL} AS m FROM events) WHERE list_contains(json_keys(m), 'z')",
)
def json_has_key(spark, sf):
    return _meta(table(spark, sf, "events")).filter(J.json_has_key("metadata", "z")).select("event_id")


@query(
    "filter_project",
    "SELECT c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000",
)
def filter_project(spark, sf):
    c = table(spark, sf, "customer")
    return c.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 5000)).select("c_name", "c_acctbal")


@query(
    "filter_struct",
    "SELECT c_custkey, c_name || ':' || c_nationkey AS pair FROM customer WHERE c_acctbal < 0 OR c_nationkey = 3",
)
def filter_struct(spark, sf):
    c = table(spark, sf, "customer").filter((F.col("c_acctbal") < 0) | (F.col("c_nationkey") == 3))
    pairs = c.select("c_custkey", F.struct("c_name", "c_nationkey").alias("t"))
    return pairs.select("c_custkey", F.concat_ws(":", "t.c_name", "t.c_nationkey").alias("pair"))


@query(
    "filter_count_label",
    """SELECT p_type, p_type || '(' || count(*) || ')' AS label, count(*)::BIGINT AS n
    FROM part WHERE p_size > 10 GROUP BY p_type""",
)
def filter_count_label(spark, sf):
    n = table(spark, sf, "part").filter(F.col("p_size") > 10).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("label", F.format_string("%s(%d)", "p_type", "n"))


@query("keep_existing", "SELECT ts, value FROM events")
def keep_existing(spark, sf):
    return R.keep_existing(table(spark, sf, "events"), ["ts", "value", "missing_column"], "ts")


@query(
    "numeric_cols",
    """SELECT 'l_discount' AS column_name, count(l_discount)::BIGINT AS n_values FROM lineitem
    UNION ALL SELECT 'l_extendedprice', count(l_extendedprice) FROM lineitem
    UNION ALL SELECT 'l_linenumber', count(l_linenumber) FROM lineitem
    UNION ALL SELECT 'l_quantity', count(l_quantity) FROM lineitem
    UNION ALL SELECT 'l_tax', count(l_tax) FROM lineitem""",
)
def numeric_cols(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = R.numeric_columns(li, exclude=("l_orderkey", "l_partkey", "l_suppkey"))
    return li.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], cols, "column_name", "n_values")


@query(
    "column_families",
    """SELECT 'key' AS family, 3::BIGINT AS n_columns, sum(l_orderkey + l_partkey + l_suppkey)::BIGINT AS total
    FROM lineitem UNION ALL SELECT 'date', 1, count(l_shipdate) FROM lineitem""",
)
def column_families(spark, sf):
    li = table(spark, sf, "lineitem")
    fam = R.column_families(li.columns, r"^l_\w*?(key|date)$")
    keys = li.agg(F.sum(sum((F.col(c) for c in fam["key"][1:]), F.col(fam["key"][0]))).alias("total"))
    dates = li.agg(F.count(fam["date"][0]).alias("total"))
    named = {n: df.withColumn("n_columns", F.lit(len(fam[n])).cast("bigint")) for n, df in (("key", keys), ("date", dates))}
    return R.tagged_union(named, "family")


@query(
    "time_parse_profile",
    """SELECT column_name, count(v)::BIGINT AS n_values, count(try_cast(v AS TIMESTAMP))::BIGINT AS n_parsed,
      count(v) > 0 AND count(v) = count(try_cast(v AS TIMESTAMP)) AS is_time
    FROM (SELECT 'stamp' AS column_name, CAST(ts AS VARCHAR) AS v FROM events
      UNION ALL SELECT 'event_type', event_type FROM events UNION ALL SELECT 'props', props FROM events)
    GROUP BY column_name""",
)
def time_parse_profile(spark, sf):
    e = table(spark, sf, "events").select(F.col("ts").cast("string").alias("stamp"), "event_type", "props")
    return R.time_parse_profile(e)


@query(
    "clean_labels",
    """SELECT doc_id, try_cast(try_cast(q AS DOUBLE) AS INTEGER) AS quality FROM
    (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'bad' WHEN doc_id % 17 = 0 THEN '2' ELSE CAST(quality AS VARCHAR) END AS q
     FROM labels) WHERE try_cast(q AS DOUBLE) IN (0, 1)""",
)
def clean_labels(spark, sf):
    dirty = table(spark, sf, "labels").select(
        "doc_id",
        F.expr("CASE WHEN doc_id % 13 = 0 THEN 'bad' WHEN doc_id % 17 = 0 THEN '2' ELSE CAST(quality AS STRING) END").alias("quality"),
    )
    return R.clean_labels(dirty, "quality")


@query(
    "fill_nonfinite",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_quantity IN (1, 2, 3) THEN 0.0 ELSE l_quantity END AS q FROM lineitem""",
)
def fill_nonfinite(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.expr(
            """CASE l_quantity WHEN 1 THEN double('NaN') WHEN 2 THEN double('Infinity')
            WHEN 3 THEN double('-Infinity') ELSE l_quantity END"""
        ).alias("q"),
    )
    return R.fill_nonfinite(li, ["q"])


@query(
    "drop_null_target",
    "SELECT d.doc_id, d.lang, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL",
)
def drop_null_target(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return d.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left").na.drop(subset=["quality"])


@query("derived_product", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity * l_extendedprice AS product FROM lineitem")
def derived_product(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_linenumber", (F.col("l_quantity") * F.col("l_extendedprice")).alias("product"))


@query(
    "half_mask",
    """SELECT event_type, event_id, value AS predicted, CASE WHEN rn <= n // 2 THEN value END AS real_half,
      rn <= n // 2 AS in_pred_half
    FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events
      WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))""",
)
def half_mask(spark, sf):
    from ..operators.series import half_mask as op

    e = table(spark, sf, "events").select("event_type", "event_id", "ts", "value")
    out = op(e, ["ts", "event_id"], "event_type", actual="value")
    return out.select("event_type", "event_id", F.col("value").alias("predicted"), "real_half", "in_pred_half")


# -- joins -------------------------------------------------------------------------------


@query(
    "join_using",
    "SELECT l_orderkey, l_linenumber, l_partkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
)
def join_using(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return table(spark, sf, "lineitem").join(s, "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", "s_name")


@query(
    "users_by_region",
    """SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""",
)
def users_by_region(spark, sf):
    r = table(spark, sf, "region").filter(F.col("r_name") == "ASIA")
    n = table(spark, sf, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf, "customer")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")


@query(
    "users_by_region_id",
    "SELECT c_custkey, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2",
)
def users_by_region_id(spark, sf):
    n = table(spark, sf, "nation").filter(F.col("n_regionkey") == 2)
    c = table(spark, sf, "customer")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "exists_semi",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
)
def exists_semi(spark, sf):
    o = table(spark, sf, "orders").filter(F.col("o_totalprice") > 400000)
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query(
    "anti_new_keys",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')",
)
def anti_new_keys(spark, sf):
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("lateral_series", "SELECT p_partkey, i::BIGINT AS i FROM part, LATERAL (SELECT unnest(generate_series(1, p_size)) AS i)")
def lateral_series(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    return R.lateral_series(p, F.col("p_size").cast("bigint")).select("p_partkey", "i")


@query(
    "positional_zip",
    """WITH a AS (SELECT user_id, event_id AS left_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events WHERE event_type = 'click'),
    b AS (SELECT user_id, event_id AS right_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events WHERE event_type <> 'click')
    SELECT user_id, rn, left_id, right_id FROM a JOIN b USING (user_id, rn)""",
)
def positional_zip(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    a = e.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("left_id"), F.col("ts").alias("lts"))
    b = e.filter("event_type <> 'click'").select("user_id", F.col("event_id").alias("right_id"), F.col("ts").alias("rts"))
    return R.positional_zip(a, b, ["lts", "left_id"], ["rts", "right_id"], "user_id").drop("lts", "rts")


@query(
    "contains_lookup",
    """WITH k AS (SELECT item_id, lower(split_part(text, ' ', 2) || ' ' || split_part(text, ' ', 3)) AS key FROM benchmark)
    SELECT doc_id, coalesce((SELECT min_by('item ' || item_id, item_id) FROM k WHERE contains(lower(text), key)),
      'not found') AS answer FROM documents""",
)
def contains_lookup(spark, sf):
    word = F.split("text", " ", -1)
    b = table(spark, sf, "benchmark").select(
        "item_id",
        F.concat_ws(" ", F.get(word, 1), F.get(word, 2)).alias("key"),
        F.concat(F.lit("item "), F.col("item_id")).alias("fact"),
    )
    d = table(spark, sf, "documents").select("doc_id", "text")
    return R.contains_lookup(d, "doc_id", "text", b, "key", "fact", "item_id", "not found").select("doc_id", "answer")


# -- ranking, paging, sets ---------------------------------------------------------------

LEADERBOARD_SQL = """WITH stats AS (SELECT l_suppkey, ((200 * sum(l_linenumber) + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_value, count(*) AS n
  FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 2)
SELECT row_number() OVER (ORDER BY avg_value DESC, n DESC, l_suppkey) AS ranking, l_suppkey AS supplier_id, s_name,
  avg_value AS avg_rating, n::BIGINT AS n_reviews
FROM stats JOIN supplier ON l_suppkey = s_suppkey"""


def _leaders(op, spark, sf):
    dims = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    facts = table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber")
    out = op(facts, dims, "l_suppkey", "l_linenumber")
    return out.select(
        "ranking",
        F.col("l_suppkey").alias("supplier_id"),
        "s_name",
        F.col("avg_value").cast("double").alias("avg_rating"),
        F.col("n").alias("n_reviews"),
    )


@query("leaderboard_agg", LEADERBOARD_SQL)
def leaderboard_agg(spark, sf):
    return _leaders(R.leaderboard, spark, sf)


@query("leaderboard_window", LEADERBOARD_SQL)
def leaderboard_window(spark, sf):
    return _leaders(R.leaderboard_by_row, spark, sf)


@query(
    "distinct_on",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM
    (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def distinct_on(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return R.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "preview_topk",
    """SELECT conv_id, turn, place::BIGINT AS place, has_more FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place,
      count(*) OVER (PARTITION BY conv_id) > 3 AS has_more FROM conversations) WHERE place <= 3""",
)
def preview_topk(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn")
    return R.preview(c, ["conv_id"], "turn", 3).withColumn("place", F.col("place").cast("bigint"))


@query("top3", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 3")
def top3(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(3)


@query(
    "top5_count",
    """SELECT s_suppkey, s_name, count(*)::BIGINT AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY s_suppkey, s_name ORDER BY n DESC, s_suppkey LIMIT 5""",
)
def top5_count(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("n"))
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return n.join(s, "s_suppkey").orderBy(F.desc("n"), "s_suppkey").limit(5)


@query("sort_time", "SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS parsed FROM events")
def sort_time(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.expr("CASE WHEN event_id % 17 = 0 THEN 'n/a' ELSE CAST(ts AS STRING) END").alias("raw")
    )
    parsed = e.select("event_id", F.expr("try_cast(raw AS TIMESTAMP_NTZ)").alias("parsed"))
    return parsed.orderBy(F.col("parsed").asc_nulls_last(), "event_id")


@query(
    "page_of",
    """SELECT p_partkey, p_name, (SELECT ceil(count(*) / 25.0) FROM part)::BIGINT AS total_pages
    FROM part ORDER BY p_retailprice, p_partkey LIMIT 25 OFFSET 75""",
)
def page_of(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return R.page_of(p, ["p_retailprice", "p_partkey"], 3, 25).drop("p_retailprice")


@query(
    "spaced_sample",
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) AS rn, count(*) OVER () AS t FROM documents),
    want AS (SELECT DISTINCT floor(i * ((SELECT max(t) FROM r) - 1) / 59.0)::BIGINT + 1 AS rn FROM range(60) x(i))
    SELECT doc_id, rn FROM r JOIN want USING (rn)""",
)
def spaced_sample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return R.spaced_sample(d, ["n_chars", "doc_id"], 60).select("doc_id", "rn")


@query(
    "tagged_union",
    """SELECT event_id, value, 'original' AS phase FROM events WHERE ts < TIMESTAMP '2024-01-16'
    UNION ALL SELECT event_id, value, 'retrained' FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
)
def tagged_union(spark, sf):
    e = table(spark, sf, "events")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    parts = {"original": e.filter(F.col("ts") < cut), "retrained": e.filter(F.col("ts") >= cut)}
    return R.tagged_union({k: v.select("event_id", "value") for k, v in parts.items()})


@query(
    "dedupe_first",
    """SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS rn FROM documents)
    WHERE rn = 1""",
)
def dedupe_first(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return R.dedupe_first(d, ["text", F.to_json(F.struct("lang"))], ["doc_id"]).select("doc_id", "source")


@query(
    "eval_set_from_log",
    """WITH p AS (SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer FROM conversations q
      JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
      WHERE q.role = 'user' AND a.role = 'assistant' AND trim(q.text) <> '' AND trim(a.text) <> '')
    SELECT conv_id, turn, length(question) AS question_chars FROM
      (SELECT *, row_number() OVER (PARTITION BY question ORDER BY conv_id, turn) AS rn FROM p) WHERE rn = 1
    ORDER BY conv_id, turn LIMIT 100""",
)
def eval_set_from_log(spark, sf):
    from ..operators.evaluation import eval_set_from_log as op
    from ..operators.evaluation import question_answers

    pairs = question_answers(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    pairs = pairs.withColumn("contexts", F.array("answer"))
    out = op(pairs, ["conv_id", "turn"], max_items=100)
    return out.select("conv_id", "turn", F.length("question").alias("question_chars"))


@query(
    "char_vocab",
    """SELECT ch, (row_number() OVER (ORDER BY hex(encode(ch))) - 1)::BIGINT AS idx FROM
    (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM benchmark) WHERE ch <> ''""",
)
def char_vocab(spark, sf):
    from ..operators.chunking import char_vocab as op

    return op(table(spark, sf, "benchmark"), "text")


@query(
    "splice_half",
    """WITH s AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn,
      count(*) OVER (PARTITION BY event_type) // 2 AS half FROM events)
    SELECT b.event_type, b.event_id, b.rn, CASE WHEN b.rn > b.half THEN -d.value ELSE b.value END AS value
    FROM s b LEFT JOIN s d ON d.event_type = b.event_type AND d.rn = b.rn - b.half""",
)
def splice_half(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id", "ts", "value")
    new = e.withColumn("value", -F.col("value"))
    return R.splice_tail(e, new, "value", ["ts", "event_id"], "event_type", offset=0).drop("ts")
