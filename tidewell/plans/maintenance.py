"""Table maintenance and audits on the driver tables."""

from pyspark.sql import functions as F

from ..operators import chunking as C
from ..operators import maintenance as D
from .registry import query, table


@query(
    "insert_if_absent",
    """WITH t AS (SELECT c_name AS name, c_custkey AS id FROM customer WHERE c_nationkey < 12),
    i AS (SELECT DISTINCT c_name AS name, min(c_custkey) AS line FROM customer WHERE c_nationkey >= 6 GROUP BY c_name),
    n AS (SELECT name, row_number() OVER (ORDER BY line, name) + (SELECT max(id) FROM t) AS id FROM i WHERE name NOT IN (SELECT name FROM t))
    SELECT name, id, false AS is_new FROM t UNION ALL SELECT name, id, true FROM n""",
)
def insert_if_absent(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), "c_nationkey")
    incoming = c.filter("c_nationkey >= 6").select("name", F.col("id").alias("line"))
    return D.insert_if_absent(c.filter("c_nationkey < 12").select("name", "id"), incoming, "name", "id", ["line"])


def _wide(spark, sf):
    """Feedback rows made of parts: every id appears on two lines with different tags."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("line"),
        F.concat(F.lit("fb-"), F.floor(F.col("p_partkey") / 2)).alias("feedback_id"),
        F.col("p_type").alias("user_name"),
        F.col("p_brand").alias("model_name"),
        F.col("p_name").alias("prompt_text"),
        F.lit("").alias("response_text"),
        (F.col("p_size") % 5 + 1.0).alias("rating"),
        F.split("p_name", " ").alias("tags"),
    )


_WIDE = "w AS (SELECT p_partkey AS line, 'fb-' || (p_partkey // 2) AS feedback_id, p_type AS user_name, p_brand AS model_name, p_size % 5 + 1.0 AS rating, p_name FROM part)"
_TAGS = "x AS (SELECT line, feedback_id, i AS pos, string_split(p_name, ' ')[i] AS tag FROM w, (SELECT unnest([1, 2]) AS i)), t AS (SELECT tag, row_number() OVER (ORDER BY o, tag) AS tag_id FROM (SELECT tag, min(line * 10 + pos) AS o FROM x GROUP BY tag))"


@query(
    "normalize_dim",
    f"""WITH {_WIDE}, u AS (SELECT user_name, row_number() OVER (ORDER BY o) AS user_id FROM (SELECT user_name, min(line) AS o FROM w GROUP BY user_name)),
    m AS (SELECT model_name, row_number() OVER (ORDER BY o) AS model_id FROM (SELECT model_name, min(line) AS o FROM w GROUP BY model_name)),
    f AS (SELECT *, row_number() OVER (ORDER BY line) AS feedback_pk FROM w QUALIFY row_number() OVER (PARTITION BY feedback_id ORDER BY line) = 1)
    SELECT row_number() OVER (ORDER BY line) AS feedback_pk, feedback_id, user_id, model_id, rating::DOUBLE AS rating FROM f JOIN u USING (user_name) JOIN m USING (model_name)""",
)
def normalize_dim(spark, sf):
    return D.normalise_feedback(_wide(spark, sf), tables=["feedback"])["feedback"].select("feedback_pk", "feedback_id", "user_id", "model_id", "rating")


@query(
    "normalize_bridge",
    f"""WITH {_WIDE}, {_TAGS}, f AS (SELECT feedback_id, row_number() OVER (ORDER BY min(line)) AS feedback_pk FROM w GROUP BY feedback_id)
    SELECT DISTINCT feedback_pk, tag_id FROM x JOIN f USING (feedback_id) JOIN t USING (tag)""",
)
def normalize_bridge(spark, sf):
    return D.normalise_feedback(_wide(spark, sf), tables=["feedback_tag"])["feedback_tag"]


@query(
    "normalize_user",
    f"WITH {_WIDE} SELECT user_name, row_number() OVER (ORDER BY o) AS user_id FROM (SELECT user_name, min(line) AS o FROM w GROUP BY user_name)",
)
def normalize_user(spark, sf):
    return D.normalise_feedback(_wide(spark, sf), tables=["app_user"])["app_user"]


@query(
    "normalize_model",
    f"WITH {_WIDE} SELECT model_name, row_number() OVER (ORDER BY o) AS model_id FROM (SELECT model_name, min(line) AS o FROM w GROUP BY model_name)",
)
def normalize_model(spark, sf):
    return D.normalise_feedback(_wide(spark, sf), tables=["model"])["model"]


@query("normalize_tag", f"WITH {_WIDE}, {_TAGS} SELECT tag AS tag_name, tag_id FROM t")
def normalize_tag(spark, sf):
    return D.normalise_feedback(_wide(spark, sf), tables=["tag"])["tag"]


def _changes(c):
    """Two changes per customer: a draft, then a new balance and a name that is free, another customer's or its own."""
    free = F.concat(F.lit("Renamed#"), F.col("c_custkey"))
    other = F.format_string("Customer#%09d", F.col("c_custkey") + 1)
    name = F.when(F.col("c_custkey") % 3 == 0, free).when(F.col("c_custkey") % 3 == 1, other).otherwise(F.col("c_name"))
    final = c.select("c_custkey", name.alias("c_name"), F.col("c_custkey").cast("double").alias("c_acctbal"), F.lit(2).alias("at"))
    draft = c.select("c_custkey", F.concat(F.lit("Draft#"), F.col("c_custkey")).alias("c_name"), F.lit(None).cast("double").alias("c_acctbal"), F.lit(1).alias("at"))
    return draft.unionByName(final)


_CHANGES = """ch AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Renamed#' || c_custkey WHEN 1 THEN printf('Customer#%09d', c_custkey + 1)
  ELSE c_name END AS new_name FROM customer)"""


@query(
    "update_by_key",
    f"""WITH {_CHANGES} SELECT c.c_custkey, CASE WHEN o.c_custkey IS NULL THEN c.c_custkey::DOUBLE ELSE c.c_acctbal END AS c_acctbal,
      CASE WHEN o.c_custkey IS NULL THEN ch.new_name ELSE c.c_name END AS c_name
    FROM customer c JOIN ch USING (c_custkey) LEFT JOIN customer o ON o.c_name = ch.new_name AND o.c_custkey <> c.c_custkey
    WHERE true""",
)
def update_by_key(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return D.update_by_key(c, _changes(c), "c_custkey", "c_name", ["at"])


@query(
    "rejected_changes",
    f"""WITH {_CHANGES}, d AS (SELECT ch.*, min(c_custkey) OVER (PARTITION BY new_name) AS f FROM ch JOIN customer c USING (c_custkey) WHERE new_name <> c.c_name)
    SELECT c_custkey, max(reason) AS reason FROM (
      SELECT d.c_custkey, 'taken' AS reason FROM d JOIN customer o ON o.c_name = d.new_name AND o.c_custkey <> d.c_custkey
      UNION ALL SELECT c_custkey, 'claimed' FROM d WHERE c_custkey <> f) GROUP BY c_custkey""",
)
def rejected_changes(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return D.rejected_changes(c, D.last_changes(_changes(c), "c_custkey", ["at"]), "c_custkey", "c_name")


@query(
    "delete_cascade",
    """WITH g AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') SELECT 'orders' AS tbl, count(*)::BIGINT AS n, sum(o_orderkey)::BIGINT AS keys
    FROM orders WHERE o_orderkey NOT IN (SELECT * FROM g) UNION ALL
    SELECT 'lineitem', count(*), sum(l_orderkey)::BIGINT FROM lineitem WHERE l_orderkey NOT IN (SELECT * FROM g)""",
)
def delete_cascade(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    kept = D.delete_cascade({"orders": o, "lineitem": li}, o.filter("o_orderstatus = 'P'"), "orders", "o_orderkey", {"lineitem": "l_orderkey"})
    size = lambda name, key: kept[name].agg(F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("n"), F.sum(key).alias("keys"))
    return size("orders", "o_orderkey").unionByName(size("lineitem", "l_orderkey"))


@query(
    "audit_unique",
    "SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def audit_unique(spark, sf):
    return D.audit_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "audit_fk",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_orderkey = l.l_orderkey AND o_orderstatus <> 'P')""",
)
def audit_fk(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return D.audit_fk(li, "l_orderkey", table(spark, sf, "orders").filter("o_orderstatus <> 'P'"), "o_orderkey")


@query(
    "audit_check",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 11 <> 0 THEN l_quantity END AS progress FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, 'progress' AS rule_name FROM r WHERE NOT (progress BETWEEN 0 AND 45)
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'rating' FROM r WHERE NOT (l_linenumber BETWEEN 1 AND 5)""",
)
def audit_check(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_partkey") % 11 != 0, F.col("l_quantity")).alias("progress")
    )
    rules = {"progress": F.col("progress").between(0, 45), "rating": F.col("l_linenumber").between(1, 5)}
    return D.audit_check(li, rules).drop("progress")


@query(
    "audit_not_null",
    """SELECT 'lang' AS column_name, count(*) FILTER (doc_id % 9 = 0)::BIGINT AS n_null FROM documents
    UNION ALL SELECT 'text', 0 UNION ALL SELECT 'source', 0""",
)
def audit_not_null(spark, sf):
    d = table(spark, sf, "documents").select("text", "source", F.when(F.col("doc_id") % 9 != 0, F.col("lang")).alias("lang"))
    return D.audit_not_null(d, ["lang", "text", "source"])


@query("audit_length", "SELECT doc_id, 'length(text) <= 2000' AS rule_name FROM documents WHERE length(text) > 2000")
def audit_length(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "source")
    return D.audit_length(d, {"text": 2000, "source": 20}).select("doc_id", "rule_name")


@query("audit_dimension", "SELECT vec_id, 'dimension(embedding) = 64' AS rule_name FROM embeddings WHERE len(embedding[:64 - vec_id % 2]) <> 64")
def audit_dimension(spark, sf):
    v = table(spark, sf, "embeddings").select(
        "vec_id", F.slice("embedding", F.lit(1), (64 - F.col("vec_id") % 2).cast("int")).alias("embedding")
    )
    return D.audit_length(v, {"embedding": 64}).select("vec_id", "rule_name")


@query(
    "apply_defaults",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END, DATE '2024-01-01') AS enrolled,
      coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END, 'N') AS status FROM orders""",
)
def apply_defaults(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate").cast("date")).alias("enrolled"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("status"),
    )
    return D.apply_defaults(o, {"enrolled": F.lit("2024-01-01").cast("date"), "status": F.lit("N")})


@query(
    "corpus_append",
    """SELECT doc_id, source FROM documents d WHERE lang <> 'en' AND text NOT IN (SELECT text FROM documents WHERE lang = 'en')
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
)
def corpus_append(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return D.corpus_append(d.filter("lang = 'en'"), d, "text", ["doc_id"]).select("doc_id", "source")


@query(
    "corpus_status",
    """WITH c AS (SELECT source, doc_id, substr(text, i * 850 + 1, 1000) AS t FROM documents,
      LATERAL (SELECT unnest(generate_series(0, greatest(ceil((length(text) - 150) / 850.0), 1)::BIGINT - 1)) AS i))
    SELECT source, count(*)::BIGINT AS n_chunks, count(DISTINCT doc_id)::BIGINT AS n_documents, sum(length(t))::BIGINT AS n_chars FROM c GROUP BY source""",
)
def corpus_status(spark, sf):
    d = table(spark, sf, "documents")
    chunks = C.chunk_fixed(d, "doc_id", "text", 1000, 150).join(d.select("doc_id", "source"), "doc_id")
    return D.corpus_status(chunks, "source")
