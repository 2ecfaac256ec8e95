"""Chunking, retrieval, fusion and prompt assembly on the driver tables."""

from pyspark.sql import functions as F

from ..functions import det
from ..functions import strings as S
from ..operators import chunking as C
from ..operators import retrieval as X
from .aggregates import rounded
from .registry import query, table


@query("chunk_recursive")
def chunk_recursive(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", C.S.join_parts(["source", "text"]).alias("text"))
    return C.chunk_recursive(d, "doc_id", "text", 1000, 150)


@query("chunk_recursive_rules", "SELECT doc_id, true AS within_size, true AS all_found, true AS covered FROM documents")
def chunk_recursive_rules(spark, sf):
    """What must hold for every document: no chunk too long, each stands in the text, no character but blanks is lost."""
    d = table(spark, sf, "documents").select("doc_id", C.S.join_parts(["source", "text"]).alias("whole"))
    chunks = C.chunk_recursive(d, "doc_id", "whole", 1000, 150).withColumnRenamed("text", "chunk")
    solid = lambda c: F.length(F.regexp_replace(c, r"\s", ""))
    return chunks.join(d, "doc_id").groupBy("doc_id").agg(
        (F.max(F.length("chunk")) <= 1000).alias("within_size"),
        F.every(F.contains("whole", "chunk")).alias("all_found"),
        (F.sum(solid("chunk")) >= F.max(solid("whole"))).alias("covered"),
    )


@query(
    "chunk_fixed",
    """SELECT doc_id, i::INTEGER AS chunk_index, md5(substr(text, i * 850 + 1, 1000)) AS chunk_md5 FROM documents,
      LATERAL (SELECT unnest(generate_series(0, greatest(ceil((length(text) - 150) / 850.0), 1)::BIGINT - 1)) AS i)""",
)
def chunk_fixed(spark, sf):
    out = C.chunk_fixed(table(spark, sf, "documents"), "doc_id", "text", 1000, 150)
    return out.select("doc_id", "chunk_index", F.md5("text").alias("chunk_md5"))


@query(
    "char_windows",
    """SELECT item_id, i::INTEGER AS pos, substr(text, i + 1, 10) AS x, substr(text, i + 2, 10) AS y FROM benchmark,
      LATERAL (SELECT unnest(generate_series(0, length(text) - 11)) AS i)""",
)
def char_windows(spark, sf):
    return C.char_windows(table(spark, sf, "benchmark"), "item_id", "text", 10)


@query(
    "token_batches",
    """WITH RECURSIVE d AS (SELECT source, doc_id, greatest(1, floor(length(text) * 0.5))::BIGINT AS tok,
      row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
    w AS (SELECT source, doc_id, rn, tok, 1::BIGINT AS batch, tok AS held, 1 AS cnt, tok >= 6000 AS alone FROM d WHERE rn = 1
      UNION ALL
      SELECT d.source, d.doc_id, d.rn, d.tok,
        CASE WHEN w.alone OR d.tok >= 6000 OR w.held + d.tok > 6000 OR w.cnt >= 7 THEN w.batch + 1 ELSE w.batch END,
        CASE WHEN w.alone OR d.tok >= 6000 OR w.held + d.tok > 6000 OR w.cnt >= 7 THEN d.tok ELSE w.held + d.tok END,
        CASE WHEN w.alone OR d.tok >= 6000 OR w.held + d.tok > 6000 OR w.cnt >= 7 THEN 1 ELSE w.cnt + 1 END, d.tok >= 6000
      FROM w JOIN d ON d.source = w.source AND d.rn = w.rn + 1)
    SELECT source, doc_id, batch FROM w""",
)
def token_batches(spark, sf):
    d = table(spark, sf, "documents").select("source", "doc_id", S.token_estimate("text").alias("tok"))
    return C.token_batches(d, "tok", "source", ["doc_id"], max_tokens=6000, max_count=7).select("source", "doc_id", "batch")


KEYWORD_SQL = """kw_t AS (SELECT item_id, t, count(*) AS m FROM (SELECT item_id,
    unnest(regexp_extract_all(lower(text), '[A-Za-z\\x{AC00}-\\x{D7A3}0-9]+')) AS t FROM benchmark) WHERE length(t) > 1 GROUP BY item_id, t),
  kw_d AS (SELECT doc_id, lower(text) AS txt FROM documents),
  kw_u AS (SELECT DISTINCT t FROM kw_t),
  kw_c AS (SELECT doc_id, t, (length(txt) - length(replace(txt, t, ''))) // length(t) AS c FROM kw_d, kw_u WHERE contains(txt, t)),
  kw_s AS (SELECT i.item_id, d.doc_id, coalesce(s.score, 0) AS score FROM (SELECT item_id FROM benchmark) i CROSS JOIN (SELECT doc_id FROM documents) d
    LEFT JOIN (SELECT item_id, doc_id, sum(m * c) AS score FROM kw_t JOIN kw_c USING (t) GROUP BY 1, 2) s USING (item_id, doc_id)),
  kw AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM kw_s)"""

BM25_SQL = """bm_t AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\\s]+')) AS t FROM documents),
  bm_f AS (SELECT doc_id, t, count(*) AS tf FROM bm_t GROUP BY doc_id, t),
  bm_l AS (SELECT doc_id, coalesce(dl, 0) AS dl FROM documents LEFT JOIN (SELECT doc_id, sum(tf) AS dl FROM bm_f GROUP BY doc_id) x USING (doc_id)),
  bm_c AS (SELECT count(*)::DOUBLE AS n, avg(dl) AS avgdl FROM bm_l),
  bm_i AS (SELECT t, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM (SELECT t, count(*) AS df FROM bm_f GROUP BY t), bm_c),
  bm_m AS (SELECT avg(idf) AS mean FROM bm_i),
  bm_q AS (SELECT item_id, t, count(*) AS m FROM (SELECT item_id, unnest(regexp_extract_all(text, '[^\\s]+')) AS t FROM benchmark) GROUP BY item_id, t),
  bm_w AS (SELECT item_id, t, m * CASE WHEN idf < 0 THEN 0.25 * mean ELSE idf END AS w FROM bm_q JOIN bm_i USING (t), bm_m),
  bm_h AS (SELECT item_id, doc_id, round(sum(w * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
    FROM bm_f JOIN bm_w USING (t) JOIN bm_l USING (doc_id), bm_c GROUP BY item_id, doc_id),
  bm AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM bm_h)"""


@query("keyword_topk", f"WITH {KEYWORD_SQL} SELECT item_id, doc_id, score::BIGINT AS score, rank::INTEGER AS rank FROM kw WHERE rank <= 4")
def keyword_topk(spark, sf):
    out = X.keyword_topk(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 4)
    return out.withColumn("score", F.col("score").cast("bigint"))


@query("bm25_topk", f"WITH {BM25_SQL} SELECT item_id, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM bm WHERE rank <= 3")
def bm25_topk(spark, sf):
    return rounded(X.bm25_topk(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 3), 6, "score")


@query(
    "bm25_indexed",
    f"""WITH {BM25_SQL} SELECT item_id, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM bm WHERE rank <= 3""",
)
def bm25_indexed(spark, sf):
    """One index of postings, searched by even and by odd items."""
    d, b = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    index = X.posting_index(d)
    parts = [X.index_topk(index, d, b.filter(F.col("item_id") % 2 == i), 3) for i in (0, 1)]
    return rounded(parts[0].unionByName(parts[1]), 6, "score")


@query(
    "rrf_fusion",
    f"""WITH {KEYWORD_SQL}, {BM25_SQL}, l AS (SELECT item_id, doc_id, 0.5 / (rank + 60) AS s FROM kw WHERE rank <= 3
      UNION ALL SELECT item_id, doc_id, 0.5 / (rank + 60) FROM bm WHERE rank <= 3)
    SELECT item_id, doc_id, round(sum(s), 9) AS score FROM l GROUP BY item_id, doc_id""",
)
def rrf_fusion(spark, sf):
    d, b = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    lists = [X.keyword_topk(d, b, 3), X.bm25_topk(d, b, 3)]
    return rounded(X.fuse(lists, [0.5, 0.5], "item_id", "doc_id"), 9, "score")


_VEC = "SELECT vec_id, label, i, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) x(i)"


def _near(fn):
    return f"""SELECT c.label AS query_id, e.vec_id, sqrt(sum((e.v - c.v) * (e.v - c.v))) AS d FROM ({_VEC}) e
      JOIN (SELECT label, i, {fn}(v) AS v FROM ({_VEC}) GROUP BY label, i) c ON e.i = c.i GROUP BY c.label, e.vec_id"""


@query(
    "vector_topk",
    f"""SELECT query_id, vec_id, round(d, 6) AS distance, rank FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id))::INTEGER AS rank
    FROM ({_near("avg")})) WHERE rank <= 6""",
)
def vector_topk(spark, sf):
    v = table(spark, sf, "embeddings")
    return rounded(X.vector_topk(v, X.centroids(v, "label"), 6), 6, "distance")


@query(
    "vector_topk_cosine",
    f"""WITH e AS ({_VEC}), c AS (SELECT label, i, avg(v) AS v FROM e GROUP BY label, i),
    d AS (SELECT c.label AS query_id, e.vec_id, 1 - sum(e.v * c.v) / (sqrt(sum(e.v * e.v)) * sqrt(sum(c.v * c.v))) AS d
      FROM e JOIN c ON e.i = c.i GROUP BY c.label, e.vec_id)
    SELECT query_id, vec_id, round(d, 6) AS distance, rank FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id))::INTEGER AS rank
    FROM d) WHERE rank <= 5""",
)
def vector_topk_cosine(spark, sf):
    v = table(spark, sf, "embeddings")
    return rounded(X.vector_topk(v, X.centroids(v, "label"), 5, "cosine"), 6, "distance")


@query(
    "hybrid_fusion",
    f"""WITH {BM25_SQL}, d AS (SELECT b.item_id, e.vec_id AS doc_id, list_distance(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS d
      FROM benchmark b JOIN embeddings q ON q.vec_id = b.item_id, embeddings e WHERE e.vec_id IN (SELECT doc_id FROM documents)),
    v AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY d, doc_id) AS rank FROM d),
    l AS (SELECT item_id, doc_id, 0.5 / (rank + 60) AS s FROM v WHERE rank <= 3 UNION ALL SELECT item_id, doc_id, 0.5 / (rank + 60) FROM bm WHERE rank <= 3)
    SELECT item_id, doc_id, round(sum(s), 9) AS score FROM l GROUP BY item_id, doc_id""",
)
def hybrid_fusion(spark, sf):
    """BM25 and vector lists; a document's and an item's vector is the one of the same number."""
    d, b, e = (table(spark, sf, t) for t in ("documents", "benchmark", "embeddings"))
    vecs = e.select(F.col("vec_id").alias("doc_id"), "embedding").join(d.select("doc_id"), "doc_id", "left_semi")
    asked = b.select("item_id").join(e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("query_vec")), "item_id")
    near = X.vector_topk(vecs, asked, 3, "l2", "doc_id", "embedding", "item_id", "query_vec")
    return rounded(X.fuse([X.bm25_topk(d, b, 3), near], [0.5, 0.5], "item_id", "doc_id"), 9, "score")


@query("vector_recall", "SELECT count(*) AS n_queries, true AS exact_distances, true AS recall_reached FROM embeddings WHERE vec_id % 50 = 0")
def vector_recall(spark, sf):
    """Ten neighbours of every vector whose id is divisible by 50, by visited buckets and exactly: nine in ten at least."""
    v = table(spark, sf, "embeddings")
    asked = v.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    exact = X.vector_topk(v, asked, 10).select("query_id", "vec_id", F.col("distance").alias("d"))
    found = X.vector_topk(v, asked, 10, probing=X.Probing(bucket=64)).select("query_id", "vec_id", "distance")
    hits = exact.join(found, ["query_id", "vec_id"], "left")
    return hits.agg(
        F.count_distinct("query_id").alias("n_queries"),
        F.every(F.col("distance").isNull() | (F.abs(F.col("distance") - F.col("d")) < 1e-9)).alias("exact_distances"),
        (F.count("distance") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"),
    )


@query(
    "title_body_chunks",
    """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN source END AS title, CASE WHEN doc_id % 7 <> 0 THEN text END AS body FROM documents),
    j AS (SELECT doc_id, concat_ws(chr(10) || chr(10), nullif(trim(title, ' ' || chr(9) || chr(10) || chr(13)), ''), nullif(trim(body, ' ' || chr(9) || chr(10) || chr(13)), '')) AS txt FROM d)
    SELECT doc_id, i::INTEGER AS chunk_index, md5(substr(txt, i * 850 + 1, 1000)) AS chunk_md5 FROM j,
      LATERAL (SELECT unnest(generate_series(0, greatest(ceil((length(txt) - 150) / 850.0), 1)::BIGINT - 1)) AS i) WHERE txt <> ''""",
)
def title_body_chunks(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("title"), F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("body")
    )
    out = C.chunk_fixed(C.title_and_body(d, "title", "body", "whole"), "doc_id", "whole", 1000, 150)
    return out.select("doc_id", "chunk_index", F.md5("text").alias("chunk_md5"))


@query(
    "mmr_topk",
    f"""WITH e AS ({_VEC}), c AS (SELECT label AS query_id, i, avg(v) AS v FROM e GROUP BY label, i),
    f AS (SELECT * FROM (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS r FROM ({_near("avg")})) WHERE r <= 25),
    n AS (SELECT vec_id, sqrt(sum(v * v)) AS n FROM e GROUP BY vec_id),
    s AS (SELECT f.query_id, f.vec_id, any_value(f.r) AS r, sum(e.v * c.v) / any_value(n.n) / sqrt(sum(c.v * c.v)) AS near
      FROM f JOIN e USING (vec_id) JOIN n USING (vec_id) JOIN c ON c.query_id = f.query_id AND c.i = e.i GROUP BY f.query_id, f.vec_id),
    p AS (SELECT a.query_id, a.vec_id AS a, b.vec_id AS b, sum(x.v * y.v) / any_value(na.n) / any_value(nb.n) AS sim FROM f a JOIN f b ON a.query_id = b.query_id
      JOIN e x ON x.vec_id = a.vec_id JOIN e y ON y.vec_id = b.vec_id AND y.i = x.i JOIN n na ON na.vec_id = a.vec_id JOIN n nb ON nb.vec_id = b.vec_id
      GROUP BY a.query_id, a.vec_id, b.vec_id),
    o1 AS (SELECT query_id, vec_id, near AS score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY near DESC, r) = 1),
    o2 AS (SELECT s.query_id, s.vec_id, 0.5 * near - 0.5 * sim AS score FROM s JOIN o1 USING (query_id) JOIN p ON p.query_id = s.query_id AND p.a = s.vec_id AND p.b = o1.vec_id
      WHERE s.vec_id <> o1.vec_id QUALIFY row_number() OVER (PARTITION BY s.query_id ORDER BY 0.5 * near - 0.5 * sim DESC, r) = 1),
    o3 AS (SELECT s.query_id, s.vec_id, 0.5 * near - 0.5 * greatest(p.sim, q.sim) AS score FROM s JOIN o1 USING (query_id) JOIN o2 USING (query_id)
      JOIN p ON p.query_id = s.query_id AND p.a = s.vec_id AND p.b = o1.vec_id JOIN p q ON q.query_id = s.query_id AND q.a = s.vec_id AND q.b = o2.vec_id
      WHERE s.vec_id NOT IN (o1.vec_id, o2.vec_id) QUALIFY row_number() OVER (PARTITION BY s.query_id ORDER BY 0.5 * near - 0.5 * greatest(p.sim, q.sim) DESC, r) = 1)
    SELECT query_id, vec_id, 1 AS rank, round(score, 6) AS score FROM o1 UNION ALL SELECT query_id, vec_id, 2, round(score, 6) FROM o2
    UNION ALL SELECT query_id, vec_id, 3, round(score, 6) FROM o3""",
)
def mmr_topk(spark, sf):
    v = table(spark, sf, "embeddings")
    return rounded(X.mmr(v, X.centroids(v, "label"), 3), 6, "score")


@query(
    "multi_query",
    f"""WITH n AS (SELECT 1 AS variant, * FROM ({_near("avg")}) UNION ALL SELECT 2, * FROM ({_near("max")}) UNION ALL SELECT 3, * FROM ({_near("min")})),
    t AS (SELECT *, row_number() OVER (PARTITION BY variant, query_id ORDER BY d, vec_id) AS rank FROM n)
    SELECT query_id AS label, vec_id, min(variant * 10 + rank)::INTEGER // 10 AS variant, min(variant * 10 + rank)::INTEGER % 10 AS rank
    FROM t WHERE rank <= 4 GROUP BY query_id, vec_id""",
)
def multi_query(spark, sf):
    v = table(spark, sf, "embeddings")
    variants = None
    for i, how in enumerate((F.avg, F.max, F.min), 1):
        one = X.centroids(v, "label", how=how).select((F.col("query_id") * 10 + i).alias("query_id"), "query_vec")
        variants = one if variants is None else variants.unionByName(one)
    near = X.vector_topk(v, variants, 4)
    named = near.select(F.floor(F.col("query_id") / 10).cast("int").alias("label"), (F.col("query_id") % 10).alias("variant"), "rank", "vec_id")
    return X.unite(named, "label", "vec_id", ["variant", "rank"])


@query(
    "rerank_topk",
    f"""SELECT label, vec_id, rank FROM (SELECT label, vec_id, (row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id))::INTEGER AS rank
    FROM (SELECT label, vec_id, round({det.uniform_sql("vec_id", "rerank")}, 2) AS s FROM embeddings)) WHERE rank <= 6""",
)
def rerank_topk(spark, sf):
    v = table(spark, sf, "embeddings").select("label", "vec_id", F.round(det.uniform("vec_id", "rerank"), 2).alias("score"))
    return X.rerank_topk(v, "label", "vec_id", "score", 6).select("label", "vec_id", "rank")


@query(
    "context_assemble",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents)
    SELECT source, string_agg('[' || rank || '] ' || coalesce(nullif(lang, ''), 'unknown') || chr(10) || substr(text, 1, 800), chr(10) || chr(10) ORDER BY rank) AS context
    FROM r WHERE rank <= 4 GROUP BY source""",
)
def context_assemble(spark, sf):
    d = table(spark, sf, "documents").select("source", "doc_id", "n_chars", "lang", "text")
    from ..operators.relational import top_per_key

    top = top_per_key(d, ["source"], [F.desc("n_chars"), F.asc("doc_id")], 4, "rank")
    return X.assemble_context(top, "source", "rank", S.first_non_empty(["lang"]), "text")


@query(
    "extractive_summary",
    """WITH c AS (SELECT doc_id, i AS ch, substr(text, i * 2000 + 1, 2000) AS txt FROM documents,
      LATERAL (SELECT unnest(generate_series(0, greatest(ceil(length(text) / 2000.0), 1)::BIGINT - 1)) AS i)),
    a AS (SELECT doc_id, ch, regexp_extract_all(txt, '[^.!?\\n]+[.!?]*') AS s FROM c),
    s AS (SELECT doc_id, ch, p, s[p + 1] AS s FROM (SELECT *, unnest(generate_series(0, len(s) - 1)) AS p FROM a WHERE len(s) > 0)),
    w AS (SELECT doc_id, ch, p, t FROM (SELECT doc_id, ch, p, unnest(regexp_extract_all(lower(s), '[A-Za-z\\x{AC00}-\\x{D7A3}0-9]+')) AS t FROM s) WHERE length(t) > 1),
    f AS (SELECT doc_id, ch, t, count(*) AS tf FROM w GROUP BY doc_id, ch, t),
    g AS (SELECT doc_id, ch, p, sum(tf) AS score FROM w JOIN f USING (doc_id, ch, t) GROUP BY doc_id, ch, p),
    b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, ch ORDER BY score DESC, p) AS place FROM g)
    SELECT doc_id, string_agg(trim(s), chr(10) ORDER BY ch, p) AS summary FROM b JOIN s USING (doc_id, ch, p) WHERE place <= 2 GROUP BY doc_id""",
)
def extractive_summary(spark, sf):
    return C.extractive_summary(table(spark, sf, "documents"), "doc_id", "text")


_SHOTS = ("Item: kettle\nRoom: kitchen\n", "Item: pillow\nRoom: bedroom\n")


@query(
    "render_template",
    """SELECT doc_id, 'Item: kettle' || chr(10) || 'Room: kitchen' || chr(10) || chr(10) || chr(10) || 'Item: pillow' || chr(10) || 'Room: bedroom'
      || chr(10) || chr(10) || chr(10) || 'Source: ' || source || chr(10) || 'Text (' || lang || '): ' || substr(text, 1, 200) AS prompt FROM documents""",
)
def render_template(spark, sf):
    fields = {"source": F.col("source"), "lang": F.col("lang"), "text": S.truncate("text", 200)}
    return table(spark, sf, "documents").select(
        "doc_id", X.render("Source: {source}\nText ({lang}): {text}", fields, _SHOTS).alias("prompt")
    )
