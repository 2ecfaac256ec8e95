"""Reads, column normalisation and row serialisation on the driver tables."""

from pyspark.sql import functions as F

from ..functions import strings as S
from ..session import new_folder
from ..sources import files
from .registry import query, table


def _folder(spark, name: str) -> str:
    """A new shared folder for files that a query writes and reads back."""
    return new_folder(spark, name)


@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def scan_parquet(spark, sf):
    return files.read_any(spark, f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("normalize_columns", 'SELECT event_id AS "event id", event_type AS "event type", value AS reading FROM events')
def normalize_columns(spark, sf):
    e = table(spark, sf, "events")
    messy = e.select(F.col("event_id").alias(" event  id"), F.col("event_type").alias("event\ttype "), F.col("value").alias("VALUE"))
    clean = files.normalize_columns(messy)
    reading = files.find_column(clean.columns, ["reading", "value"])
    return files.assert_columns(clean, ["event id", "event type"]).withColumnRenamed(reading, "reading")


@query("scan_documents", "SELECT page_id, html <> '' AS has_text, length(html) AS n FROM pages")
def scan_documents(spark, sf):
    """Pages as text files of up to a thousand, found again by suffix; each page begins with its number and a mark."""
    path, pages = _folder(spark, "texts"), table(spark, sf, "pages")
    page = F.concat(F.col("page_id").cast("string"), F.lit("\u0002"), F.col("html"))
    pages.select(page.alias("value")).write.option("lineSep", "\u0001").option("maxRecordsPerFile", 1000).text(path)
    found = files.read_documents(spark, path).select(F.explode(F.split("text", "\u0001")).alias("page")).filter(F.contains("page", F.lit("\u0002")))
    text = F.substring("page", F.instr("page", "\u0002") + 1, F.length("page"))
    return found.select(F.substring_index("page", "\u0002", 1).cast("bigint").alias("page_id"), (text != "").alias("has_text"), F.length(text).alias("n"))


@query("csv_any", "SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_acctbal::VARCHAR AS s_acctbal FROM supplier")
def csv_any(spark, sf):
    path = _folder(spark, "csv")
    files.write_csv(table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_acctbal").cast("string").alias("s_acctbal")), path)
    return files.clean_rows(files.read_csv_any(spark, path))


@query("csv_series", "SELECT ts AS timestamp, value FROM events")
def csv_series(spark, sf):
    path = _folder(spark, "series")
    e = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(" Timestamp"), F.col("value").alias("VALUE "))
    files.write_csv(e, path)
    return files.read_series_csv(spark, path)


@query("csv_dated", "SELECT o_orderdate::DATE AS o_orderdate, o_orderkey::DOUBLE AS o_orderkey, o_totalprice::DOUBLE AS o_totalprice FROM orders")
def csv_dated(spark, sf):
    path = _folder(spark, "dated")
    o = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"), "o_orderkey", "o_totalprice")
    files.write_csv(o, path)
    return files.read_dated_csv(spark, path, "o_orderdate")


@query("jsonl_append", "SELECT item_id, text FROM benchmark UNION ALL SELECT doc_id, text FROM documents")
def jsonl_append(spark, sf):
    path = _folder(spark, "jsonl")
    for name, key in (("benchmark", "item_id"), ("documents", "doc_id")):
        files.append_jsonl(table(spark, sf, name).select(F.col(key).alias("item_id"), "text"), path)
    return files.read_jsonl(spark, path, "item_id bigint, text string")


@query("versioned_write", "SELECT 1 AS version, r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT 2, n_nationkey, n_name FROM nation")
def versioned_write(spark, sf):
    path = _folder(spark, "versions")
    files.write_version(table(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")), path)
    files.write_version(table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")), path)
    return spark.read.parquet(path)


@query(
    "run_summary",
    """WITH r AS (SELECT 1 AS version, event_type FROM events WHERE event_id % 3 = 0 UNION ALL SELECT 2, event_type FROM events WHERE event_type <> 'view'),
    c AS (SELECT version, event_type, count(*) AS n_rows FROM r GROUP BY ALL)
    SELECT *, version = max(version) OVER (PARTITION BY event_type) AS latest FROM c""",
)
def run_summary(spark, sf):
    """Two runs, the second without one sensor: rows per sensor and run."""
    path, e = _folder(spark, "runs"), table(spark, sf, "events").select("event_id", "event_type", "value")
    files.write_version(e.filter("event_id % 3 = 0"), path)
    files.write_version(e.filter("event_type <> 'view'"), path)
    return files.run_summary(spark, path, "event_type")


@query(
    "glossary",
    """SELECT p_name || ' ' || p_partkey AS term, 'A part of type ' || p_type AS definition, 'Size ' || p_size AS example,
      array_to_string([p_brand, p_type], '|') AS related FROM part""",
)
def glossary(spark, sf):
    """Parts written as glossary entries, a blank line after each term and after each entry."""
    path = _folder(spark, "glossary")
    p = table(spark, sf, "part")
    entry = F.concat(
        "p_name", F.lit(" "), "p_partkey", F.lit("\n\nMeaning: A part of type "), "p_type", F.lit("\nSeen in: Size "), "p_size",
        F.lit("\nSee also: "), "p_brand", F.lit(", ,"), "p_type", F.lit("\n"),
    )
    p.select(entry.alias("value")).write.text(path)
    out = files.read_glossary(spark, path, ["Meaning", "Seen in", "See also"])
    return out.select("term", "definition", "example", F.array_join("related", "|").alias("related"))


@query("batched_write", "SELECT doc_id, source, (doc_id % 40 // 10)::INTEGER AS batch, length(text) AS n FROM documents")
def batched_write(spark, sf):
    path = _folder(spark, "batches")
    d = table(spark, sf, "documents").select("doc_id", "source", "text", F.floor(F.col("doc_id") % 40 / 10).cast("int").alias("batch"))
    files.write_batches(d, path, ["source", "batch"])
    return spark.read.parquet(path).select("doc_id", "source", "batch", F.length("text").alias("n"))


@query("cached_result", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def cached_result(spark, sf):
    path, o = _folder(spark, "cache"), table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    counts = lambda: o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    files.cached(o, counts, path, "orders")
    return files.cached(o, counts, path, "orders")


@query(
    "records_json",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp,
      CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS reading FROM events""",
)
def records_json(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", "ts", F.expr("CASE WHEN event_id % 17 = 0 THEN double('NaN') ELSE value END").alias("reading")
    )
    rec = files.records_json(e, "ts").select("event_id", F.from_json("record", "ts string, reading double").alias("r"))
    return rec.select("event_id", F.col("r.ts").alias("stamp"), "r.reading")


@query(
    "json_rows",
    """SELECT event_id, pos::INTEGER AS pos, 'item ' || json_extract_string(props, '$.k') || '/' || pos AS title,
      CASE WHEN pos = 1 THEN NULL ELSE 'http://example.com/' || event_id END AS link
    FROM events, (SELECT unnest([0, 1]) AS pos)""",
)
def json_rows(spark, sf):
    k = F.get_json_object("props", "$.k")
    e = table(spark, sf, "events").select(
        "event_id",
        F.concat(
            F.lit('[{"title": "item '), k, F.lit('/0", "link": "http://example.com/'), F.col("event_id"),
            F.lit('"}, {"title": "item '), k, F.lit('/1", "description": "none"}]'),
        ).alias("items"),
    )
    out = files.json_rows(e, "items", "struct<title:string,link:string,description:string>")
    return out.select("event_id", "pos", "title", "link")


_ENTITY_SQL = "replace(replace(replace(replace(replace(replace(replace(replace({x}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
_TAGS_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(html, '<(script|style)\\b.*?</(script|style)>', ' ', 'gis'), "
    "'<!--.*?-->', ' ', 'gs'), '<[^>]*>', ' ', 'gs')"
)


@query(
    "page_text",
    "SELECT page_id, md5(trim(regexp_replace(" + _ENTITY_SQL.format(x=_TAGS_SQL) + ", '\\s+', ' ', 'g'))) AS text_md5 FROM pages",
)
def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(S.page_text("html")).alias("text_md5"))
