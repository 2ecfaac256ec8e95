"""Readers and writers for files."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import strings as S
from ..session import settle

BAD_CHAR = "�"


def read_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read by suffix: parquet, csv or txt with a header, json lines."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.schema(schema) if schema else spark.read
    if suffix in ("csv", "txt"):
        return reader.option("header", True).option("inferSchema", schema is None).csv(path)
    if suffix in ("json", "jsonl"):
        return read_jsonl(spark, path, schema)
    raise ValueError(f"unsupported file type: {suffix}")


#: Encodings that Spark reads without a legacy setting.
OWN_ENCODINGS = ("UTF-8", "UTF-16", "ISO-8859-1", "US-ASCII")


def read_csv_any(
    spark: SparkSession, path: str, encodings: Sequence[str] = ("UTF-8", "cp949"), header: bool = True, schema=None
) -> DataFrame:
    """CSV in the first encoding that decodes every line.

    Spark replaces bytes it cannot decode instead of failing, so each candidate is checked by
    looking for the replacement character.  Encodings beyond Spark's own list need
    ``spark.sql.legacy.javaCharsets``; their rows are written once to the shared folder, so that the setting
    can be set back.
    """
    setting = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(setting, None)
    try:
        return _first_decoding(spark, path, encodings, header, schema)
    finally:  # what needed the setting has been settled by then
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def _first_decoding(spark: SparkSession, path: str, encodings: Sequence[str], header: bool, schema) -> DataFrame:
    for enc in encodings:
        if enc.upper() not in OWN_ENCODINGS:
            spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        reader = spark.read.option("encoding", enc).option("header", header)
        reader = reader.schema(schema) if schema else reader
        df = reader.csv(path)
        texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        bad = F.lit(any(BAD_CHAR in c for c in df.columns))
        for c in texts:
            bad = bad | F.coalesce(F.contains(F.col(f"`{c}`"), F.lit(BAD_CHAR)), F.lit(False))
        if df.filter(bad).limit(1).count() == 0 and not any(BAD_CHAR in c for c in df.columns):
            first = df.columns[0].lstrip("﻿")
            df = df.withColumnRenamed(df.columns[0], first)
            return df if enc.upper() in OWN_ENCODINGS else settle(df)
    raise ValueError(f"none of {list(encodings)} decodes {path}")


def clean_rows(df: DataFrame, numbers: Sequence[str] = ()) -> DataFrame:
    """Text columns trimmed; ``numbers`` read as double with 0.0 for blank."""
    out = {}
    for f in df.schema:
        if f.name in numbers:
            out[f.name] = F.coalesce(F.nullif(S.strip(F.col(f.name).cast("string")), F.lit("")).try_cast("double"), F.lit(0.0))
        elif isinstance(f.dataType, T.StringType):
            out[f.name] = S.strip(f.name)
    return df.withColumns(out)


def squeeze(name: str) -> str:
    return re.sub(r"\s+", " ", name.strip())


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[squeeze(c) for c in df.columns])


def find_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate present: exact name first, then ignoring case."""
    for c in candidates:
        if c in columns:
            return c
    lower = {c.lower(): c for c in columns}
    return next((lower[c.lower()] for c in candidates if c.lower() in lower), None)


def assert_columns(df: DataFrame, required: Sequence[str], exact: bool = False) -> DataFrame:
    """Columns named as required, whatever their case; an error names the missing ones."""
    found = {r: find_column(df.columns, [r]) for r in required}
    missing = [r for r, c in found.items() if c is None]
    if missing:
        raise ValueError(f"missing columns {missing} in {df.columns}")
    if exact and len(df.columns) != len(required):
        raise ValueError(f"expected exactly {list(required)}, found {df.columns}")
    return df.withColumnsRenamed({c: r for r, c in found.items() if c != r})


def read_series_csv(spark: SparkSession, path: str, ts: str = "timestamp", value: str = "value") -> DataFrame:
    """Two-column sensor file with parsed time and value; unreadable fields become null."""
    raw = normalize_columns(spark.read.option("header", True).csv(path))
    df = assert_columns(raw, [ts, value], exact=True)
    return df.select(F.col(ts).try_cast("timestamp_ntz").alias(ts), F.nanvl(F.col(value).try_cast("double"), F.lit(None)).alias(value))


def read_dated_csv(spark: SparkSession, path: str, date: str = "Date") -> DataFrame:
    """CSV indexed by a date; other columns are numbers, NaN and text read as null."""
    raw = spark.read.option("header", True).csv(path)
    rest = [c for c in raw.columns if c != date]
    return raw.select(
        F.col(date).try_cast("date").alias(date), *[F.nanvl(F.col(c).try_cast("double"), F.lit(None)).alias(c) for c in rest]
    )


def read_jsonl(spark: SparkSession, path: str, schema=None, limit: int | None = None) -> DataFrame:
    """JSON lines; blank and malformed lines are skipped."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    df = (reader.schema(schema) if schema else reader).json(path)
    return df.limit(limit) if limit else df


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_documents(spark: SparkSession, path: str, suffixes: Sequence[str] = ("txt", "md")) -> DataFrame:
    """One row per text file below ``path``; files of other types are left out."""
    glob = "*.{" + ",".join(suffixes) + "}"
    df = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    return df.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))


def read_glossary(spark: SparkSession, path: str, labels: Sequence[str]) -> DataFrame:
    """Glossary files to (term, definition, example, related[]).

    An entry is a term line, a blank line and three labelled lines; ``labels`` are their names
    in order (definition, example, related words).
    """
    whole = spark.read.text(path, wholetext=True)
    body = F.regexp_replace(F.regexp_replace("value", "\r\n", "\n"), rf"\n[ \t]*\n(?={re.escape(labels[0])})", "\n")
    entry = whole.select(F.posexplode(F.split(body, r"\n[ \t]*\n+")).alias("pos", "entry"))
    field = lambda label: F.trim(F.regexp_extract("entry", rf"(?m)^{re.escape(label)}\s*:\s*(.*)$", 1))
    term = F.trim(F.regexp_extract("entry", r"(?s)^\s*([^\n]*)", 1))
    out = entry.select(
        "pos", term.alias("term"), field(labels[0]).alias("definition"), field(labels[1]).alias("example"), S.split_tags(field(labels[2])).alias("related")
    )
    return out.filter(F.col("definition") != "")


def write_batches(df: DataFrame, path: str, batch: str | Sequence[str] = "batch") -> None:
    """One folder per batch, each written by one task; batches are bounded, so are the files."""
    keys = [batch] if isinstance(batch, str) else list(batch)
    df.repartition(*keys).write.mode("append").partitionBy(*keys).parquet(path)


def append_run(spark: SparkSession, path: str, run_id: str, values: dict[str, object], logged_at: str) -> None:
    """Add the parameters and metrics of one run to an append-only table (run_id, key, value, logged_at)."""
    rows = [(run_id, k, str(v), logged_at) for k, v in values.items()]
    df = spark.createDataFrame(rows, "run_id string, key string, value string, logged_at string")
    df.coalesce(1).write.mode("append").parquet(path)


def next_version(spark: SparkSession, path: str, column: str = "version") -> int:
    """Largest ``version=`` partition below ``path`` plus one, 1 for a new folder."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return 1
    names = [s.getPath().getName() for s in fs.listStatus(fs_path)]
    found = [int(n.split("=", 1)[1]) for n in names if re.fullmatch(rf"{column}=\d+", n)]
    return max(found, default=0) + 1


def write_version(df: DataFrame, path: str, column: str = "version") -> int:
    """Write the rows as the next version; one number serves data and anything derived from it."""
    version = next_version(df.sparkSession, path, column)
    df.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{column}={version}")
    return version


def run_summary(spark: SparkSession, path: str, by: str, column: str = "version") -> DataFrame:
    """Rows per ``by`` and version of what ``write_version`` wrote below ``path``, the latest version marked.

    Counts come from the files themselves, so they hold whatever a run said of itself.
    """
    rows = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{column}=*")
    counts = rows.groupBy(F.col(column).cast("int").alias(column), by).agg(F.count(F.lit(1)).alias("n_rows"))
    newest = counts.groupBy(by).agg(F.max(column).alias("__newest"))
    joined = counts.join(newest.withColumnRenamed(by, "__by"), F.col(by).eqNullSafe(F.col("__by")))
    return joined.select(column, by, "n_rows", (F.col(column) == F.col("__newest")).alias("latest"))


def records_json(df: DataFrame, ts: str, limit: int | None = None) -> DataFrame:
    """One JSON object per row with second-precision time and NaN as null."""
    cols = []
    for f in df.schema:
        if f.name == ts:
            cols.append(F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias(ts))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    out = df.select("*", F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("record"))
    return out.limit(limit) if limit else out


def fingerprint(df: DataFrame) -> str:
    """Mark of a frame's rows, whatever their order; a null is told from any value and from a null elsewhere."""
    cells = [F.when(F.col(f"`{c}`").isNull(), F.lit(n)).otherwise(F.xxhash64(F.lit(-1 - n), F.col(f"`{c}`"))) for n, c in enumerate(df.columns)]
    row = F.xxhash64(*cells)
    mark = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("h"), F.bit_xor(F.xxhash64(row, F.lit(1))).alias("x")).first()
    schema = zlib.crc32(df.schema.simpleString().encode())
    return f"{mark['n']}-{mark['h'] or 0}-{mark['x'] or 0}-{schema}"


def cached(inputs: DataFrame | Sequence[DataFrame], compute: Callable[[], DataFrame], folder: str, key: str) -> DataFrame:
    """Result of ``compute`` stored under ``folder`` by ``key`` and the fingerprints of its inputs.

    With equal inputs the stored rows are read and ``compute`` is not called; changed inputs have other
    fingerprints, so stale results are never served.
    """
    inputs = [inputs] if isinstance(inputs, DataFrame) else list(inputs)
    spark = inputs[0].sparkSession
    path = f"{folder.rstrip('/')}/{key}-" + "-".join(map(fingerprint, inputs))
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def json_rows(df: DataFrame, col: str, schema: str) -> DataFrame:
    """JSON array column to one row per element."""
    parsed = df.withColumn("__a", F.from_json(col, f"array<{schema}>"))
    return parsed.select("*", F.posexplode("__a").alias("pos", "__e")).select(
        *df.columns, "pos", "__e.*"
    )
