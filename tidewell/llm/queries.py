"""The corpus operators on the driver tables, and the SQL that some of them must match."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontam, embeddup, licenses, mixing, pii, quality, rules, runs, simhash, spelling, substring, tokenfile, warc
from tidewell.llm.common import read
from tidewell.llm.sql import CONTAINMENT_SQL, SPELLING_SQL, WARC_SQL, mixing_sql, rules_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def tokenizer_path() -> str:
    """Place of the public byte-level vocabulary; TIDEWELL_TOKENIZER names another one."""
    named = os.environ.get("TIDEWELL_TOKENIZER")
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read(spark, sf_dir, "documents"))


@query("op2_mixing", mixing_sql())
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_decontamination", CONTAINMENT_SQL)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op5_licenses")
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).drop("spans")


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op8_substring")
def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


@query("op9_embeddings")
def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddup.near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op10_warc", WARC_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages")).drop("path", "record_no")


@query("op6_token_ids")
def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


@query("op11_rules", rules_sql())
def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read(spark, sf_dir, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """One document in ten, by the hash h of its id, with a period from some word on; others, and null ids, as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    repeated = F.expr(
        r"""element_at(transform(transform(filter(array(array_remove(split(text, '[\\x20\\x09-\\x0D]+'), '')), w -> size(w) > 0),
          w -> named_struct('w', w, 'g', h div 10, 'a', CAST((h div 10) % size(w) AS INT))),
          x -> array_join(concat(slice(x.w, 1, x.a), transform(sequence(x.a, size(x.w) - 1), i ->
            get(x.w, CAST(x.a + (i - x.a) % (1 + (size(x.w) - x.a) div (3 + x.g % 8)) AS INT)))), ' ')), -1)"""
    )
    rows = docs.select("doc_id", "text", h.alias("h"))
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), repeated).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """What op12 reports of ``runs.collapse_runs``: the count, the run of the greatest exponent, and digests."""
    best = F.expr("aggregate(runs, get(runs, 0), (b, r) -> IF(r.length * b.period > b.length * r.period, r, b))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), listed.alias("listed")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_runs")
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(runs.collapse_runs(with_periods(read(spark, sf_dir, "documents"))))


def misspelt(doc_id: Column, run: Column) -> Column:
    """The run, for one in 31 by the hash of id (null: empty) and run without the code point that the hash names."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


@query("op13_spelling", SPELLING_SQL)
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(read(spark, sf_dir, "documents"), misspelt))
