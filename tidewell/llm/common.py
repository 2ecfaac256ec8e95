"""What several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20
SPACES = b" \t\n\r\x0b\x0c"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python workers in Arrow batches of at most ``rows`` rows, so that long texts fit."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name, "10000")) > rows:
        spark.conf.set(name, str(rows))


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns doc_id (long) and text (string, null as empty) and no others."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), whole_text(docs[text_col]).alias("text"))


def whole_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def spaced_words(text: str, lower: bool) -> Iterator[list[bytes]]:
    """The words between white space (space and \\x09-\\x0D) as UTF-8, in runs of about ``PIECE`` bytes.

    ``lower`` maps A-Z to a-z.  A text of any length needs the memory of one run of words.
    """
    return spaced_pieces(text.encode("utf-8", "surrogatepass"), lower)


def spaced_pieces(data: bytes, lower: bool = False) -> Iterator[list[bytes]]:
    """``spaced_words`` of a text in UTF-8."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in SPACES:
            end += 1
        run = data[at:end]
        at = end
        yield (run.lower() if lower else run).split()
