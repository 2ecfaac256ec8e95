"""Substring dedup: passages that repeat across documents, found level by level at doubled lengths."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts, short_batches, spaced_words
from tidewell.session import drop_settled, settle

WINDOW = 50
#: Words of the shortest level at most.
START = 13
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NONE = hashlib.sha256(b"").hexdigest()


def levels(window: int, start: int = START) -> list[int]:
    """Window lengths, each at most twice the one before it, the last one ``window``."""
    out = [window]
    while out[0] > start:
        out.insert(0, -(-out[0] // 2))
    return out


def word_hashes(text: str, seed: int = 0) -> tuple[np.ndarray, str]:
    """A hash of every word and the SHA-256 of the words joined by one space."""
    hashes, whole, lead = [np.zeros(0, np.uint64)], hashlib.sha256(), b""
    for words in spaced_words(text, lower=False):
        if words:
            hashes.append(np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words)))
            whole.update(lead + b" ".join(words))
            lead = b" "
    return np.concatenate(hashes), whole.hexdigest()


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words, made by doubling: two half runs (overlapping at the end) give one."""
    out, have = h, 1
    while have < length:
        shift = min(have, length - have)
        if len(out) <= shift:
            return np.zeros(0, np.uint64)
        left, right = out[: len(out) - shift], out[shift:] * _MIX
        out = (left ^ (left >> np.uint64(31))) * _MIX + right
        out ^= out >> np.uint64(29)
        have += shift
    return out


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    have = 1
    while have < width:
        shift = min(have, width - have)
        x = pick(x[: len(x) - shift], x[shift:])
        have += shift
    return x


def anchors(h: np.ndarray, length: int, window: int) -> np.ndarray:
    """Hashes of the runs of ``length`` words that are the least within some window.

    Two equal windows have the same least run, so every repeated window holds a repeated anchor.
    """
    if len(h) < window:
        return np.zeros(0, np.uint64)
    runs, span = window_hashes(h, length), window - length + 1
    edge = np.zeros(span - 1, np.uint64)
    highest = _slide(np.concatenate([edge, _slide(runs, span, np.minimum), edge]), span, np.maximum)
    return np.unique(runs[highest == runs])


def _longs(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *lists]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _heads(docs: DataFrame, first: int, window: int) -> DataFrame:
    """A row per document: doc_id, raw (a hash of its text), sha (of its words), n_words, marks (of its anchors)."""

    def run(batches):
        for batch in batches:
            shas, sizes, marks = [], [], []
            for text in batch.column(2).to_pylist():
                h, sha = word_hashes(text)
                shas.append(sha)
                sizes.append(len(h))
                marks.append(anchors(h, first, window))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shas, pa.string()), pa.array(sizes, pa.int64()), _longs(marks)],
                ["doc_id", "raw", "sha", "n_words", "marks"],
            )

    return docs.select("doc_id", "raw", "text").mapInArrow(run, "doc_id long, raw long, sha string, n_words long, marks array<long>")


def _repeated(rows: DataFrame) -> DataFrame:
    """Per document the marks that stand in another document too; rows hold doc_id, raw, mark."""
    often = rows.groupBy("mark").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("mark")
    return rows.join(often, "mark").groupBy("doc_id", "raw").agg(F.collect_list("mark").alias("marks"))


def _longer(held: DataFrame, short: int, long: int) -> DataFrame:
    """doc_id, raw, mark of the windows of ``long`` words that start or end with a repeated window of ``short``."""

    def run(batches):
        for batch in batches:
            ids, raws, marks = [], [], []
            for doc_id, raw, text, known in zip(*(c.to_pylist() for c in batch.columns)):
                h, _ = word_hashes(text)
                at = np.flatnonzero(np.isin(window_hashes(h, short).view(np.int64), known))
                starts = np.concatenate([at, at - (long - short)])
                wide = window_hashes(h, long)
                found = np.unique(wide[starts[(starts >= 0) & (starts < len(wide))]])
                ids += [doc_id] * len(found)
                raws += [raw] * len(found)
                marks.append(found)
            flat = np.concatenate([np.zeros(0, np.uint64), *marks]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raws, pa.int64()), pa.array(flat)], ["doc_id", "raw", "mark"])

    return held.select("doc_id", "raw", "text", "marks").mapInArrow(run, "doc_id long, raw long, mark long")


def _windows(held: DataFrame, short: int, window: int) -> DataFrame:
    """doc_id, raw, start and a 128-bit hash of the windows that hold a repeated run of ``short`` words."""

    def run(batches):
        for batch in batches:
            ids, raws, parts = [], [], []
            for doc_id, raw, text, known in zip(*(c.to_pylist() for c in batch.columns)):
                h, _ = word_hashes(text)
                if len(h) < window:
                    continue
                marked = np.isin(window_hashes(h, short).view(np.int64), known)
                near = np.flatnonzero(_slide(marked, window - short + 1, np.logical_or))
                again, _ = word_hashes(text, seed=1)
                parts.append((near, window_hashes(h, window)[near], window_hashes(again, window)[near]))
                ids += [doc_id] * len(near)
                raws += [raw] * len(near)
            cols = [np.concatenate([np.zeros(0, kind), *(p[k] for p in parts)]) for k, kind in enumerate((np.int64, np.uint64, np.uint64))]
            arrays = [pa.array(ids, pa.int64()), pa.array(raws, pa.int64()), *(pa.array(c.view(np.int64)) for c in cols)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "raw", "start", "h1", "h2"])

    return held.select("doc_id", "raw", "text", "marks").mapInArrow(run, "doc_id long, raw long, start long, h1 long, h2 long")


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """doc_id, raw, n_removed, kept_sha256, kept of documents with the starts of their repeated windows."""

    def run(batches):
        for batch in batches:
            removed, digests, texts = [], [], []
            for text, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                covered, at, kept, gone = np.sort(np.array(starts, np.int64)), 0, [], 0
                for words in spaced_words(text, lower=False):
                    here = np.arange(at, at + len(words))
                    last = np.searchsorted(covered, here, "right") - 1
                    out = (last >= 0) & (here - covered[np.maximum(last, 0)] < window)
                    gone += int(out.sum())
                    kept += [w for w, o in zip(words, out) if not o]
                    at += len(words)
                left = b" ".join(kept)
                removed.append(gone)
                digests.append(hashlib.sha256(left).hexdigest())
                texts.append(left.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "raw", "n_removed", "kept_sha256", "kept"],
            )

    return rows.select("doc_id", "raw", "text", "starts").mapInArrow(run, "doc_id long, raw long, n_removed long, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, start: int = START, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_words, n_removed, kept_sha256, kept: documents without their repeated windows.

    A word goes if a window of ``window`` words covers it whose words also start in a document of smaller
    doc_id, judged on the input.  ``kept`` holds the words left, joined by one space, of documents that lost
    some but not all words, else null.

    Level by level: runs of ``start`` words at most that are the least of their window are compared first;
    those alone that repeat are extended to twice the length, until the full window is reached or none is
    left.  Documents of equal words are decided by one of them (the smallest doc_id), which holds every window
    of the others, so large groups of copies cost one document.  The last level compares 128 bits.

    Null and empty texts have no words.  A null doc_id is smaller than none and no document is smaller than
    it: its row loses nothing and takes nothing from others.  Repeated rows of a doc_id are one document and
    take nothing from each other.  An empty table gives no rows.
    """
    short_batches(docs.sparkSession)
    texts = ids_and_texts(docs, id_col, text_col).withColumn("raw", F.xxhash64("text"))
    lengths = levels(window, start)
    heads = settle(_heads(texts, lengths[0], window))
    firsts = heads.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("first"))
    marked = heads.where("doc_id is not null and size(marks) > 0").join(firsts, "sha").where("doc_id = first")
    marks = settle(_repeated(marked.select("doc_id", "raw", F.explode("marks").alias("mark")).distinct()))
    held = settle(texts.join(marks, ["doc_id", "raw"]))
    for short, long in zip(lengths, lengths[1:-1]):
        longer = settle(_repeated(_longer(held, short, long).distinct()))
        narrowed = settle(held.drop("marks").join(longer, ["doc_id", "raw"]))
        drop_settled(held, longer)
        held = narrowed
    windows = settle(_windows(held, lengths[-2] if len(lengths) > 1 else lengths[0], window))
    lowest = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    starts = windows.join(lowest, ["h1", "h2"]).where("low < doc_id").groupBy("doc_id", "raw").agg(F.collect_set("start").alias("starts"))
    cut = _cut(held.drop("marks").dropDuplicates(["doc_id", "raw"]).join(starts, ["doc_id", "raw"]), window)
    copy = (F.col("first") < F.col("doc_id")) & (F.col("n_words") >= window)
    out = heads.drop("marks").join(firsts, "sha", "left").join(cut, ["doc_id", "raw"], "left")
    return out.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(_NONE)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(~copy, F.col("kept")).alias("kept"),
    )
