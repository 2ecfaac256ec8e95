"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification."""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import ids_and_texts, short_batches, whole_text

#: Words are runs of letters and digits: ASCII ones after A-Z became a-z, and all characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 5
CONTAINED = 0.8
#: Least hashes kept of an item, and the chance at most that a contained item shows too few of them.
SKETCH = 32
MISS = 1e-9
#: Items are searched in blocks of at most this many shingle rows, which bounds what a task is sent.
BLOCK = 200_000
#: Words of a document that are hashed at a time.
RUN = 1 << 17
MATCH = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("shared", T.IntegerType()), T.StructField("shingles", T.IntegerType())]))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Every ASCII character that no word holds becomes a space.
_BLANK = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_shingles(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Columns item_id and shingle: the distinct five-word shingles of each item, rows of an id together.

    An item of one to four words has its whole word sequence as its one shingle, an item without words none.
    """
    words = F.regexp_extract_all(lowered(whole_text(benchmark[text_col])), F.lit(f"({WORD})"))
    rows = benchmark.select(benchmark[id_col].cast("long").alias("item_id"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (SHINGLE - 1), F.lit(1)))
    return rows.select("item_id", F.explode(F.transform(starts, lambda i: F.concat_ws(" ", F.slice("w", i, SHINGLE)))).alias("shingle")).distinct()


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[DataFrame]:
    """The items' shingles cut into blocks of about ``BLOCK`` rows; an item is never cut."""
    rows = item_shingles(benchmark, id_col, text_col)
    blocks = max(1, -(-rows.count() // BLOCK))
    return [rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) for k in range(blocks)]


def size_class(shingles: int) -> int:
    """Items of 2^c to 2^(c+1) - 1 shingles share class c."""
    return shingles.bit_length() - 1


def sketch_plan(shingles: int, contained: float = CONTAINED) -> tuple[int, int]:
    """Hashes kept of an item of a size class's largest size, and how many of them must be found.

    A document that holds the wanted share of the shingles shows fewer than that with a chance below ``MISS``
    (hypergeometric, over the sizes of the class).  Items no larger than the sketch are kept whole.
    """
    c = size_class(shingles)
    if 2 ** (c + 1) - 1 <= SKETCH:
        return shingles, -int(-(contained * shingles) // 1)
    need = SKETCH
    for q in (2**c, 2 ** (c + 1) - 1):
        k = min(SKETCH, q)
        present = -int(-(contained * q) // 1)
        low, seen = 0.0, 0
        while seen < k:
            low += comb(present, seen) * comb(q - present, k - seen) / comb(q, k)
            if low > MISS:
                break
            seen += 1
        need = min(need, seen)
    return SKETCH, max(1, need)


def _hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _hash_runs(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words, from the words' hashes."""
    n = len(h) - width + 1
    out = h[:n].copy()
    for k in range(1, width):
        out = (out ^ (out >> np.uint64(29))) * _MIX + h[k : k + n]
    return (out ^ (out >> np.uint64(32))) * _ODD


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BLANK).split()


class ItemIndex:
    """Sketches of one block of items, partitioned by size, and the shingles to verify with."""

    def __init__(self, rows: list[tuple[int | None, str]], contained: float = CONTAINED):
        by_item: dict[int | None, list[str]] = {}
        for item, shingle in rows:
            by_item.setdefault(item, []).append(shingle)
        self.ids = sorted(by_item, key=lambda x: (x is None, x))
        self.shingles = [[s.encode() for s in by_item[i]] for i in self.ids]
        self.least = [-int(-(contained * len(s)) // 1) for s in self.shingles]
        self.parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []  # width, hash, item, hits needed
        chosen: dict[int, list[tuple[int, int]]] = {}
        self.need = np.zeros(len(self.ids), np.int64)
        for at, shingles in enumerate(self.shingles):
            width = shingles[0].count(b" ") + 1
            kept, self.need[at] = sketch_plan(len(shingles), contained)
            hashes = sorted(int(_hash_runs(_hash_words(s.split(b" ")), width)[0]) for s in shingles)
            chosen.setdefault(width, []).extend((h, at) for h in hashes[:kept])
        for width, pairs in sorted(chosen.items()):
            pairs.sort()
            hashes, owner = np.array([h for h, _ in pairs], np.uint64), np.array([a for _, a in pairs])
            door = np.zeros(1 << 20, bool)
            door[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.parts.append((width, hashes, owner, door))

    def candidates(self, words: list[bytes]) -> list[int]:
        found = [set() for _ in self.parts]
        for at in range(0, len(words), RUN):
            h = _hash_words(words[at : at + RUN + SHINGLE - 1])
            for k, (width, hashes, _, door) in enumerate(self.parts):
                if len(h) >= width:
                    runs = _hash_runs(h, width)
                    runs = np.unique(runs[door[(runs >> np.uint64(44)).astype(np.int64)]])
                    near = np.minimum(np.searchsorted(hashes, runs), len(hashes) - 1)
                    found[k].update(runs[hashes[near] == runs].tolist())
        hits = np.zeros(len(self.ids), np.int64)
        for (_, hashes, owner, _), seen in zip(self.parts, found):
            for x in seen:
                lo, hi = np.searchsorted(hashes, np.uint64(x), "left"), np.searchsorted(hashes, np.uint64(x), "right")
                hits[owner[lo:hi]] += 1
        return np.flatnonzero((hits >= self.need) & (hits > 0)).tolist()

    def search(self, text: str) -> list[tuple[int | None, int, int]]:
        words = _words(text)
        out, near = [], self.candidates(words)
        if not near:
            return out
        wanted = {s for at in near for s in self.shingles[at]}
        present = set()
        for width in {s.count(b" ") + 1 for s in wanted}:
            runs = (b" ".join(words[i : i + width]) for i in range(len(words) - width + 1))
            present.update(wanted.intersection(runs))
        for at in near:
            shared = sum(s in present for s in self.shingles[at])
            if shared >= self.least[at]:
                out.append((self.ids[at], shared, len(self.shingles[at])))
        return out


def matches(block: DataFrame, text: Column, contained: float = CONTAINED) -> Column:
    """Items of one block that the text contains: array of (item_id, shared, shingles).

    The block's rows are bounded by ``BLOCK`` (and one item), so they may go to every task.
    """
    index = ItemIndex([tuple(r) for r in block.select("item_id", "shingle").collect()], contained)

    @F.pandas_udf(MATCH)
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(index.search)

    return found(whole_text(text))


def contained_items(
    docs: DataFrame, benchmark: DataFrame, contained: float = CONTAINED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Columns doc_id, item_id, n_shared, n_shingles, containment: documents that hold an item's shingles.

    An item is contained if at least ``contained`` of its distinct shingles stand anywhere in the whole
    document.  The side of the short items is sketched, so a document's length never weakens the search:
    items are partitioned by size, each class keeps as many least hashes as its size needs, documents of any
    length are streamed past them, and enough hits lead to an exact count on the shingles themselves.
    Null and empty texts contain nothing; each row of a repeated doc_id reports for itself; a null doc_id or
    item_id stays null; items of equal id are one item; empty tables give no rows.
    """
    spark = docs.sparkSession
    short_batches(spark)
    rows = ids_and_texts(docs, id_col, text_col)
    parts = [rows.select("doc_id", F.explode(matches(b, rows["text"], contained)).alias("m")) for b in item_blocks(benchmark)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.select(
        "doc_id",
        "m.item_id",
        F.col("m.shared").cast("long").alias("n_shared"),
        F.col("m.shingles").cast("long").alias("n_shingles"),
        F.round(F.col("m.shared") / F.col("m.shingles"), 6).alias("containment"),
    )


def without_contained(docs: DataFrame, benchmark: DataFrame, contained: float = CONTAINED, text_col: str = "text") -> DataFrame:
    """The documents that contain no item, with all columns and without a shuffle.  Null texts stay."""
    short_batches(docs.sparkSession)
    for block in item_blocks(benchmark):
        docs = docs.where(F.size(matches(block, docs[text_col], contained)) == 0)
    return docs
