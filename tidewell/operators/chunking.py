"""Cutting texts: chunks, character windows, vocabularies and token-bounded batches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import strings as S
from ..session import spread
from .ordered import _names, join_on_keys, with_position

# Separator orders of the plain and the heading-first splitter.
PLAIN = ("\n\n", "\n", " ", "")
HEADINGS = ("\n## ", "\n### ", "\n", " ", "")
#: Texts whose parts a task holds at a time.
FEW = 64


def title_and_body(df: DataFrame, title: str, body: str, name: str = "text") -> DataFrame:
    """Title and body joined by a blank line; records with neither are left out."""
    return df.withColumn(name, S.join_parts([title, body])).filter(F.col(name) != "")


def chunk_fixed(df: DataFrame, id_col: str, text: str, size: int = 1000, overlap: int = 150) -> DataFrame:
    """Windows of ``size`` characters every ``size - overlap``; one linear pass over each text."""
    stride = size - overlap
    found = F.regexp_extract_all(F.col(text), F.lit(rf"(?s)\G(?=(.{{1,{size}}})).{{1,{stride}}}"), F.lit(1))
    out = df.select(id_col, F.posexplode(found).alias("chunk_index", "text"))
    return out.filter((F.col("chunk_index") == 0) | (F.length("text") > overlap))


def _pieces(text: str, sep: str) -> list[str]:
    """Split keeping each separator at the head of the piece that follows it."""
    if sep == "":
        return list(text)
    head, *rest = text.split(sep)
    return [p for p in (head, *(sep + r for r in rest)) if p]


def _pack(pieces: Sequence[str], size: int, overlap: int) -> Iterator[str]:
    """Join neighbouring pieces up to ``size``, starting each chunk with at most ``overlap`` of the last."""
    held: list[str] = []
    total = 0
    for p in pieces:
        if held and total + len(p) > size:
            yield "".join(held)
            while held and (total > overlap or total + len(p) > size):
                total -= len(held.pop(0))
        held.append(p)
        total += len(p)
    if held:
        yield "".join(held)


def split_recursive(text: str, size: int, overlap: int, separators: Sequence[str] = PLAIN) -> list[str]:
    """Split on the first separator present, refining only the pieces that are still too long."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    finer = separators[at + 1 :]
    out: list[str] = []
    fitting: list[str] = []
    for p in _pieces(text, separators[at]):
        if len(p) < size:
            fitting.append(p)
            continue
        out.extend(_pack(fitting, size, overlap))
        fitting = []
        out.extend(split_recursive(p, size, overlap, finer) if finer else [p])
    out.extend(_pack(fitting, size, overlap))
    return [c for c in (o.strip() for o in out) if c]


def chunk_recursive(
    df: DataFrame, id_col: str, text: str, size: int = 1000, overlap: int = 150, separators: Sequence[str] = PLAIN
) -> DataFrame:
    """Recursive chunks with their index.  Where to cut depends on the text itself, so Arrow batches go to Python, which holds ``FEW`` texts at a time."""
    id_type = df.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField(id_col, id_type), T.StructField("chunk_index", T.IntegerType()), T.StructField("text", T.StringType())]
    )
    seps = tuple(separators)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, FEW):
                b = whole.slice(at, FEW)
                parts = [split_recursive(t or "", size, overlap, seps) for t in b.column(1).to_pylist()]
                counts = [len(p) for p in parts]
                columns = [
                    b.column(0).take(pa.array(np.repeat(np.arange(len(parts)), counts))),
                    pa.array([i for n in counts for i in range(n)], pa.int32()),
                    pa.array([c for p in parts for c in p], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return spread(df.select(id_col, text)).mapInArrow(cut, schema)


def char_vocab(df: DataFrame, text: str) -> DataFrame:
    """Distinct characters in code point order with an index from 0; Unicode bounds their number."""
    chars = df.select(F.explode(F.regexp_extract_all(F.col(text), F.lit("(?s)(.)"), F.lit(1))).alias("ch")).distinct()
    return chars.withColumn("idx", (F.row_number().over(Window.orderBy("ch")) - 1).cast("bigint"))


def char_windows(df: DataFrame, id_col: str, text: str, seq_len: int) -> DataFrame:
    """Every window of ``seq_len`` characters with the window one character later as target."""
    both = F.regexp_extract_all(F.col(text), F.lit(rf"(?s)(?=(.{{{seq_len + 1}}}))"), F.lit(1))
    out = df.select(id_col, F.posexplode(both).alias("pos", "__w"))
    return out.select(id_col, "pos", F.substring("__w", 1, seq_len).alias("x"), F.substring("__w", 2, seq_len).alias("y"))


# -- token-bounded batches ---------------------------------------------------------------


def _next_start(tokens: np.ndarray, max_tokens: int, max_count: int) -> np.ndarray:
    """For a batch starting at each place, where the following batch starts."""
    n = len(tokens)
    ends = np.cumsum(tokens)
    before = ends - tokens
    fits = np.searchsorted(ends, before + max_tokens, side="right")
    alone = tokens >= max_tokens
    spots = np.flatnonzero(alone)
    later = np.searchsorted(spots, np.arange(n), side="right")
    stop = np.where(later < len(spots), np.append(spots, n)[np.minimum(later, len(spots))], n)
    here = np.arange(n)
    nxt = np.minimum(np.minimum(fits, stop), here + max_count)
    return np.where(alone, here + 1, np.maximum(nxt, here + 1))


def _leave(nxt: np.ndarray, end: int) -> np.ndarray:
    """Follow starts from every place until one lies at or past ``end``."""
    to = np.append(np.minimum(nxt, len(nxt)), len(nxt))
    while True:
        inside = to < end
        step = np.where(inside, to[np.minimum(to, len(to) - 1)], to)
        if np.array_equal(step, to):
            return to[:-1]
        to = step


def token_batches(
    df: DataFrame,
    tokens: str,
    key,
    order_by,
    max_tokens: int = 290_000,
    max_count: int = 300,
    block: int = 20_000,
    fan: int = 500,
) -> DataFrame:
    """Greedy batches in order inside each key: adds ``batch`` from 1.

    A new batch starts when the token sum would pass ``max_tokens`` or the batch has
    ``max_count`` rows; an item of ``max_tokens`` or more is alone.  Where a batch starts
    depends on all earlier ones, yet it reaches at most ``max_count`` rows ahead.  So each block
    of rows is reduced to a table "entered at offset e, the next block is entered at offset f";
    tables of ``fan`` blocks are composed level by level, and the true entries are then passed
    back down.  No task holds more than one block or ``fan`` tables, however long a key is.
    """
    keys = _names(key)
    block = max(block, max_count)
    rows = with_position(df, order_by, keys).withColumn("__b0", F.floor((F.col("rn") - 1) / block))
    slot = F.pmod(F.col("rn") - 1, F.lit(block))
    lean = rows.select(*keys, "rn", F.col(tokens).cast("bigint").alias("__tok"), "__b0", slot.alias("__slot"))
    # Rows at the head of a block are also read by the block before, to finish its last batch.
    ahead = lean.filter((F.col("__slot") < max_count) & (F.col("__b0") > 0)).withColumn("__b0", F.col("__b0") - 1)
    body = lean.withColumn("__own", F.lit(True)).unionByName(ahead.withColumn("__own", F.lit(False)))
    key_fields = [rows.schema[k] for k in keys]
    bigint = lambda *names: [T.StructField(n, T.LongType()) for n in names]

    def enter(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        nxt = _next_start(pdf["__tok"].to_numpy(np.int64), max_tokens, max_count)
        own = int(pdf["__own"].sum())
        doors = min(max_count, own)
        out = pd.DataFrame({"__in": np.arange(doors), "__out": np.maximum(_leave(nxt, own)[:doors] - own, 0)})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        out["__b0"] = pdf["__b0"].iloc[0]
        return out

    def compose(level: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            blocks = [g.set_index("__in")["__out"] for _, g in pdf.sort_values(f"__b{level}").groupby(f"__b{level}")]
            entries = np.array(blocks[0].index)
            at = entries
            for table in blocks:
                at = table.reindex(at).fillna(0).to_numpy(np.int64)
            out = pd.DataFrame({"__in": entries, "__out": at})
            for k in keys:
                out[k] = pdf[k].iloc[0]
            out[f"__b{level + 1}"] = pdf[f"__b{level + 1}"].iloc[0]
            return out

        return run

    def walk(level: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            at = int(pdf["__enter"].iloc[0])
            ids, ins = [], []
            for b, g in pdf.sort_values(f"__b{level}").groupby(f"__b{level}"):
                ids.append(b)
                ins.append(at)
                at = int(g.set_index("__in")["__out"].get(at, 0))
            out = pd.DataFrame({f"__b{level}": ids, "__enter": ins})
            for k in keys:
                out[k] = pdf[k].iloc[0]
            return out

        return run

    longest = rows.agg(F.max("__b0")).first()[0] or 0
    tables = [body.groupBy(*keys, "__b0").applyInPandas(enter, T.StructType([*key_fields, *bigint("__b0", "__in", "__out")]))]
    while longest >= fan:
        level = len(tables) - 1
        up = tables[-1].withColumn(f"__b{level + 1}", F.floor(F.col(f"__b{level}") / fan))
        schema = T.StructType([*key_fields, *bigint(f"__b{level + 1}", "__in", "__out")])
        tables.append(up.groupBy(*keys, f"__b{level + 1}").applyInPandas(compose(level), schema))
        longest //= fan
    top = len(tables) - 1
    entries = None
    for level in range(top, -1, -1):
        up = tables[level].withColumn(f"__b{level + 1}", F.floor(F.col(f"__b{level}") / fan) if level < top else F.lit(0))
        if entries is None:
            up = up.withColumn("__enter", F.lit(0).cast("bigint"))
        else:
            up = join_on_keys(up, entries, [*keys, f"__b{level + 1}"])
        schema = T.StructType([*key_fields, *bigint(f"__b{level}", "__enter")])
        entries = up.groupBy(*keys, f"__b{level + 1}").applyInPandas(walk(level), schema)

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        nxt = _next_start(pdf["__tok"].to_numpy(np.int64), max_tokens, max_count)
        own = int(pdf["__own"].sum())
        starts = np.zeros(len(pdf), np.int64)
        at = int(pdf["__enter"].iloc[0])
        while at < own:
            starts[at] = 1
            at = int(nxt[at])
        out = pdf[[*keys, "rn", "__b0"]].iloc[:own].copy()
        out["__in_block"] = np.cumsum(starts)[:own]
        return out

    marked = join_on_keys(body, entries, [*keys, "__b0"])
    schema = T.StructType([*key_fields, *bigint("rn", "__b0", "__in_block")])
    marked = marked.groupBy(*keys, "__b0").applyInPandas(mark, schema)
    sizes = marked.groupBy(*keys, "__b0").agg(F.max("__in_block").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__b0").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, "__b0", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = join_on_keys(marked, sizes, [*keys, "__b0"])
    numbered = numbered.select(*keys, "rn", (F.col("__in_block") + F.col("__before")).alias("batch"))
    return join_on_keys(rows.drop("__b0"), numbered, [*keys, "rn"])


def sentences(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(c, F.lit(r"([^.!?\n]+[.!?]*)"), F.lit(1))


def extractive_summary(df: DataFrame, id_col: str, text: str, size: int = 2000, per_chunk: int = 2) -> DataFrame:
    """Best sentences of each chunk by term frequency, joined in order per document.

    A chunk is scored where it stands, so no row moves for a word; texts that share an id share their chunks.
    """
    local = df.filter(F.col(id_col).isNotNull()).select(id_col, text)
    cut = chunk_fixed(local, id_col, text, size, 0).groupBy(id_col, "chunk_index").agg(F.collect_list("text").alias("__copies"))
    said = cut.select(id_col, "chunk_index", F.transform("__copies", sentences).alias("__said"))
    said = said.withColumn("__words", F.transform("__said", lambda copy: F.transform(copy, lambda one: S.tokens(one))))
    schema = T.StructType(
        [df.schema[id_col], T.StructField("chunk_index", T.IntegerType()), T.StructField("pos", T.IntegerType()), T.StructField("sentence", T.StringType())]
    )

    def best(copies: list[list[list[str]]]) -> list[int]:
        """Places of the sentences whose words occur most in the chunk."""
        times = Counter(w for copy in copies for words in copy for w in words)
        score: Counter[int] = Counter()
        for copy in copies:
            for pos, words in enumerate(copy):
                if words:
                    score[pos] += sum(times[w] for w in words)
        return sorted(score, key=lambda pos: (-score[pos], pos))[:per_chunk]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, FEW):
                b = whole.slice(at, FEW)
                rows = zip(b.column(2).to_pylist(), b.column(3).to_pylist())
                found = [(i, pos, copy[pos]) for i, (copies, words) in enumerate(rows) for pos in best(words) for copy in copies if pos < len(copy)]
                of = pa.array([i for i, _, _ in found], pa.int64())
                columns = [b.column(0).take(of), b.column(1).take(of), pa.array([p for _, p, _ in found], pa.int32()), pa.array([s for _, _, s in found], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    picked = said.mapInArrow(pick, schema)
    items = F.sort_array(F.collect_list(F.struct("chunk_index", "pos", F.trim("sentence").alias("s"))))
    return picked.groupBy(id_col).agg(F.array_join(items.getField("s"), "\n").alias("summary"))
