"""Many keys searched in one pass over texts: an Aho-Corasick automaton over each bounded block of keys.

Keys are dealt by hash into blocks and written to the shared folder.  A task reads texts in runs and lets each
run pass the blocks one after another, so the work is linear in the texts for keys of any length and number,
and neither the driver nor a task holds more than a few blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.strings import blank_words
from ..session import kept_in_worker, new_folder, read_folder

#: Characters of the keys of a block, and bytes of a run of texts.
BLOCK, RUN = 1 << 20, 1 << 23


class Blocks:
    """Where the blocks of a key table lie.  Sent to tasks in place of the keys."""

    def __init__(self, folder: str, count: int):
        self.folder, self.count = folder, count

    def table(self, number: int) -> pa.Table:
        """The rows of a block, read from the shared folder."""
        return read_folder(f"{self.folder}/block={number}")

    def load(self, number: int, build: Callable[[pa.Table], object]) -> object:
        """What ``build`` makes of a block, kept for the worker's next runs."""
        return kept_in_worker(f"{self.folder}/block={number}", lambda: build(self.table(number)))


def deal(rows: DataFrame, by: str, key: str, size: int = BLOCK) -> Blocks:
    """Write ``rows`` in blocks of about ``size`` characters of ``key``; rows of one ``by`` value share a block."""
    spark = rows.sparkSession
    chars = rows.agg(F.coalesce(F.sum(F.char_length(key)), F.lit(0))).first()[0]
    count = max(1, -(-chars // size))
    folder = new_folder(spark, "keys")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(by), F.lit(count)))
    dealt.repartition(count, "block").write.partitionBy("block").parquet(folder)
    return Blocks(folder, count)


def automaton(keys: list[str]):
    """An automaton that gives the numbers of the keys that end at each place of a text; None without keys."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for number, key in enumerate(keys):
        if key:
            out.add_word(key, number)
    if not len(out):
        return None
    out.make_automaton()
    return out


def _runs(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.Table]:
    """Batches put together into runs of about ``RUN`` characters."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= RUN:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def first_key(texts: DataFrame, text: str, keys: DataFrame, key: str, rank: str, out: str = "key") -> DataFrame:
    """Adds the key of smallest (rank, key) that occurs in the text, or null.

    ``keys`` holds distinct keys; empty and null keys and null ranks take no part.  Each row is looked up for
    itself, and no row moves.
    """
    wanted = keys.filter((F.col(key) != "") & F.col(rank).isNotNull()).select(F.col(key).alias("key"), F.col(rank).alias("rank"))
    blocks = deal(wanted, "key", "key")
    at = texts.columns.index(text)

    def build(table: pa.Table):
        if not table.num_rows:
            return None, []
        # numbers follow (rank, key), so the smallest number found is the first key
        rows = sorted(zip(table.column("rank").to_pylist(), table.column("key").to_pylist()))
        return automaton([k for _, k in rows]), rows

    def search(batches):
        for run in _runs(batches, at):
            best = [None] * run.num_rows
            for number in range(blocks.count):
                machine, rows = blocks.load(number, build)
                if machine is None:
                    continue
                for k, one in enumerate(run.column(at).to_pylist()):
                    if one:
                        found = min((n for _, n in machine.iter(one)), default=None)
                        if found is not None and (best[k] is None or rows[found] < best[k]):
                            best[k] = rows[found]
            yield from run.append_column(out, pa.array([b and b[1] for b in best], pa.string())).to_batches()

    schema = T.StructType([*texts.schema.fields, T.StructField(out, T.StringType())])
    return texts.mapInArrow(search, schema)


def _bordered(term: str) -> bool:
    """Whether the term can overlap itself."""
    return any(term.startswith(term[k:]) for k in range(1, len(term)))


class TermBlock:
    """Queries of a block: for each term its queries and weights, and on demand the automaton of the terms."""

    def __init__(self, table: pa.Table, query: str, search: bool):
        names = table.column(query).to_pylist() if table.num_rows else []
        terms = table.column("term").to_pylist() if names else []
        self.terms = sorted(set(terms))
        self.number = {t: k for k, t in enumerate(self.terms)}
        self.queries = list(dict.fromkeys(names))
        place = {q: k for k, q in enumerate(self.queries)}
        of = np.array([self.number[t] for t in terms], np.int64)
        order = np.argsort(of, kind="stable")
        self.query = np.array([place[q] for q in names], np.int64)[order]
        self.weight = (table.column("m").to_numpy().astype(np.float64) if names else np.zeros(0))[order]
        self.starts = np.searchsorted(of[order], np.arange(len(self.terms) + 1))
        self.overlapping = np.array([_bordered(t) for t in self.terms], bool) if search else None
        self.machine = automaton(self.terms) if search else None

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Terms in the text and how often each stands there without overlaps."""
        found = np.fromiter((n for _, n in self.machine.iter(text)), np.int64)
        terms, times = np.unique(found, return_counts=True)
        for k in np.flatnonzero(self.overlapping[terms] & (times > 1)).tolist():
            times[k] = text.count(self.terms[terms[k]])
        return terms, times

    def add(self, row: np.ndarray, terms: np.ndarray, amounts: np.ndarray) -> None:
        """Weight times amount of each term, for every query that holds it."""
        sizes = self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(self.starts[terms] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        row += np.bincount(self.query[at], self.weight[at] * np.repeat(amounts, sizes), minlength=len(row))

    def occurrences(self, texts: list[str]) -> np.ndarray:
        """Sum of weight times count, a row for each text and a column for each query."""
        out = np.zeros((len(texts), len(self.queries)))
        for row, text in zip(out, texts):
            if text:
                self.add(row, *self.counts(text))
        return out

    def okapi(self, texts: list[str], avgdl: float, k1: float, b: float) -> np.ndarray:
        """Okapi scores at nine digits, a row for each document and a column for each query."""
        out = np.zeros((len(texts), len(self.queries)))
        for row, text in zip(out, texts):
            tokens = blank_words(text)
            held = Counter(filter(self.number.__contains__, tokens))
            if held:
                tf = np.fromiter(held.values(), np.float64, len(held))
                reach = tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(tokens) / avgdl))
                self.add(row, np.fromiter((self.number[t] for t in held), np.int64, len(held)), reach)
        return np.round(out, 9)


class Best:
    """The ``k`` best documents of each query of a block, by score, then smaller id."""

    def __init__(self, queries: int, k: int):
        self.k, self.score, self.doc = k, np.zeros((queries, 0)), np.zeros((queries, 0), object)

    def add(self, scores: np.ndarray, docs: list) -> None:
        """``scores`` holds a row for each document."""
        if len(docs) > self.k:  # no more than k of a column, and all that tie with the last of them
            least = np.partition(scores, len(docs) - self.k, axis=0)[len(docs) - self.k]
            rows = np.flatnonzero((scores >= np.maximum(least, 1e-300)).any(axis=1))
            scores, docs = scores[rows], [docs[r] for r in rows.tolist()]
        if not docs:
            return
        ids = np.empty(len(docs), object)
        ids[:] = docs
        score = np.concatenate([self.score, scores.T], axis=1)
        doc = np.concatenate([self.doc, np.broadcast_to(ids, (len(score), len(docs)))], axis=1)
        _, order = np.unique(doc.ravel(), return_inverse=True)
        first = np.lexsort((order.reshape(doc.shape), -score), axis=1)[:, : self.k]
        self.score, self.doc = np.take_along_axis(score, first, 1), np.take_along_axis(doc, first, 1)


def count_topk(docs: DataFrame, doc: str, text: str, words: DataFrame, query: str, k: int, step: int = 512) -> DataFrame:
    """Columns query, doc, score: per task the ``k`` documents of the largest sum of m times the occurrences of the term.

    ``words`` holds query, term and m.  Occurrences of a term do not overlap.  Each task hands on at most ``k``
    documents per query; documents without an occurrence are left out.  Rows without id are left out.
    """
    return _scored(docs, doc, text, words.select(query, "term", "m"), query, k, step, True, lambda block, texts: block.occurrences(texts))


def okapi_topk(
    docs: DataFrame, doc: str, text: str, weights: DataFrame, query: str, k: int, avgdl: float, k1: float, b: float, step: int = 512
) -> DataFrame:
    """Columns query, doc, score: per task the ``k`` documents of the largest Okapi score above 0.

    ``weights`` holds query, term and w.  Texts are cut at blanks one after another, where they are scored.
    """
    wanted = weights.select(query, "term", F.col("w").alias("m"))
    return _scored(docs, doc, text, wanted, query, k, step, False, lambda block, texts: block.okapi(texts, avgdl, k1, b))


def counted_terms(docs: DataFrame, text: str, step: int = 512, most: int = 1 << 17) -> DataFrame:
    """Rows term, df, docs, tokens: per task how many texts hold a term, and rows without a term that number texts and tokens.

    A task counts in one pass and hands on what it has whenever it holds ``most`` terms.
    """
    kinds = pa.schema([("term", pa.string()), ("df", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())])

    def row(terms: list, df: list, docs: list, tokens: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((terms, df, docs, tokens), kinds)], schema=kinds)

    def run(batches):
        held: Counter[str] = Counter()
        for batch in batches:
            n, size = 0, 0
            for at in range(0, batch.num_rows, step):
                for one in batch.column(0).slice(at, step).to_pylist():
                    words = blank_words(one)
                    n, size = n + 1, size + len(words)
                    held.update(set(words))
                if len(held) >= most:
                    yield row(list(held), list(held.values()), [None] * len(held), [None] * len(held))
                    held.clear()
            yield row([None], [None], [n], [size])
        if held:
            yield row(list(held), list(held.values()), [None] * len(held), [None] * len(held))

    return docs.select(text).mapInArrow(run, "term string, df long, docs long, tokens long")


def term_rows(docs: DataFrame, doc: str, text: str, step: int = 512) -> DataFrame:
    """A row (doc, term, tf, dl) for each term of each text, dl being the text's words; no row moves for it."""
    schema = T.StructType([docs.schema[doc], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType()), T.StructField("dl", T.LongType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                held = [Counter(blank_words(one)) for one in part.column(1).to_pylist()]
                sizes = [len(h) for h in held]
                columns = [
                    part.column(0).take(pa.array(np.repeat(np.arange(len(held)), sizes))),
                    pa.array([t for h in held for t in h], pa.string()),
                    pa.array([n for h in held for n in h.values()], pa.int64()),
                    pa.array(np.repeat(np.array([h.total() for h in held], np.int64), sizes)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(doc, text).mapInArrow(run, schema)


def _scored(docs: DataFrame, doc: str, content: str, words: DataFrame, query: str, k: int, step: int, search: bool, score) -> DataFrame:
    blocks = deal(words, query, "term")
    rows = docs.select(doc, content).filter(F.col(doc).isNotNull())
    schema = T.StructType([words.schema[query], docs.schema[doc], T.StructField("score", T.DoubleType())])
    kinds = pa.schema([(f.name, _arrow(f.dataType)) for f in schema])

    def run(batches):
        best: dict[int, Best] = {}
        load = lambda number: blocks.load(number, lambda t: TermBlock(t, query, search))
        for run in _runs(batches, 1):
            for number in range(blocks.count):
                block = load(number)
                if block.terms:
                    held = best.setdefault(number, Best(len(block.queries), k))
                    for at in range(0, run.num_rows, step):  # no more than ``step`` texts are Python strings at a time
                        part = run.slice(at, step)
                        held.add(score(block, part.column(1).to_pylist()), part.column(0).to_pylist())
        for number, held in best.items():
            who, place = np.nonzero(held.score > 0)
            names = [load(number).queries[w] for w in who.tolist()]
            columns = [names, held.doc[who, place].tolist(), held.score[who, place].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    return rows.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
