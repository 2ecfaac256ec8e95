"""Postings of texts, packed in the tasks that read them, and their search under score bounds.

A segment is one row: some documents in the order of their ids, the terms they hold, and for each term the places
of its documents and how often each holds it, as bytes.  No row stands for a single posting, and a search reads
whole segments, so neither moves a posting.  Every ``DOC_BLOCK`` documents of a segment are a block.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.strings import blank_words
from .multipattern import _arrow, deal

#: Documents of a block of postings, what rounding may take from a score, and the share of a score that the
#: terms which open no block may reach together.
DOC_BLOCK, MARGIN, WEAK = 16, 1e-8, 0.1
#: Blocks of a query that are scored first.
LEAD = 16
#: Documents and postings of a segment, at most.
DOCS, POSTINGS = 4096, 1 << 20
#: How segments are written: few of them are read at a time.
WRITTEN = {"parquet.block.row.count.limit": "4"}

Reach = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _packed(kind: T.DataType) -> T.StructType:
    """``whole`` is false where a document's terms go on in other segments; ``tokens`` are the words counted here."""
    fields = {
        "whole": T.BooleanType(), "tokens": T.LongType(), "docs": T.ArrayType(kind), "sizes": T.BinaryType(),
        "terms": T.ArrayType(T.StringType()), "held": T.ArrayType(T.IntegerType()), "places": T.BinaryType(), "tf": T.BinaryType(),
    }
    return T.StructType([T.StructField(name, one) for name, one in fields.items()])


def _short(values: np.ndarray) -> bytes:
    return values.astype(np.min_scalar_type(values.max())).tobytes()


def _long(data: pa.BinaryScalar, most: int) -> np.ndarray:
    """The ``most`` numbers that ``_short`` was given."""
    raw = data.as_buffer()
    return np.frombuffer(raw, f"u{raw.size // most}")


class Packer:
    """Takes documents with their terms and gives segments of at most ``most`` documents and postings."""

    def __init__(self, kind: T.DataType, most: tuple[int, int]):
        self.most, self.kind, self.schema = most, _arrow(kind), pa.schema([(f.name, _arrow(f.dataType)) for f in _packed(kind)])
        self._clear()

    def _clear(self) -> None:
        self.docs, self.sizes, self.counts = [], array("q"), array("q")
        self.code: defaultdict[str, int] = defaultdict(count().__next__)
        self.codes, self.tf = array("i"), array("q")

    def _hold(self, doc, terms: Sequence[str], tf: Sequence[int], size: int) -> None:
        self.docs.append(doc)
        self.sizes.append(size)
        self.counts.append(len(terms))
        self.codes.extend(map(self.code.__getitem__, terms))
        self.tf.extend(tf)

    def add(self, doc, terms: Sequence[str], tf: Sequence[int], size: int, whole: bool = True) -> Iterator[pa.RecordBatch]:
        """``size`` is the number of words of the document.  Too many terms are cut into several segments."""
        docs, postings = self.most
        if not whole or len(terms) > postings:
            yield from self.flush()
            for at in range(0, len(terms), postings):
                self._hold(doc, terms[at : at + postings], tf[at : at + postings], size)
                yield from self.flush(False)
        elif terms:
            if len(self.docs) == docs or len(self.codes) + len(terms) > postings:
                yield from self.flush()
            self._hold(doc, terms, tf, size)

    def flush(self, whole: bool = True) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        docs, terms = pa.array(self.docs, self.kind), pa.array(list(self.code), pa.string())
        by_id = pc.array_sort_indices(docs, null_placement="at_start")
        by_term = pc.array_sort_indices(terms)
        place, number = np.empty(len(docs), np.int64), np.empty(len(terms), np.int64)
        place[by_id.to_numpy()] = np.arange(len(docs))
        number[by_term.to_numpy()] = np.arange(len(terms))
        codes = number[np.frombuffer(self.codes, np.intc)]
        places = np.repeat(place, np.frombuffer(self.counts, np.int64))
        order = np.argsort(codes * len(docs) + places)
        tf = np.frombuffer(self.tf, np.int64)
        held = np.bincount(codes, minlength=len(terms)).astype(np.int32)
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        columns = {
            "whole": pa.array([whole]), "tokens": pa.array([int(tf.sum())], pa.int64()), "docs": one(docs.take(by_id)),
            "sizes": pa.array([_short(np.frombuffer(self.sizes, np.int64)[by_id.to_numpy()])], pa.binary()), "terms": one(terms.take(by_term)),
            "held": one(pa.array(held)), "places": pa.array([_short(places[order])], pa.binary()), "tf": pa.array([_short(tf[order])], pa.binary()),
        }
        self._clear()
        yield pa.RecordBatch.from_arrays([columns[n].cast(t) for n, t in zip(self.schema.names, self.schema.types)], schema=self.schema)


def pack_texts(docs: DataFrame, doc: str, text: str, step: int = 512) -> DataFrame:
    """Segments of texts; texts of one id that follow each other in a task are one document."""
    kind, most = docs.schema[doc].dataType, (DOCS, POSTINGS)

    def run(batches):
        pack, last, held = Packer(kind, most), None, Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                for who, one in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if held and who != last:
                        yield from pack.add(last, list(held), list(held.values()), held.total())
                        held = Counter()
                    last = who
                    held.update(blank_words(one))
        yield from pack.add(last, list(held), list(held.values()), held.total())
        yield from pack.flush()

    return docs.select(doc, text).mapInArrow(run, _packed(kind))


def pack_rows(rows: DataFrame, doc: str) -> DataFrame:
    """Segments of rows (doc, piece, pieces, size, term, tf), which follow each other by document and piece in a task."""
    kind, most = rows.schema[doc].dataType, (DOCS, POSTINGS)

    def run(batches):
        pack, last, terms, tf = Packer(kind, most), None, [], []
        give = lambda: pack.add(last[0], terms, tf, last[3], last[2] == 1)
        for batch in batches:
            for *key, term, times in zip(*(c.to_pylist() for c in batch.columns)):
                if terms and key != last:
                    yield from give()
                    terms, tf = [], []
                last = key
                terms.append(term)
                tf.append(times)
        if terms:
            yield from give()
        yield from pack.flush()

    return rows.select(doc, "piece", "pieces", "size", "term", "tf").mapInArrow(run, _packed(kind))


def unpacked(segments: DataFrame, doc: str, kind: T.DataType, reach: Reach) -> DataFrame:
    """A row (term, block, doc, reach) for each posting."""
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("block", T.LongType()), T.StructField(doc, kind), T.StructField("reach", T.DoubleType())])

    def run(batches):
        for batch in batches:
            for number in range(batch.num_rows):
                one = Segment(batch, number, reach)
                term = pa.array(np.repeat(np.arange(len(one.held)), one.held))
                block = batch.column("segment")[number].as_py() * -(-DOCS // DOC_BLOCK) + one.places // DOC_BLOCK
                columns = [one.terms.take(term), pa.array(block), one.docs.take(pa.array(one.places)), pa.array(one.reach)]
                for part in pa.Table.from_arrays(columns, schema.names).to_batches(1 << 16):
                    yield part

    return segments.mapInArrow(run, schema)


class Segment:
    """A segment's documents, terms and, one term after the other, its postings."""

    def __init__(self, batch: pa.RecordBatch, number: int, reach: Reach):
        of = {name: batch.column(name)[number] for name in ("whole", "docs", "sizes", "terms", "held", "places", "tf")}
        self.whole, self.docs, self.terms = of["whole"].as_py(), of["docs"].values, of["terms"].values
        self.held = of["held"].values.to_numpy()
        postings = int(self.held.sum())
        self._places, self._tf = _long(of["places"], postings), _long(of["tf"], postings)
        self._sizes, self._reach = _long(of["sizes"], len(self.docs)).astype(np.float64), reach

    @property
    def places(self) -> np.ndarray:
        return self._places.astype(np.int64)

    @property
    def reach(self) -> np.ndarray:
        return self._reach(self._tf.astype(np.float64), self._sizes[self._places])

    def only(self, terms: np.ndarray) -> Runs:
        """The postings of some terms, given by their numbers in the segment."""
        start = np.concatenate([[0], np.cumsum(self.held, dtype=np.int64)])
        at = _ranges(start[terms], start[terms + 1])
        places = self._places[at].astype(np.int64)
        return Runs(places, self._reach(self._tf[at].astype(np.float64), self._sizes[places]), self.held[terms], len(self.docs))


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """start[0], ..., end[0] - 1, start[1], ..."""
    sizes = end - start
    return np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Runs:
    """Postings of some terms of a segment, cut where the term or the block changes, with the peak of each run."""

    def __init__(self, places: np.ndarray, reach: np.ndarray, held: np.ndarray, docs: int):
        self.places, self.reach, self.docs, self.blocks = places, reach, docs, -(-docs // DOC_BLOCK)
        term, block = np.repeat(np.arange(len(held)), held), places // DOC_BLOCK
        self.start = np.flatnonzero(np.diff(term * self.blocks + block, prepend=-1))
        self.end = np.append(self.start[1:], len(places))
        self.block, self.peak = block[self.start], np.maximum.reduceat(reach, self.start)
        self.first = np.searchsorted(term[self.start], np.arange(len(held) + 1))
        self.top = np.maximum.reduceat(self.peak, self.first[:-1])

    def of(self, terms: np.ndarray, w: np.ndarray, blocks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Runs of the terms, in marked blocks, and the weight of each."""
        start, end = self.first[terms], self.first[terms + 1]
        runs, weight = _ranges(start, end), np.repeat(w, end - start)
        if blocks is None:
            return runs, weight
        open_ = blocks[self.block[runs]]
        return runs[open_], weight[open_]

    def bounds(self, terms: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What the terms give a document of each block at most."""
        runs, weight = self.of(terms, w)
        return np.bincount(self.block[runs], weight * self.peak[runs], minlength=self.blocks)

    def scores(self, terms: np.ndarray, w: np.ndarray, blocks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """What the terms give each document of the marked blocks, and whether it holds one of them."""
        runs, weight = self.of(terms, w, blocks)
        at = _ranges(self.start[runs], self.end[runs])
        places, parts = self.places[at], np.repeat(weight, self.end[runs] - self.start[runs]) * self.reach[at]
        return np.bincount(places, parts, minlength=self.docs), np.bincount(places, minlength=self.docs) > 0

    def search(self, terms: np.ndarray, w: np.ndarray, k: int, mark: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best documents that reach ``mark``.

        Without a mark, the ``LEAD`` blocks that promise most give one that the ``k`` best reach at least.  Terms
        that cannot reach a part of it even together (the common ones) open no block; the others open a block if
        their peaks there, and what the common terms can add at most, reach it.  In open blocks documents are
        scored by the opening terms, and by the common ones only if that can still lift them.  Negative weights
        have no such bound and open every block.
        """
        if w.min() < 0:
            score, fits = self.scores(terms, w)
        else:
            if mark == -np.inf:
                lead = np.zeros(self.blocks, bool)
                lead[np.argsort(-self.bounds(terms, w), kind="stable")[:LEAD]] = True
                score, held = self.scores(terms, w, lead)
                if (have := np.sort(score[held])[::-1]).size >= k:
                    mark = have[k - 1] - MARGIN
            most = w * self.top[terms]
            order = np.argsort(most, kind="stable")
            upto = np.cumsum(most[order])
            common = int((upto < WEAK * mark).sum())
            rest, weak, strong = upto[common - 1] if common else 0.0, order[:common], order[common:]
            score, held = self.scores(terms[strong], w[strong], self.bounds(terms[strong], w[strong]) + rest >= mark)
            fits = held & (score + rest >= mark)
            blocks = np.zeros(self.blocks, bool)
            blocks[np.flatnonzero(fits) // DOC_BLOCK] = True
            score = score + self.scores(terms[weak], w[weak], blocks)[0]
        places = np.flatnonzero(fits)
        score = np.round(score[places], 9)
        best = np.lexsort((places, -score))[:k]
        best = best[score[best] >= mark]
        return places[best], score[best]


class Asked:
    """Queries of a block, with the numbers and weights of their terms."""

    def __init__(self, table: pa.Table, query: str):
        names = table.column(query).to_pylist() if table.num_rows else []
        self.queries = list(dict.fromkeys(names))
        words = pa.array(table.column("term").to_pylist() if names else [], pa.string()).dictionary_encode()
        place = {q: at for at, q in enumerate(self.queries)}
        of = np.array([place[q] for q in names], np.int64)
        order = np.argsort(of, kind="stable")
        self.terms, self.number = words.dictionary, words.indices.to_numpy()[order].astype(np.int64)
        self.weight = table.column("w").to_numpy()[order] if names else np.zeros(0)
        self.starts = np.searchsorted(of[order], np.arange(len(self.queries) + 1))


def search(segments: DataFrame, wanted: DataFrame, query: str, doc: str, kind: T.DataType, k: int, reach: Reach) -> DataFrame:
    """Columns query, doc, part: the ``k`` best documents of each segment, if a task has not yet met ``k`` better ones.

    ``wanted`` holds query, term and w.  Queries pass a segment block by block.  Parts of a document that lies in
    several segments have to be added up; others are whole scores at nine digits.
    """
    blocks = deal(wanted.select(query, "term", "w"), query, "term")
    schema = T.StructType([wanted.schema[query], T.StructField(doc, kind), T.StructField("part", T.DoubleType())])
    kinds = pa.schema([(f.name, _arrow(f.dataType)) for f in schema])

    def run(batches):
        met: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for number in range(batch.num_rows):
                one = Segment(batch, number, reach)
                for at in range(blocks.count):
                    yield from found(one, at, blocks.load(at, lambda t: Asked(t, query)), met)

    def found(one: Segment, at: int, asked: Asked, met: dict) -> Iterator[pa.RecordBatch]:
        if not asked.queries:
            return
        number = pc.index_in(one.terms, value_set=asked.terms)
        here = np.flatnonzero(pc.is_valid(number).to_numpy(zero_copy_only=False))
        if not len(here):
            return
        runs, local = one.only(here), np.full(len(asked.terms), -1)
        local[number.take(pa.array(here)).to_numpy()] = np.arange(len(here))
        who, places, parts = [], [], []
        for q, (start, end) in enumerate(zip(asked.starts[:-1], asked.starts[1:])):
            terms = local[asked.number[start:end]]
            w, terms = asked.weight[start:end][terms >= 0], terms[terms >= 0]
            if not len(terms):
                continue
            if one.whole:
                best = met.get((at, q), np.zeros(0))
                place, score = runs.search(terms, w, k, best[-1] - MARGIN if len(best) == k else -np.inf)
                met[at, q] = np.sort(np.concatenate([best, score]))[::-1][:k]
            else:
                place, score = np.zeros(1, np.int64), runs.scores(terms, w)[0]
            who.extend([asked.queries[q]] * len(place))
            places.append(place)
            parts.append(score)
        if who:
            columns = [pa.array(who, kinds.types[0]), one.docs.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(parts))]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, kinds.types)], schema=kinds)

    return segments.select("whole", "docs", "sizes", "terms", "held", "places", "tf").mapInArrow(run, schema)
