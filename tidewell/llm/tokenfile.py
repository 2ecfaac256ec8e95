"""Token-id files: texts encoded, packed in document order by the context-mixing coder, and read back."""

from __future__ import annotations

import itertools
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import idcoder
from tidewell.llm.common import ids_and_texts, short_batches
from tidewell.llm.warc import open_store
from tidewell.session import new_folder, settle

#: Ids of a segment; its blocks are coded side by side.
SEGMENT = 1 << 22
#: Blocks that a task decodes side by side, from one segment at least.
SIDE_BY_SIDE = 1 << 12
#: Pieces of texts whose ids a worker learns before it forgets those it has not met for as many.
REMEMBERED = 1 << 19
END = 0
MAGIC = b"IDCM1\n"
_HEAD = "<4sQQQII"  # mark, documents, ids, bytes of the document table, its CRC-32, blocks
_BLOCK = "<III"  # ids, bytes of the code, CRC-32 of its ids (32-bit little-endian) and code
_NULL = -(1 << 63)


class PieceEncoder:
    """Ids of texts by a byte-level BPE tokenizer of the tokenizers library, remembering what pieces gave.

    Such a tokenizer never joins across a space between two characters that are not white space, so a text is
    cut there, and each new piece is encoded once.  Pieces are encoded in one run; the ids that begin with the
    mark of a space say where each starts.  Special strings hold no space, so cutting leaves them whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), 2000):
            part = pieces[at : at + 2000]
            ids = self._plain([" " + " ".join(part)])[0]
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(part):
                data, at = ids.tobytes(), (4 * np.append(starts, len(ids))).tolist()
                found = [data[a:b] for a, b in itertools.pairwise(at)]
            else:
                found = [f.tobytes() for f in self._plain([" " + p for p in part])]
            self.known.update(zip(part, found))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit little-endian integers."""
        cut, firsts = [], []
        for text in texts:
            pieces = text.split(" ")
            if "" in pieces or list(map(str.strip, pieces)) != pieces:
                pieces = _joined(pieces)
            firsts.append(pieces[0])
            cut.append(pieces[1:])
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        new = set().union(*cut).difference(self.known)
        met = new.intersection(self.older)
        self.known.update((p, self.older[p]) for p in met)
        self._learn(list(new - met))
        known = self.known.__getitem__
        return [a.tobytes() + b"".join(map(known, pieces)) for a, pieces in zip(self._plain(firsts), cut)]


def _joined(pieces: list[str]) -> list[str]:
    """Pieces put together again where a space has white space, or an end of the text, beside it."""
    out = [pieces[0]]
    for piece in pieces[1:]:
        if out[-1] and piece and not out[-1][-1].isspace() and not piece[0].isspace():
            out.append(piece)
        else:
            out[-1] += " " + piece
    return out


def encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process and tokenizer file.

    It is held by an entry of sys.modules: this module's own names are new in every task.
    """
    held = sys.modules.setdefault("_tidewell_encoders", types.ModuleType("_tidewell_encoders")).__dict__
    if path not in held:
        held[path] = PieceEncoder(path)
    return held[path]


def pack(doc_ids: list[int | None], docs: list[bytes]) -> Iterator[bytes]:
    """One segment: documents as (id, number of ids), then the blocks, each of which can be decoded on its own."""
    ids = np.frombuffer(b"".join(docs), "<u4")
    table = np.array([[_NULL if d is None else d for d in doc_ids], [len(x) // 4 for x in docs]], "<i8")
    packed = zlib.compress(np.diff(table, axis=1, prepend=0).tobytes(), 6)
    codes = idcoder.encode(ids)
    yield struct.pack(_HEAD, b"SEGM", len(docs), len(ids), len(packed), zlib.crc32(packed), len(codes)) + packed
    for k, code in enumerate(codes):
        part = ids[k * idcoder.BLOCK : (k + 1) * idcoder.BLOCK]
        yield struct.pack(_BLOCK, len(part), len(code), zlib.crc32(code, zlib.crc32(part.tobytes()))) + code


def segments(read, path: str) -> Iterator[tuple[np.ndarray, list[int], list[int], list[bytes]]]:
    """Document ids and numbers of ids, ids, checksum and code of each block, of every segment of a file."""

    def take(n: int) -> bytes:
        data = read(n)
        if len(data) != n:
            raise ValueError(f"{path}: the file is cut off")
        return data

    if take(len(MAGIC)) != MAGIC:
        raise ValueError(f"{path}: not an id file")
    while head := read(struct.calcsize(_HEAD)):
        mark, n_docs, n_ids, size, crc, blocks = struct.unpack(_HEAD, head)
        packed = take(size)
        if mark != b"SEGM" or zlib.crc32(packed) != crc:
            raise ValueError(f"{path}: wrong checksum of a document table")
        table = np.cumsum(np.frombuffer(zlib.decompress(packed), "<i8").reshape(2, n_docs), axis=1)
        codes, sizes, checks = [], [], []
        for _ in range(blocks):
            n, size, check = struct.unpack(_BLOCK, take(struct.calcsize(_BLOCK)))
            codes.append(take(size))
            sizes.append(n)
            checks.append(check)
        if sum(sizes) != n_ids:
            raise ValueError(f"{path}: blocks of wrong sizes")
        yield table, sizes, checks, codes


def decoded(parts: list[tuple]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Path, document ids, numbers of ids and all ids of segments, given with their paths and decoded side by side."""
    steps = max((size for _, _, sizes, *_ in parts for size in sizes), default=0)
    grid = idcoder.decode_blocks([code for *_, codes in parts for code in codes], min(steps, idcoder.BLOCK))
    lane = 0
    for path, table, sizes, checks, codes in parts:
        ids = grid[:, lane : lane + len(codes)].T.ravel()[: sum(sizes)].astype("<u4")
        lane, at = lane + len(codes), 0
        for n, code, check in zip(sizes, codes, checks):
            if zlib.crc32(code, zlib.crc32(ids[at : at + n].tobytes())) != check:
                raise ValueError(f"{path}: wrong checksum of a block")
            at += n
        yield path, table[0], table[1], ids


def unpack(read, path: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document ids, numbers of ids and all ids of each segment; a wrong checksum or a cut file raises."""
    for segment in segments(read, path):
        yield from (found[1:] for found in decoded([(path, *segment)]))


def unpack_all(files: Iterable[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Path and what ``unpack`` gives of the segments of many files, whose blocks are decoded side by side."""
    held, blocks = [], 0
    for path in files:
        store, place = open_store(path)
        with store.open_input_stream(place, compression=None) as source:
            for segment in segments(source.read, path):
                if held and blocks + len(segment[-1]) > SIDE_BY_SIDE:
                    yield from decoded(held)
                    held, blocks = [], 0
                held.append((path, *segment))
                blocks += len(segment[-1])
    if held:
        yield from decoded(held)


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and write id files in ascending doc_id order; columns part, path, docs, ids.

    Files follow each other by ``part``.  A task writes a file of its own under a fresh name and names it in
    its result, so files of lost or repeated tasks are never read.  It holds one segment of ids.
    """
    short_batches(docs.sparkSession)
    order = [F.asc_nulls_last("doc_id"), F.asc("text")]
    rows = ids_and_texts(docs, id_col, text_col).repartitionByRange(order[0]).sortWithinPartitions(*order)

    def run(batches):
        coder, path, out = encoder(tokenizer), None, None
        names, parts, held, n_docs, n_ids = [], [], 0, 0, 0
        last = struct.pack("<I", end)
        for batch in batches:
            if out is None:
                store, base = open_store(folder)
                store.create_dir(base, recursive=True)
                name = f"ids-{uuid.uuid4().hex}.idcm"
                path, out = f"{folder}/{name}", store.open_output_stream(f"{base}/{name}", compression=None)
                out.write(MAGIC)
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                names.append(doc_id)
                parts.append(ids + last)
                held += len(ids) // 4 + 1
                if held >= SEGMENT:
                    n_docs, n_ids = n_docs + len(names), n_ids + held
                    for data in pack(names, parts):
                        out.write(data)
                    names, parts, held = [], [], 0
        if names:
            n_docs, n_ids = n_docs + len(names), n_ids + held
            for data in pack(names, parts):
                out.write(data)
        if out is not None:
            out.close()
            found = [[TaskContext.get().partitionId()], [path], [n_docs], [n_ids]]
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found, kinds)], ["part", "path", "docs", "ids"])

    return settle(rows.mapInArrow(run, "part int, path string, docs long, ids long"))


def read_ids(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, decoded from them.

    ``start`` counts the ids of all documents before it.  The window that adds up the files' sizes has a row
    for each file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = settle(files.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0))))

    def run(batches):
        begin = {}
        for batch in batches:
            begin.update(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for path, doc_ids, sizes, ids in unpack_all(begin):
            before, ends = begin[path], np.cumsum(sizes)
            data = memoryview(ids.tobytes())
            sums = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
            keys = pa.array(doc_ids, pa.int64(), mask=doc_ids == _NULL)
            columns = [keys, pa.array(before + ends - sizes), pa.array(sizes), pa.array(sums, pa.int64())]
            begin[path] += int(ends[-1])
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    count, ids = placed.agg(F.count("*"), F.coalesce(F.sum("ids"), F.lit(0))).first()
    tasks = -(-ids // (SIDE_BY_SIDE * idcoder.BLOCK))  # of as many blocks as a task decodes side by side, if the cores have work then
    tasks = max(1, min(count, max(tasks, files.sparkSession.sparkContext.defaultParallelism)))
    spread = placed.select("path", "before").repartitionByRange(tasks, "before")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents as id files and read these back: doc_id, start, n_tokens (with the end id), ids_crc32.

    Null and empty texts are the end id alone.  Rows that repeat a doc_id stand in the order of their texts,
    rows without doc_id after all others.  An empty table writes no file and gives no rows.
    """
    folder = folder or new_folder(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, tokenizer, folder, end, id_col, text_col))
