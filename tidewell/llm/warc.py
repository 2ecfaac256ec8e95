"""WARC archives through a chunked record table."""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import short_batches, whole_text
from tidewell.session import new_folder, settle

#: Bytes of a chunk, and payload bytes from which equal payloads are stored once.
CHUNK, SHARED = 1 << 18, 100
VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; a plain path is a local or mounted folder."""
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def chunks(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", size: int = CHUNK) -> DataFrame:
    """The chunk table: record_id, copy, page_id, url, payload_bytes, chunk_no, data, a row per ``size`` bytes.

    An empty payload has one empty chunk.  Rows of one record stand one after another in one task.  Equal rows
    have equal record_ids and differ in ``copy``.
    """
    payload = F.encode(whole_text(pages[payload_col]), "UTF-8")
    url = pages[url_col].cast("string") if url_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(
        F.concat_ws("-", F.coalesce(pages[id_col].cast("string"), F.lit("none")), F.hex(F.xxhash64(payload, url))).alias("record_id"),
        pages[id_col].cast("long").alias("page_id"),
        url.alias("url"),
        payload.alias("payload"),
        F.monotonically_increasing_id().alias("copy"),
    )
    numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.octet_length("payload") - 1, F.lit(0)) / size).cast("int"))
    return rows.select("*", F.explode(numbers).alias("chunk_no")).select(
        "record_id",
        "copy",
        "page_id",
        "url",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        "chunk_no",
        F.substring("payload", F.col("chunk_no") * size + 1, F.lit(size)).alias("data"),
    )


def _records(batches, columns: list[str]):
    """(chunk number, row) of a chunk table in the order of its rows."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def digests(chunk_rows: DataFrame) -> DataFrame:
    """record_id, page_id, payload_bytes, payload_digest: SHA-256 carried from chunk to chunk of each record."""

    def run(batches):
        state = None
        for batch in batches:
            done = []
            for record, page, size, number, data in zip(*(c.to_pylist() for c in batch.columns)):
                if number == 0:
                    state, left = hashlib.sha256(), size
                state.update(data)
                left -= len(data)
                if left == 0:
                    done.append((record, page, size, state.hexdigest()))
            columns = list(zip(*done)) or [()] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["record_id", "page_id", "payload_bytes", "payload_digest"])

    return chunk_rows.select("record_id", "page_id", "payload_bytes", "chunk_no", "data").mapInArrow(
        run, "record_id string, page_id long, payload_bytes long, payload_digest string"
    )


def with_types(digested: DataFrame, shared: int = SHARED) -> DataFrame:
    """Adds refers_to: the smallest page_id of an equal payload of at least ``shared`` bytes, where that is another page."""
    firsts = (
        digested.where(F.col("payload_bytes") >= shared)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("first"))
    )
    joined = digested.join(firsts, ["payload_digest", "payload_bytes"], "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(other, F.col("first"))).drop("first")


def header(record_id: str, page, url, size: int, digest: str, refers, refers_url=None) -> bytes:
    """Header block of a response or revisit record; revisits carry no payload."""
    clean = lambda s: "".join(c for c in str(s) if c >= " ")
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, record_id)}>",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + clean(url or ""),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-ID: {'' if page is None else page}",
        f"X-Payload-Length: {size}",
    ]
    if refers is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {size if refers is None else 0}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")


def write_archives(chunk_rows: DataFrame, typed: DataFrame, folder: str) -> DataFrame:
    """Write the records to archives in ``folder``; columns path, records, bytes of the archives, written once.

    Every record is one gzip member, fed chunk by chunk.  A task writes its own file under a fresh name and
    names it in its result, so files of lost or repeated tasks are never read.
    """
    kinds = typed.select("record_id", "payload_digest", "refers_to").dropDuplicates(["record_id"])
    # the chunks of a record come from one task and have one partner, so the join keeps them in one task
    rows = chunk_rows.join(kinds, "record_id").where("refers_to is null or chunk_no = 0")
    rows = rows.withColumn("data", F.when(F.col("refers_to").isNull(), F.col("data"))).sortWithinPartitions("record_id", "copy", "chunk_no")

    def run(batches):
        path = out = None
        records = 0
        for record, page, url, size, number, data, digest, refers in _records(
            batches, ["record_id", "page_id", "url", "payload_bytes", "chunk_no", "data", "payload_digest", "refers_to"]
        ):
            if out is None:
                store, base = open_store(folder)
                store.create_dir(base, recursive=True)
                name = f"pages-{uuid.uuid4().hex}.warc.gz"
                path, out = f"{folder}/{name}", store.open_output_stream(f"{base}/{name}", compression=None)
            if number == 0:
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(packer.compress(header(record, page, url, size, digest, refers)))
                left = size if refers is None else 0
                records += 1
            if data:
                out.write(packer.compress(data))
                left -= len(data)
            if left == 0:
                out.write(packer.compress(b"\r\n\r\n") + packer.flush())
        if out is not None:
            written = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64()), pa.array([written], pa.int64())], ["path", "records", "bytes"])

    return settle(rows.mapInArrow(run, "path string, records long, bytes long"))


class _Unpacked(io.RawIOBase):
    """The bytes of all gzip members of a stream, unpacked as they are read."""

    def __init__(self, source):
        self.source, self.packer, self.rest = source, None, b""

    def readable(self):
        return True

    def readinto(self, target):
        while True:
            raw = self.rest or self.source.read(1 << 16)
            if not raw:
                if self.packer is not None and not self.packer.eof:
                    raise ValueError("archive ends within a record")
                return 0
            if self.packer is None or self.packer.eof:
                self.packer = zlib.decompressobj(31)
            out = self.packer.decompress(raw, len(target))
            self.rest = self.packer.unused_data if self.packer.eof else self.packer.unconsumed_tail
            if out:
                target[: len(out)] = out
                return len(out)


def read_archives(archives: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunk table of all records in the archives, with the digest of all bytes up to each chunk's end.

    Columns path, record_no, page_id, url, record_type, refers_to, declared_bytes, declared_digest, chunk_no,
    data, digest, last.  A task streams whole archives and holds one chunk of one record.
    """
    names = ("path", "record_no", "page_id", "url", "record_type", "refers_to", "declared_bytes", "declared_digest", "chunk_no", "data", "digest", "last")
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.string(), pa.bool_())

    def rows_of(path):
        store, place = open_store(path)
        with store.open_input_stream(place, compression=None) as raw:
            source = io.BufferedReader(_Unpacked(raw), 1 << 16)
            number = 0
            while line := source.readline():
                if line.strip() != VERSION.encode():
                    raise ValueError(f"{path}: no record begins where record {number} should")
                fields = {}
                while (line := source.readline().rstrip(b"\r\n")):
                    key, _, value = line.partition(b":")
                    fields[key.decode()] = value.strip().decode("utf-8", "surrogatepass")
                whole = lambda key: int(fields[key]) if fields.get(key) else None
                left, state, at = whole("Content-Length"), hashlib.sha256(), 0
                while True:
                    data = source.read(min(size, left))
                    if len(data) < min(size, left):
                        raise ValueError(f"{path}: record {number} is cut off")
                    left -= len(data)
                    state.update(data)
                    yield (
                        path, number, whole("X-Page-ID"), fields.get("WARC-Target-URI"), fields["WARC-Type"], whole("X-Refers-To-Page-ID"),
                        whole("X-Payload-Length"), fields["WARC-Payload-Digest"].partition(":")[2], at, data, state.copy().hexdigest(), left == 0,
                    )
                    at += 1
                    if left == 0:
                        break
                if source.read(4) != b"\r\n\r\n":
                    raise ValueError(f"{path}: record {number} does not end where its length says")
                number += 1

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, held_bytes = [], 0
                for row in rows_of(path):
                    held.append(row)
                    held_bytes += len(row[9])
                    if held_bytes >= 16 * size or len(held) >= 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], list(names))
                        held, held_bytes = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], list(names))

    schema = (
        "path string, record_no long, page_id long, url string, record_type string, refers_to long, declared_bytes long, "
        "declared_digest string, chunk_no int, data binary, digest string, last boolean"
    )
    files = archives.select("path").distinct()
    return files.repartitionByRange(max(1, files.count()), "path").mapInArrow(run, schema)


def round_trip(pages: DataFrame, shared: int = SHARED, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write all pages as archives, read these back: page_id, payload_bytes, payload_digest, record_type, refers_to, path, record_no.

    Payloads of at least ``shared`` bytes that are equal are stored once, by the record of the smallest
    page_id; the others revisit it.  Null payloads are empty.  Repeated rows each have a record; those that
    share the smallest page_id are all responses.  A null page_id is larger than any other: such a record
    revisits an equal payload that has an id, else it is a response.  An empty table writes no archive and
    gives no rows.  A response whose bytes differ from its header's digest or length stops the reading.
    """
    spark = pages.sparkSession
    short_batches(spark)
    folder = folder or new_folder(spark, "warc")
    rows = chunks(pages, id_col, url_col, payload_col)
    typed = settle(with_types(digests(rows), shared))
    read = read_archives(write_archives(rows, typed, folder)).where("last")
    wrong = (F.col("record_type") == "response") & ((F.col("digest") != F.col("declared_digest")))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("payload differs from its digest: "), "path"))).otherwise(F.col("declared_digest"))
    return read.select("page_id", F.col("declared_bytes").alias("payload_bytes"), checked.alias("payload_digest"), "record_type", "refers_to", "path", "record_no")
