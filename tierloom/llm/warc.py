"""WARC archives: a writer that makes every record a gzip member, and a reader that splits archives by bytes.

A reading task has a range of bytes of a file. It scans it for the gzip magic, takes a place for a member only if what
stands there inflates to the head of a WARC record, and owns the records that begin in its range, wherever they end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm.common import shuffle_partitions, stored
from tierloom.session import new_table_path

#: Fixed values of the format: gzip's first bytes with deflate as the method, versions, the revisit profile.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Bytes of a file that a task reads, of one step of its scan, and of the longest head of a record.
SPLIT, STEP, HEAD = 16 << 20, 1 << 20, 1 << 16
#: Bytes of an archive after which the next one begins.
ARCHIVE = 64 << 20
LEVEL = 5
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{payload_digest}')}>"


def _field(name: str, value: object) -> str:
    """A header line; line ends in a value are blanks. No line for None."""
    return "" if value is None else f"{name}: {re.sub('[\r\n]+', ' ', str(value))}\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None, revisit: bool) -> bytes:
    """One gzip member. A revisit has the HTTP head of the payload, with its length, but not the payload."""
    payload_digest = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = (
        _field("WARC-Type", "revisit" if revisit else "response") + _field("WARC-Record-ID", _record_id(page_id, payload_digest)) + _field("WARC-Date", DATE)
        + _field("WARC-Target-URI", url) + _field("WARC-Payload-Digest", "sha1:" + payload_digest) + _field("X-Page-Id", page_id)
    )
    if revisit:
        head += _field("WARC-Profile", PROFILE) + _field("WARC-Refers-To", _record_id(original, payload_digest)) + _field("X-Refers-To-Page-Id", original)
    head += _field("Content-Type", "application/http; msgtype=response") + _field("Content-Length", len(block))
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflate.compress(VERSION + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n") + deflate.flush()


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if ":" in uri else "file://" + uri)


def _written(folder: str):
    """Archives of a task. A file has its final name only when it is whole, and the name has the attempt: what a lost attempt
    has left beside those of the one that counts is in no result of a write, and so is not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, base = _files(folder)
        part, attempt, number, out, size, records = context.partitionId(), context.taskAttemptId(), 0, None, 0, 0
        done: list[tuple[str, int]] = []

        def close() -> None:
            nonlocal out, size, number, records
            if out is None:
                return
            out.close()
            name = f"{base}/part-{part:06d}-{attempt}-{number:04d}.warc.gz"
            files.move(f"{base}/_{attempt}-{number}.tmp", name)
            done.append((name.rsplit("/", 1)[-1], records))
            out, size, number, records = None, 0, number + 1, 0

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, original, revisit = (c[i].as_py() for c in batch.columns)
                if out is None:
                    out = files.open_output_stream(f"{base}/_{attempt}-{number}.tmp", compression=None)
                data = record(page_id, url, payload or b"", original, revisit)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= ARCHIVE:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["file", "records"])

    return run


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write a record for every row of ``pages`` to archives in ``folder``; ``file, records`` of each archive.

    Of records with equal payloads of at least ``least_bytes`` bytes, those with the smallest id are responses and the others revisits
    that refer to it; shorter payloads are all responses. The payload is the text in UTF-8, NULL being empty. A row
    without an id is a response if its group has no id at all, and a revisit otherwise. Rows that repeat the smallest id are all
    responses. Other columns are ignored. An empty table gives no archive.

    Payloads are shuffled once, to meet the smallest id of their digest; Spark may split a digest that very many pages share.
    """
    payload = F.coalesce(F.col(html_column).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    first = rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha1").agg(F.min("id").alias("original"))
    # a group of its own name: both sides of the join are dealt out for the join, so that Spark may split hot digests
    first = first.select(F.upper("sha1").alias("digest"), "original")
    joined = rows.select("id", "url", "payload", F.upper("sha1").alias("digest")).join(first, "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    ready = joined.select("id", "url", "payload", "original", revisit.alias("revisit"))
    _make_folder(folder)
    return ready.mapInArrow(_written(folder), "file string, records long")


def _make_folder(folder: str) -> None:
    files, base = _files(folder)
    files.create_dir(base, recursive=True)


def _head(data: bytes) -> bytes | None:
    """The head of the record whose member begins with ``data``; None if there is none."""
    inflate = zlib.decompressobj(31)
    try:
        out = inflate.decompress(data, HEAD)
    except zlib.error:
        return None
    return out if out.startswith(b"WARC/1.") else None


def _fields(head: bytes) -> dict[str, str]:
    """Fields by their lower-case name; case does not matter in them."""
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _number(value: str | None) -> int | None:
    return int(value) if value and value.strip().lstrip("-").isdigit() else None


def parsed(member: bytes) -> tuple:
    """id, url, type, payload, length and digest of the full payload, the id a revisit refers to.

    A response's payload is what follows its HTTP head; a digest that it names is checked, one that it lacks is computed. A revisit
    has the length and digest it names. Of any other record, such as ``warcinfo`` or ``request``, the payload is the block.
    """
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    kind = fields["warc-type"].lower()
    http, _, payload = block.partition(b"\r\n\r\n") if kind in ("response", "revisit") and block.startswith(b"HTTP/") else (b"", b"", block)
    named = fields.get("warc-payload-digest")
    if kind == "revisit":
        length, payload, payload_digest = _number(_fields(http).get("content-length")), None, named.removeprefix("sha1:") if named else None
    else:
        length, payload_digest = len(payload), digest(payload)
        if kind == "response" and named and named.startswith("sha1:") and named != "sha1:" + payload_digest:
            raise ValueError(f"payload and digest of {fields.get('warc-record-id')} differ")
    return _number(fields.get("x-page-id")), fields.get("warc-target-uri"), kind, payload, length, payload_digest, _number(fields.get("x-refers-to-page-id"))


def records_in(source: pa.NativeFile, begin: int, end: int, length: int) -> Iterator[bytes]:
    """The inflated records whose members begin in bytes [begin, end) of a file of ``length`` bytes."""
    at = begin
    while at < end:
        # one search window, with enough after it for a magic that is cut by its end
        source.seek(at)
        window = source.read(min(STEP, end - at) + len(MAGIC) - 1)
        found = window.find(MAGIC)
        if found < 0:
            at += min(STEP, end - at)
            continue
        at += found
        if at >= end:
            return
        source.seek(at)
        data = source.read(min(HEAD, length - at))
        if _head(data) is None:
            at += 1
            continue
        inflate = zlib.decompressobj(31)
        out = [inflate.decompress(data)]
        used = len(data)
        while not inflate.eof:
            more = source.read(STEP)
            if not more:
                break
            used += len(more)
            out.append(inflate.decompress(more))
        if not inflate.eof:
            raise ValueError("an archive ends inside a record")
        at += used - len(inflate.unused_data)
        yield b"".join(out)


RECORDS = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in RECORDS.split(", ")]
    for batch in batches:
        for path, length, begin in zip(*(c.to_pylist() for c in batch.columns)):
            files, place = _files(path)
            rows: list[tuple] = []
            held = 0
            with files.open_input_file(place) as source:
                for member in records_in(source, begin, min(begin + SPLIT, length), length):
                    rows.append(parsed(member))
                    held += len(member)
                    if held > STEP:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_archives(spark: SparkSession, folder: str, files: DataFrame | None = None) -> DataFrame:
    """A row for every record in the archives of ``folder``, or in those that ``files`` names: the result of :func:`write_archives`.

    Responses are checked against their digest. ``payload`` is NULL for revisits; length and digest are those of the full payload for
    both. Records of other types are rows too, see :func:`parsed`. A folder without archives gives no rows.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    if files is not None:
        listed = listed.join(files.select(F.col("file").alias("_file")), F.substring_index("path", "/", -1) == F.col("_file"), "left_semi")
    ranges = listed.select("path", "length", F.explode(F.expr(f"sequence(0L, greatest(length - 1, 0L), {SPLIT}L)")).alias("begin"))
    return ranges.repartition(shuffle_partitions(spark), "path", "begin").mapInArrow(_read, RECORDS)


def archived(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """Write ``pages`` to archives in ``folder`` (a new one in the shared folder) and read them back.

    What is read are the files that the stored result of the write names, those of the attempts that counted. Fails if they do
    not hold a record for each row."""
    spark = pages.sparkSession
    folder = folder or new_table_path(spark, "warc")
    folder = folder if ":" in folder else "file://" + folder
    written = stored(write_archives(pages, folder, **columns), "archives")
    records, rows = written.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], pages.count()
    if records != rows:
        raise RuntimeError(f"{records} records were written of {rows} rows")
    return read_archives(spark, folder, written)
