"""WARC archives: writing them as whole-file gzip streams, normalising them to a member per record, reading them back."""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import partitions, written
from daybook.session import new_folder

#: Uncompressed bytes after which a task begins a new archive.
ROLL = 32 << 20
_READ = 1 << 18
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def plan_records(pages: DataFrame, least: int = 1000, id_column: str = "page_id", payload_column: str = "html") -> DataFrame:
    """(page_id, url, payload binary, payload_bytes, digest, refers_to) for every page.

    Of equal payloads of ``least`` bytes or more the one with the largest id is the response; the others refer to it and
    carry no payload. A null payload is empty. Rows without an id are never referred to and refer like the others; if a
    payload has no id at all, its rows are all responses, and so are rows that repeat the largest id. Only digests
    and ids are grouped; the join's heavy digests are left to the skew handling of adaptive execution.
    """
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        url.alias("url"),
        F.coalesce(F.col(payload_column), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.col("payload_bytes") >= least).select("digest", "page_id")
    first = large.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisit = (F.col("payload_bytes") >= least) & F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    joined = rows.join(first, "digest", "left")
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "digest",
        F.when(revisit, F.col("response")).alias("refers_to"),
    )


def _record_name(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page-{page}')}>"


def _record(page, url, payload, size, digest, refers_to) -> bytes:
    """One WARC record. A revisit's HTTP head keeps the length of the payload that it leaves out."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_name(page)}"]
    clean = "".join((url or "urn:none").split())
    head += [f"WARC-Target-URI: {clean}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if refers_to is None:
        body += payload
    else:
        head += [f"WARC-Refers-To: {_record_name(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def write_monolithic(records: DataFrame, folder: str) -> DataFrame:
    """Write ``records`` (see ``plan_records``) as archives that are one gzip stream each; (path, records).

    A task writes to names of its own attempt and lists what it finished, so a repeated task leaves only unlisted files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    store, place = _store(path)
                    out, squeeze, size, count = store.open_output_stream(place, compression=None), zlib.compressobj(1, wbits=31), 0, 0
                data = _record(row["page_id"], row["url"], row["payload"] or b"", row["payload_bytes"], row["digest"], row["refers_to"])
                out.write(squeeze.compress(data))
                size, count = size + len(data), count + 1
                if size >= ROLL:
                    out.write(squeeze.flush())
                    out.close()
                    yield _listed(path, count)
                    out = None
        if out is not None:
            out.write(squeeze.flush())
            out.close()
            yield _listed(path, count)

    store, place = _store(folder)
    store.create_dir(place, recursive=True)
    return records.mapInArrow(run, "path string, records long")


def _listed(path: str, count: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([count], pa.int64())})


class _Inflated(io.RawIOBase):
    """A gzip file as a plain stream, inflated once; members that follow one another are one stream."""

    def __init__(self, source):
        self.source, self.engine, self.left = source, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        while not self.left:
            raw = self.engine.unconsumed_tail or self.engine.unused_data or self.source.read(_READ)
            if not raw:
                if not self.engine.eof:
                    raise ValueError("the gzip stream ends early")
                return 0
            if self.engine.eof:
                self.engine = zlib.decompressobj(31)
            self.left = self.engine.decompress(raw, _READ)
        n = min(len(target), len(self.left))
        target[:n], self.left = self.left[:n], self.left[n:]
        return n


def _records_in(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record of a plain WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        lines, headers = [line], {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
            lines.append(line)
        lines.append(line)
        size = int(headers["content-length"])
        body = stream.read(size)
        if len(body) != size:
            raise ValueError("the record ends early")
        yield headers, b"".join(lines) + body + b"\r\n\r\n"


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives (path) with every record as its own gzip member, and write an offset index beside each.

    Each archive is inflated once, as a stream; memory holds one record. The index has a line per record: record id,
    offset and length of its member. Returns (archive, index, record_id, offset, length), the rows of the index files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                (source_store, source), (store, place) = _store(path), _store(target)
                rows, at = [], 0
                with source_store.open_input_stream(source, compression=None) as raw, store.open_output_stream(place, compression=None) as out:
                    with store.open_output_stream(f"{place}.idx", compression=None) as index:
                        for headers, record in _records_in(io.BufferedReader(_Inflated(raw), _READ)):
                            squeeze = zlib.compressobj(3, wbits=31)
                            member = squeeze.compress(record) + squeeze.flush()
                            out.write(member)
                            name = headers["warc-record-id"]
                            index.write(f"{name} {at} {len(member)}\n".encode())
                            rows.append((target, f"{target}.idx", name, at, len(member)))
                            at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                    ["archive", "index", "record_id", "offset", "length"],
                )

    store, place = _store(folder)
    store.create_dir(place, recursive=True)
    # Archives are few and large: one row each is dealt out to a task of its own.
    spread = archives.select("path").repartition(partitions(archives.sparkSession), "path")
    return spread.mapInArrow(run, "archive string, index string, record_id string, offset long, length long")


def read_records(archives: DataFrame) -> DataFrame:
    """Read normalised archives (index) record by record through their sidecar indexes.

    (page_id, url, record_type, payload binary, payload_bytes, payload_digest, refers_to); revisits have no payload, their
    size and digest are the original's. A response whose payload doesn't match its digest is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # the rows of an archive are all in one task
        for batch in batches:
            found = [index for index in dict.fromkeys(batch.column(0).to_pylist()) if index not in seen]
            seen.update(found)
            for index in found:
                store, place = _store(index)
                with store.open_input_stream(place, compression=None) as lines, store.open_input_file(place.removesuffix(".idx")) as data:
                    held, size = [], 0
                    for line in io.BufferedReader(lines):
                        _, offset, length = line.split()
                        data.seek(int(offset))
                        held.append(_parsed(zlib.decompress(data.read(int(length)), 31)))
                        size += len(held[-1][3] or b"")
                        if size > 4 << 20 or len(held) >= 2000:
                            yield _read_batch(held)
                            held, size = [], 0
                    if held:
                        yield _read_batch(held)

    spread = archives.select("index").repartition(partitions(archives.sparkSession), "index")
    return spread.mapInArrow(
        run, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
    )


def _parsed(record: bytes) -> tuple:
    headers, _ = next(_records_in(io.BytesIO(record)))
    body = record[record.index(b"\r\n\r\n") + 4 :][: int(headers["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(http.lower().rpartition(b"content-length:")[2])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{headers['warc-record-id']}: the payload isn't the one that was written")
    page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
    url = headers["warc-target-uri"]
    return (page and int(page), None if url == "urn:none" else url, kind, payload if kind == "response" else None, size, digest, refers and int(refers))


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64())
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, html; url if there is one) as archives, normalise them, and read all records back."""
    spark = pages.sparkSession
    first, second = new_folder(spark, "warc"), new_folder(spark, "warc")
    archives = written(write_monolithic(plan_records(pages), first), "warc-list")
    return read_records(written(normalise(archives, second), "warc-index"))
