"""WARC in ZIP packages: writer, directory parser and range reader.

An archive is a ZIP file whose members are stored, not deflated:
``archive/data.warc.gz`` (one gzip member per WARC record, so that each can be
read on its own) and ``indexes/index.cdxj`` (a line per record with its place).
Tasks write whole archives into the shared folder under names of their own and
return them in a manifest; only archives in the manifest are ever read, so a
retried task leaves no double records.

The reader parses the end-of-central-directory record, the ZIP64 locator and
record where present, the central directory and the members' local headers
with a few range reads, splits the index into runs of neighbouring records,
deals the runs out anew and range-reads each run.  Nothing is extracted.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialize, raw_texts, salted_left_join, slices
from tessera.session import scratch_dir

#: Payloads of fewer bytes are always responses.
REVISIT_BYTES = 100
#: Bytes of records after which a task begins its next archive, and of one range read, about.
ARCHIVE_BYTES, RUN_BYTES = 64 << 20, 2 << 20
#: Runs that one reading task takes, about.
RUNS_PER_TASK = 4
DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"

#: Signatures and layouts of the ZIP format.
_END, _LOCATOR64, _END64, _CENTRAL, _LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
_NONE16, _NONE32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    """A stored member: where its bytes lie in the archive."""

    name: str
    offset: int
    size: int


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """(store, path) of a URI; ``file:/path``, as Hadoop writes it, is a local path."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def open_input(uri: str) -> pa.NativeFile:
    """Random access to a file of any store that pyarrow knows."""
    store, path = located(uri)
    return store.open_input_file(path)


def range_read(f, offset: int, size: int) -> bytes:
    f.seek(offset)
    raw = f.read(size)
    if len(raw) != size:
        raise ValueError(f"archive ends before byte {offset + size}")
    return raw


def _zip64(extra: bytes, size: int, packed: int, offset: int) -> tuple[int, int, int]:
    """Sizes and offset of a central entry, the 32-bit fields replaced from its ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            body, place = extra[at + 4:at + 4 + n], 0
            values = []
            for v in (size, packed, offset):
                if v == _NONE32:
                    v = struct.unpack_from("<Q", body, place)[0]
                    place += 8
                values.append(v)
            return values[0], values[1], values[2]
        at += 4 + n
    return size, packed, offset


def members(f, length: int) -> dict[str, Member]:
    """Stored members of an archive, from its central directory (ZIP64 or not) and local headers."""
    tail_at = max(0, length - (1 << 16) - 22)
    tail = range_read(f, tail_at, length - tail_at)
    end = tail.rfind(_END)
    while end >= 0:  # the comment may hold the signature: the right one ends with the file
        if end + 22 <= len(tail) and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
        end = tail.rfind(_END, 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, size, offset = struct.unpack_from("<HII", tail, end + 10)
    if count == _NONE16 or size == _NONE32 or offset == _NONE32 or tail[max(0, end - 20):end][:4] == _LOCATOR64:
        locator = range_read(f, tail_at + end - 20, 20)
        if locator[:4] != _LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record = range_read(f, struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory")
        count, size, offset = struct.unpack_from("<QQQ", record, 32)
    directory = range_read(f, offset, size)
    found: dict[str, Member] = {}
    at = 0
    for _ in range(count):
        if directory[at:at + 4] != _CENTRAL:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        local = struct.unpack_from("<I", directory, at + 42)[0]
        raw_name = directory[at + 46:at + 46 + n_name]
        name = raw_name.decode("utf-8" if flags & 0x800 else "cp437")
        plain, packed, local = _zip64(directory[at + 46 + n_name:at + 46 + n_name + n_extra], plain, packed, local)
        at += 46 + n_name + n_extra + n_comment
        if name.endswith("/"):
            continue
        if method != 0 or flags & 1:
            raise ValueError(f"member {name} is not stored plainly")
        head = range_read(f, local, 30)
        if head[:4] != _LOCAL:
            raise ValueError(f"no local header of {name}")
        found[name] = Member(name, local + 30 + sum(struct.unpack_from("<HH", head, 26)), packed)
    return found


def warc_record(kind: str, record_id: str, target: str, payload: bytes, digest: str,
                refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit holds no payload."""
    block = b"" if kind == "revisit" else payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: text/html; charset=utf-8"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    return gzip.compress(head + block + b"\r\n\r\n", compresslevel=3, mtime=0)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-case names, payload) of an unzipped record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return headers, rest[:int(headers["content-length"])]


class ArchiveWriter:
    """Streams records into one ZIP package; the index follows the data."""

    def __init__(self, uri: str):
        self.uri = uri
        store, path = located(uri)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.sink = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA_MEMBER), "w", force_zip64=True)
        self.index: list[str] = []
        self.at = 0

    def add(self, record_id: str, target: str, record: bytes) -> None:
        self.data.write(record)
        self.index.append(json.dumps({"id": record_id, "url": target, "offset": self.at, "length": len(record)}))
        self.at += len(record)

    def close(self) -> tuple[str, int]:
        """(uri, records)"""
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX_MEMBER), "\n".join(self.index) + "\n" * bool(self.index))
        self.zip.close()
        self.sink.close()
        return self.uri, len(self.index)


def one_line(url: str) -> str:
    """A URL that fits in a header line: control characters and outer blanks are percent-encoded."""
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def response_ids(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(digest, first): the smallest page_id of every payload met more than once."""
    marks = pages.select("page_id", F.octet_length("html").alias("n"), F.sha2("html", 256).alias("digest"))
    return marks.where(F.col("n") >= least_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, html) as archives under ``folder``; returns the manifest (uri, records).

    Of pages with equal payloads of at least ``least_bytes`` the one with the
    smallest id is written as response, the others as revisits of it.  A null
    html is an empty payload, a null url becomes ``urn:page:ID``.  Repeated rows
    of the smallest id are responses all; pages without an id are revisits
    where their payload has a page with one, else responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html"))
    firsts = materialize(response_ids(rows, least_bytes), "warc-firsts")
    dealt = salted_left_join(rows.withColumn("digest", F.sha2("html", 256)), firsts, ["digest"],
                             F.xxhash64("page_id", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        writer: ArchiveWriter | None = None
        written: list[tuple[str, int]] = []
        for b in slices(batches, "html"):
            payloads = raw_texts(b, "html")
            for page, url, first, digest, payload in zip(*(b.column(i).to_pylist() for i in range(4)), payloads):
                if writer is None:
                    writer = ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                target = one_line(url) if url else f"urn:page:{page}"
                revisit = first is not None and page != first
                record = warc_record("revisit" if revisit else "response", f"urn:page:{page}", target, payload,
                                     digest, f"urn:page:{first}" if revisit else None)
                writer.add(f"urn:page:{page}", target, record)
                if writer.at >= archive_bytes:
                    written.append(writer.close())
                    writer = None
        if writer is not None:
            written.append(writer.close())
        if written:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*written)], names=["uri", "records"])

    return materialize(dealt.select("page_id", "url", "first", "digest", "html").mapInArrow(
        run, "uri string, records long"), "warc-manifest")


def index_runs(manifest: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(uri, offset, size): neighbouring records of each archive in runs of about ``run_bytes``, from its index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column("uri").to_pylist():
                with open_input(uri) as f:
                    found = members(f, f.size())
                    data, index = found[DATA_MEMBER], found[INDEX_MEMBER]
                    runs: list[list[int]] = []
                    held, at = b"", 0
                    while at < index.size:
                        part = range_read(f, index.offset + at, min(run_bytes, index.size - at))
                        at += len(part)
                        *lines, held = (held + part).split(b"\n")
                        for line in lines:
                            entry = json.loads(line)
                            if runs and runs[-1][1] < run_bytes:
                                runs[-1][1] += entry["length"]
                                runs[-1][2] += 1
                            else:
                                runs.append([data.offset + entry["offset"], entry["length"], 1])
                    if runs:
                        offset, size, n = zip(*runs)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([uri] * len(runs)), pa.array(offset, pa.int64()), pa.array(size, pa.int64()),
                             pa.array(n, pa.int64())], names=["uri", "offset", "size", "records"])

    return manifest.select("uri").mapInArrow(run, "uri string, offset long, size long, records long")


def read_archives(manifest: DataFrame) -> DataFrame:
    """(record_id, record_type, target_uri, refers_to, payload_digest, payload) of every record.

    ``payload`` is null for a revisit.  ``payload_digest`` is computed from
    the bytes that were read and must equal the header's; a revisit has only
    the header's.  A run whose records do not match the index raises.
    """
    names = ["record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, offset, size, n in zip(*(c.to_pylist() for c in b.columns)):
                with open_input(uri) as f:
                    raw = range_read(f, offset, size)
                rows = []
                view, at = memoryview(raw), 0
                while at < len(raw):
                    stream = zlib.decompressobj(wbits=31)
                    text = bytearray()
                    while not stream.eof:
                        part = view[at:at + 65536]
                        if not len(part):
                            raise ValueError(f"record cut off in {uri}")
                        text += stream.decompress(part)
                        at += len(part) - len(stream.unused_data)
                    headers, payload = parse_record(bytes(text))
                    told = headers["warc-payload-digest"].removeprefix("sha256:")
                    kind = headers["warc-type"]
                    if kind == "response":
                        digest = hashlib.sha256(payload).hexdigest()
                        if digest != told:
                            raise ValueError(f"digest of {headers['warc-record-id']} does not match its payload")
                    rows.append((headers["warc-record-id"].strip("<>"), kind, headers["warc-target-uri"],
                                 headers.get("warc-refers-to", "").strip("<>") or None, told,
                                 None if kind == "revisit" else payload))
                if len(rows) != n:
                    raise ValueError(f"{len(rows)} records where the index has {n}")
                kinds = (*[pa.string()] * 5, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    runs = materialize(index_runs(manifest), "warc-runs")
    # runs are alike in size: deal them out evenly, whatever archive they lie in
    parts = max(1, -(-runs.count() // RUNS_PER_TASK))
    return runs.repartition(parts, "uri", "offset").mapInArrow(
        run, "record_id string, record_type string, target_uri string, refers_to string, "
             "payload_digest string, payload binary")


def round_trip(pages: DataFrame, spark: SparkSession, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    The size of a revisit's payload comes from the response it refers to, which
    is read from the archives as well.  An empty table gives an empty result.
    """
    manifest = write_archives(pages, scratch_dir(spark, "warc"), least_bytes)
    page = F.regexp_extract("record_id", r"^urn:page:(-?\d+)$", 1)
    other = F.regexp_extract("refers_to", r"^urn:page:(-?\d+)$", 1)
    records = materialize(read_archives(manifest).select(
        F.when(page != "", page.cast("long")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("n"), "payload_digest", "record_type",
        F.when(other != "", other.cast("long")).alias("refers_to")), "warc-records")
    wanted = records.where("record_type = 'revisit'").select(F.col("refers_to").alias("id")).distinct()
    sizes = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("id"), "payload_digest").agg(
        F.max("n").alias("size")).join(wanted, "id", "left_semi").withColumnRenamed("id", "refers_to")
    return salted_left_join(records, sizes, ["refers_to", "payload_digest"], F.xxhash64("page_id")).select(
        "page_id", F.coalesce("n", "size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
