"""WARC records in ZIP packages, read in place.

A package is a ZIP file whose members are stored, not compressed: ``archive/*.warc.gz``
holds one gzip member per WARC record, ``indexes/*.cdxj.gz`` one line per record with
its offset and length. Reading parses the central directory (also its ZIP64 form),
finds the stored members, takes record places from the index and range-reads runs of
records; nothing is unpacked to disk and a package of any size is read by many tasks.

Packages live in a folder that all executors share. Tasks reach it through Arrow's
file systems (``file``, ``hdfs``, ``s3``, ``gs``). Each attempt of a writing task makes
files of its own, and only those the finished attempt reports are ever read, so a lost
executor leaves nothing but an unread file.
"""

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipyard.session import materialize, scratch_path

#: Compressed bytes after which a writing task begins another package.
PACKAGE_BYTES = 64 << 20
#: Bytes one ranged read asks for; a longer record is a read of its own.
SPAN_BYTES = 1 << 20
#: Archive bytes one reading task takes.
READ_TASK_BYTES = 32 << 20

# Signatures and sizes of the ZIP format.
_END, _END_SIZE = b"PK\x05\x06", 22
_LOCATOR, _LOCATOR_SIZE = b"PK\x06\x07", 20
_END64, _ENTRY, _LOCAL = b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


def _file_system(path: str):
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def _read_at(file, start: int, size: int) -> bytes:
    file.seek(start)
    return file.read(size)


def stored_members(file, size: int) -> dict[str, tuple[int, int]]:
    """``name -> (offset of the data, length)`` of the stored members of a ZIP file.

    ``file`` can seek. Only the directories and local headers are read. Members that
    are compressed cannot be read in place and are left out.
    """
    tail_at = max(0, size - _END_SIZE - _FULL16)
    tail = _read_at(file, tail_at, size - tail_at)
    end = tail.rfind(_END)
    if end < 0:
        raise ValueError("no end of a central directory: not a ZIP file")
    entries, length, start = struct.unpack_from("<HLL", tail, end + 10)
    locator_at = tail_at + end - _LOCATOR_SIZE
    if locator_at >= 0:
        locator = _read_at(file, locator_at, _LOCATOR_SIZE)
        if locator[:4] == _LOCATOR:
            (end64_at,) = struct.unpack_from("<Q", locator, 8)
            end64 = _read_at(file, end64_at, 56)
            if end64[:4] != _END64:
                raise ValueError("the ZIP64 locator points to no ZIP64 directory")
            entries, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, at, found = _read_at(file, start, length), 0, {}
    for _ in range(entries):
        if directory[at : at + 4] != _ENTRY:
            raise ValueError("the central directory is cut short")
        (method,) = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<LLHHH", directory, at + 20)
        (local,) = struct.unpack_from("<L", directory, at + 42)
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # 8-byte values, only of the fields that are full, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(wide) if plain == _FULL32 else plain
                packed = next(wide) if packed == _FULL32 else packed
                local = next(wide) if local == _FULL32 else local
            extra = extra[4 + n :]
        at += 46 + n_name + n_extra + n_note
        if method == 0 and not name.endswith("/"):
            head = _read_at(file, local, 30)
            if head[:4] != _LOCAL:
                raise ValueError(f"no local header for {name}")
            found[name] = (local + 30 + sum(struct.unpack_from("<HH", head, 26)), packed)
    return found


def scan_records(file, start: int, length: int):
    """``(offset, length)`` of every gzip member of a stored archive without an index."""
    at = begin = 0
    inflate = zlib.decompressobj(31)
    while at < length:
        chunk = _read_at(file, start + at, min(SPAN_BYTES, length - at))
        inflate.decompress(chunk)
        if not inflate.eof:
            at += len(chunk)
            continue
        at += len(chunk) - len(inflate.unused_data)
        yield begin, at - begin
        begin, inflate = at, zlib.decompressobj(31)
    if begin < length:
        raise ValueError("the last record is cut short")


def record_places(file, size: int):
    """``(offset in the package, length)`` of every record, archive by archive."""
    members = stored_members(file, size)
    indexed: dict[str, list] = {}
    for name, (start, length) in members.items():
        if name.startswith("indexes/") and name.endswith((".cdxj", ".cdxj.gz")):
            lines = _read_at(file, start, length)
            lines = gzip.decompress(lines) if name.endswith(".gz") else lines
            for line in lines.splitlines():
                entry = json.loads(line[line.index(b"{") :])
                indexed.setdefault(f"archive/{entry['filename']}", []).append(
                    (int(entry["offset"]), int(entry["length"]))
                )
    for name, (start, length) in members.items():
        if name.startswith("archive/") and name.endswith(".warc.gz"):
            places = sorted(indexed[name]) if name in indexed else scan_records(file, start, length)
            for offset, n in places:
                yield start + offset, n


def encode_record(headers: dict[str, str], payload: bytes) -> bytes:
    """One WARC record as a gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(payload)}"]
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return press.compress(head) + press.compress(payload) + press.compress(b"\r\n\r\n") + press.flush()


def decode_record(member: bytes) -> tuple[dict[str, str], bytes]:
    raw = zlib.decompress(member, 31)
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8", "replace").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, raw[end + 4 : end + 4 + int(headers["Content-Length"])]


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _Package:
    """A package being written, record after record, to a stream that cannot seek."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, inner = _file_system(self.path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(inner)
        self.zip = zipfile.ZipFile(_Forward(self.stream), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open("archive/data.warc.gz", "w", force_zip64=True)
        self.index, self.size = io.StringIO(), 0

    def add(self, url: str, record: bytes):
        place = {"offset": self.size, "length": len(record), "filename": "data.warc.gz"}
        self.index.write(f"{url.replace(' ', '%20') or '-'} 19700101000000 {json.dumps(place)}\n")
        self.member.write(record)
        self.size += len(record)

    def close(self) -> str:
        self.member.close()
        self.zip.writestr("indexes/index.cdxj.gz", gzip.compress(self.index.getvalue().encode(), 1))
        self.zip.close()
        self.stream.close()
        return self.path


class _Forward(io.RawIOBase):
    """An Arrow output stream as a Python stream without seeking."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self):
        return True

    def write(self, data):
        self.stream.write(data)
        return len(data)


def write_packages(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write one WARC record per row of ``pages``; returns the packages as ``path, records``.

    Of the rows with equal payloads of at least ``min_revisit_bytes`` bytes the one with
    the largest ``page_id`` is a response (all rows with that id, if it repeats) and the
    others revisit it; a row with a null id revisits too, and is a response where no
    equal row has an id. A null html is an empty payload. ``pages`` has ``page_id, url,
    html``; other columns are ignored. The returned table is stored: it lists what was
    written, once.
    """
    folder = folder or scratch_path(pages.sparkSession, "packages")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha1("payload"))
    # Copies are counted on narrow rows, before the shuffle; few payloads have any.
    copies = (
        rows.filter(F.length("payload") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and target is not null")
        .select("digest", "target")
    )
    sent = rows.join(copies, "digest", "left").select("page_id", "url", "payload", "digest", "target")

    def write(batches):
        package, written, records = None, [], 0
        for batch in batches:
            for page, url, payload, digest, target in zip(*(c for c in batch.columns)):
                page, payload, target = page.as_py(), payload.as_py(), target.as_py()
                url = url.as_py().replace("\r", "%0D").replace("\n", "%0A")
                revisit = target is not None and page != target
                headers = {
                    "WARC-Type": "revisit" if revisit else "response",
                    "WARC-Record-ID": f"<urn:page:{'' if page is None else page}>",
                    "WARC-Target-URI": url,
                    "WARC-Date": "1970-01-01T00:00:00Z",  # the table has no times
                    "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest.as_py())).decode(),
                    "WARC-Full-Payload-Length": str(len(payload)),
                }
                if revisit:
                    headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    headers["WARC-Refers-To"] = f"<urn:page:{target}>"
                package = package or _Package(folder)
                package.add(url, encode_record(headers, b"" if revisit else payload))
                records += 1
                if package.size >= PACKAGE_BYTES:
                    written.append((package.close(), records))
                    package, records = None, 0
        if package:
            written.append((package.close(), records))
        if written:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*written)], ["path", "records"])

    return materialize(sent.mapInArrow(write, "path string, records bigint"), "package_list")


_SPANS = "path string, start bigint, lengths array<int>"


def record_spans(packages: DataFrame) -> DataFrame:
    """``path, start, lengths``: runs of neighbouring records of about ``SPAN_BYTES``."""
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int32()))])

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = _file_system(path)
                with system.open_input_file(inner) as file:
                    rows, start, lengths = [], None, []
                    for at, n in record_places(file, file.size()):
                        if lengths and (at != start + sum(lengths) or sum(lengths) + n > SPAN_BYTES):
                            rows.append((path, start, lengths))
                            lengths = []
                        start = at if not lengths else start
                        lengths.append(n)
                        if len(rows) >= 1000:
                            yield out(rows)
                            rows = []
                    if lengths:
                        rows.append((path, start, lengths))
                    if rows:
                        yield out(rows)

    return packages.select("path").mapInArrow(run, _SPANS)


def read_packages(packages: DataFrame, payload: bool = True) -> DataFrame:
    """One row per WARC record of the packages listed in ``path``.

    ``page_id, url, record_type, payload_bytes, payload_digest, refers_to`` and, if asked
    for, ``payload`` (null for a revisit). A response's digest is computed from the
    bytes read and must be the stored one. Each package is opened by one task for its
    directories and index; the record ranges are then dealt over all tasks.
    """
    fields = [
        ("page_id", pa.int64(), "bigint"), ("url", pa.string(), "string"), ("record_type", pa.string(), "string"),
        ("payload_bytes", pa.int64(), "bigint"), ("payload_digest", pa.string(), "string"), ("refers_to", pa.int64(), "bigint"),
    ]
    if payload:
        fields.append(("payload", pa.binary(), "binary"))
    schema = pa.schema([(n, kind) for n, kind, _ in fields])

    def page_of(name):
        return int(name.removeprefix("<urn:page:")[:-1]) if name and name != "<urn:page:>" else None

    def run(batches):
        for batch in batches:
            for path, start, lengths in zip(*[c.to_pylist() for c in batch.columns]):
                system, inner = _file_system(path)
                with system.open_input_file(inner) as file:
                    span = _read_at(file, start, sum(lengths))
                at, rows = 0, []
                for n in lengths:
                    headers, body = decode_record(span[at : at + n])
                    at += n
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(headers["WARC-Full-Payload-Length"])
                    kind = headers["WARC-Type"]
                    if kind != "revisit":
                        if digest_of(body) != digest:
                            raise ValueError(f"digest of {headers['WARC-Record-ID']} in {path} is wrong")
                        size = len(body)
                    row = (page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], kind, size, digest, page_of(headers.get("WARC-Refers-To")))
                    rows.append((*row, None if kind == "revisit" else body) if payload else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), schema)], schema=schema)

    # Span rows are tiny next to the archive bytes they name: the number of reading tasks
    # follows those bytes, given explicitly so that no coalescing by row size merges them.
    spans = materialize(record_spans(packages), "warc-spans")
    total = spans.select(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n))).first()[0] or 0
    tasks = max(1, -(-total // READ_TASK_BYTES))
    return spans.repartition(tasks, "path", "start").mapInArrow(run, ", ".join(f"{n} {kind}" for n, _, kind in fields))
