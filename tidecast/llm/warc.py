"""WARC records in ZIP-packaged archives: writer and range reader.

Method. Records are written as gzip members of one stored (uncompressed) ZIP
member ``archive/data.warc.gz`` next to a stored index ``indexes/index.cdxj``. The
reader never extracts: it reads the end of the file for the end-of-directory
records (ZIP64 ones included), parses the central directory, locates the stored
members through their local headers, reads the index and then range-reads runs
of records of about ``BLOCK`` bytes.

Plan. Each task streams its rows into archives of about ``ARCHIVE`` bytes under the
shared folder and returns one manifest row per finished archive; the manifest is
stored, so only archives of tasks that ended well are ever read, whatever was
retried or lost. Reading is spread by block, not by archive. The first page of
each payload comes from an aggregation over digests (partial on the map side);
only digests that occur twice are joined back, broadcast after a count.

Defined results. Null html: empty payload. Records with payloads of at least
``MIN_REVISIT`` bytes that equal an earlier one (smallest page_id) are revisits;
rows that repeat the smallest page_id are responses too; a null page_id counts
as largest and is a response if its payload has no other page. Null url: no
target header. Empty table: no archive, no rows. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import arrow_map, small, stored

MIN_REVISIT = 100
ARCHIVE = 64 << 20
BLOCK = 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI (``file:/x`` and plain paths included)."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


# --- records ---------------------------------------------------------------

def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record (response, or revisit without its payload)."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      b"Content-Length: %d" % len(payload), b"", b""])
    revisit = refers_to is not None
    body = http if revisit else http + payload
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"),
            b"WARC-Record-ID: <urn:page:%s>" % ("" if page_id is None else str(page_id)).encode(),
            b"WARC-Date: " + DATE.encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c < " " else c for c in url).encode())
    if revisit:
        head += [b"WARC-Profile: " + PROFILE.encode(), b"WARC-Refers-To: <urn:page:%s>" % str(refers_to).encode()]
    head += [b"WARC-Payload-Digest: sha256:" + hashlib.sha256(payload).hexdigest().encode(),
             b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(body)]
    return CRLF.join(head) + CRLF * 2 + body + CRLF * 2


def parse(data: bytes) -> dict:
    """The facts of one record; the digest of a response is computed from its payload."""
    head, _, rest = data.partition(CRLF * 2)
    lines = head.split(CRLF)
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
    body = rest[:int(fields[b"content-length"])]
    http, _, payload = body.partition(CRLF * 2)
    size = next(int(x.partition(b":")[2]) for x in http.split(CRLF) if x.lower().startswith(b"content-length:"))
    kind = fields[b"warc-type"].decode()
    told = fields[b"warc-payload-digest"].decode().removeprefix("sha256:")
    if kind == "response":
        seen = hashlib.sha256(payload).hexdigest()
        if seen != told or len(payload) != size:
            raise ValueError("a payload does not match its record")
    urn = lambda k: fields[k].decode().removeprefix("<urn:page:").removesuffix(">") if k in fields else ""
    return {"page_id": urn(b"warc-record-id"), "payload_bytes": size, "payload_digest": told, "record_type": kind,
            "refers_to": urn(b"warc-refers-to"), "payload": payload if kind == "response" else None,
            "url": fields[b"warc-target-uri"].decode() if b"warc-target-uri" in fields else None}


def surt(url: str | None) -> str:
    """The sort-friendly key of a URL: host labels from the last on, then path and query; ``-`` without a URL."""
    found = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)", url or "")
    if not found:
        return "-"
    host, rest = found[1].lower().strip("."), found[2]
    return re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", ",".join(reversed(host.split("."))) + ")" + (rest if rest.startswith("/") else "/" + rest))


# --- ZIP directory ---------------------------------------------------------

@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def directory(read, size: int) -> list[Member]:
    """The members of a ZIP file from its central directory; ``read(offset, n)`` reads a range."""
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HLL", tail, at + 10)
    if at >= 20 and tail[at - 20:at - 16] == b"PK\x06\x07":  # ZIP64 locator
        end64 = struct.unpack_from("<Q", tail, at - 12)[0]
        head = read(end64, 56)
        if head[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", head, 32)
    data, out, p = read(start, length), [], 0
    for _ in range(count):
        if data[p:p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, p + 10)[0]
        packed, plain, n, x, c = struct.unpack_from("<LLHHH", data, p + 20)
        header = struct.unpack_from("<L", data, p + 42)[0]
        name, extra = data[p + 46:p + 46 + n], data[p + 46 + n:p + 46 + n + x]
        while len(extra) >= 4:  # ZIP64 values stand in this order, where the field above is full
            tag, k = struct.unpack_from("<HH", extra)
            if tag == 1:
                values = iter(struct.unpack_from(f"<{k // 8}Q", extra, 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            extra = extra[4 + k:]
        out.append(Member(name.decode(), method, packed, header))
        p += 46 + n + x + c
    return out


def data_range(read, member: Member) -> tuple[int, int]:
    """(offset, size) of a stored member's bytes, past its local header."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored, so it cannot be read by range")
    head = read(member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    n, x = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n + x, member.size


# --- writer ----------------------------------------------------------------

class ArchiveWriter:
    """Streams records into one ZIP-packaged archive."""

    def __init__(self, folder: str):
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        self.name = f"{uuid.uuid4().hex}.wacz"
        self.sink = fs.open_output_stream(f"{root}/{self.name}")
        self.zip = zipfile.ZipFile(self.sink, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(DATA, "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, data: bytes, page_id, url: str | None = None) -> None:
        packed = gzip.compress(data, compresslevel=1, mtime=0)
        self.member.write(packed)
        self.index.append((self.size, len(packed), page_id, surt(url)))
        self.size += len(packed)

    def close(self) -> int:
        self.member.close()
        time = "".join(c for c in DATE if c.isdigit())
        lines = "".join(sorted(f"{key} {time} {json.dumps({'offset': o, 'length': n, 'page': page})}\n" for o, n, page, key in self.index))
        self.zip.writestr(INDEX, lines)
        self.zip.close()
        self.sink.close()
        return len(self.index)


def _write_batches(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, writer = [], None
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                page, url, html, ref = (col[n][i].as_py() for n in ("page_id", "url", "html", "refers_to"))
                writer = writer or ArchiveWriter(folder)
                writer.add(record(page, url, (html or "").encode("utf-8", "surrogatepass"), ref), page, url)
                if writer.size >= ARCHIVE:
                    done.append((f"{folder}/{writer.name}", writer.close()))
                    writer = None
        if writer:
            done.append((f"{folder}/{writer.name}", writer.close()))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()),
                                          pa.array([d[1] for d in done], pa.int64())], names=["path", "n_records"])
    return run


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, refers_to: the smallest page_id of an equal payload, null for responses."""
    p = pages.select("page_id", "url", "html")
    digest, size = F.sha2(F.coalesce("html", F.lit("")), 256), F.octet_length(F.coalesce("html", F.lit("")))
    firsts = (p.filter(size >= MIN_REVISIT).groupBy(digest.alias("digest"))
              .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("digest", "first_page"))
    j = p.join(small(stored(firsts, "warc_firsts")), (size >= MIN_REVISIT) & (digest == F.col("digest")), "left")
    other = ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return j.select("page_id", "url", "html", F.when(other, F.col("first_page")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write every page as a record; the stored manifest (path, n_records) of the archives."""
    folder = folder or scratch_path(pages.sparkSession, "warc_archives")
    rows = with_revisits(pages)
    return stored(arrow_map(rows, _write_batches(folder), "path string, n_records bigint"), "warc_manifest")


# --- reader ----------------------------------------------------------------

def _locate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(batch.schema.names.index("path")).to_pylist():
            fs, name = filesystem(path)
            with fs.open_input_file(name) as f:
                read = lambda at, n: f.read_at(n, at)
                members = {m.name: m for m in directory(read, f.size())}
                base, _ = data_range(read, members[DATA])
                at, n = data_range(read, members[INDEX])
                index = [json.loads(x.split(" ", 2)[2]) for x in read(at, n).decode().split("\n") if x]
                index.sort(key=lambda x: x["offset"])
            rows, lengths, total = [], [], 0
            for k, x in enumerate(index):
                lengths.append(x["length"])
                total += x["length"]
                if total >= BLOCK or k == len(index) - 1:
                    rows.append((path, base + x["offset"] + x["length"] - total, lengths))
                    lengths, total = [], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["path", "at", "lengths"])


RECORD_FIELDS = ("page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, "
                 "refers_to string")


def _read_batches(with_payload: bool):
    kinds = {"payload_bytes": pa.int64()} | ({"payload": pa.binary()} if with_payload else {})
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, name = filesystem(row["path"])
                with fs.open_input_file(name) as f:
                    data = f.read_at(sum(row["lengths"]), row["at"])
                facts, at = [], 0
                for n in row["lengths"]:
                    facts.append(parse(zlib.decompress(data[at:at + n], 31)))
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[c] for x in facts], kinds.get(c, pa.string())) for c in names], names=names)
    return run


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives of a manifest (``path`` column), read by range."""
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = arrow_map(manifest.select("path"), _locate_batches, "path string, at bigint, lengths array<bigint>")
    schema = RECORD_FIELDS + (", payload binary" if with_payload else "")
    return arrow_map(blocks.repartition(tasks), _read_batches(with_payload), schema)
