"""WARC records in ZIP packages, written by Spark tasks and range-read without extraction."""

from __future__ import annotations

import base64
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
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import persisted, shared_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"  #: members of a package
LEVEL = 4  #: of compression; each record is a gzip member of its own
TAIL = 1 << 16  #: bytes read at the end of a package to find its directory
SPAN = 1 << 22  #: neighbouring records are read in spans of about this size
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  #: the pages have no date of their own; fixed, so that archives are reproducible


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def named(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit without the payload where ``refers_to`` is given."""
    headers = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": name(page_id), "WARC-Date": DATE}
    if url is not None:
        headers["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    headers["WARC-Payload-Digest"] = f"sha1:{digest(payload)}"
    if refers_to is not None:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": name(refers_to), "X-Payload-Length": str(len(payload))}
    block = HTTP + (payload if refers_to is None else b"")
    headers |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict[str, object]:
    """page_id, record_type, refers_to, payload_bytes and payload_digest of a record.

    A response's length and digest come from its bytes, and a digest that doesn't agree
    with the header is an error; a revisit, whose payload is elsewhere, states its own.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(headers["content-length"])]
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    out: dict[str, object] = {"page_id": named(headers.get("warc-record-id")), "record_type": headers["warc-type"], "refers_to": None}
    if headers["warc-type"] == "revisit":
        length = headers.get("x-payload-length")
        return out | {"refers_to": named(headers.get("warc-refers-to")), "payload_bytes": length and int(length), "payload_digest": stated}
    payload = block.partition(b"\r\n\r\n")[2]
    found = digest(payload)
    if stated and stated != found:
        raise ValueError(f"payload digest {found} isn't the stated {stated}")
    return out | {"payload_bytes": len(payload), "payload_digest": found}


@dataclass(frozen=True)
class Member:
    """A member of a ZIP file: its method, stored size and the place of its local header."""

    method: int
    size: int
    header: int


def _read(file, at: int, n: int) -> bytes:
    file.seek(at)
    out = file.read(n)
    if len(out) != n:
        raise ValueError(f"package ends at {at + len(out)}, {at + n} expected")
    return out


def directory(file, size: int) -> dict[str, Member]:
    """Members of a ZIP file, from its central directory; ZIP64 records are followed where fields overflow.

    Only the end of the file, the directory and, with ZIP64, its end record are read.
    """
    tail_at = max(0, size - TAIL - 22)
    tail = _read(file, tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no ZIP directory found")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    locator = tail_at + at - 20
    if locator >= 0 and (mark := _read(file, locator, 20))[:4] == b"PK\x06\x07":
        end = _read(file, struct.unpack_from("<Q", mark, 8)[0], 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record where the locator points")
        entries, length, start = struct.unpack_from("<QQQ", end, 32)
    data, at, members = _read(file, start, length), 0, {}
    for _ in range(entries):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken ZIP directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        stored, plain, n, extra, comment = struct.unpack_from("<IIHHH", data, at + 20)
        (header,) = struct.unpack_from("<I", data, at + 42)
        title = data[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        field, stop = at + 46 + n, at + 46 + n + extra
        while field + 4 <= stop:
            kind, long = struct.unpack_from("<HH", data, field)
            if kind == 1:  # 64-bit values, only of the fields that overflow, in this order
                values = iter(struct.unpack_from(f"<{long // 8}Q", data, field + 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                stored = next(values) if stored == 0xFFFFFFFF else stored
                header = next(values) if header == 0xFFFFFFFF else header
            field += 4 + long
        members[title] = Member(method, stored, header)
        at = stop + comment
    return members


def begin(file, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError("only stored members can be range-read")
    head = _read(file, member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header where the directory points")
    n, extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n + extra


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """(path, records) of the packages written from (page_id, url, html, refers_to); one for each task.

    Paths are unique for each attempt of a task and only those of finished tasks are in
    the result, so a retried task leaves a file that nothing refers to, never a wrong
    result.  ``folder`` is a URI that all executors share.
    """

    def run(batches):
        place, stream, package, index, at = None, None, None, [], 0
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    place = f"{uuid.uuid4().hex}.wacz"
                    store.create_dir(base, recursive=True)
                    stream = store.open_output_stream(f"{base}/{place}")
                    package = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
                    data = package.open(DATA, "w", force_zip64=True)
                packer = zlib.compressobj(LEVEL, wbits=31)
                payload = (row["html"] or "").encode()
                packed = packer.compress(record(row["page_id"], row["url"], payload, row["refers_to"])) + packer.flush()
                data.write(packed)
                index.append(json.dumps({"record": name(row["page_id"]), "offset": at, "length": len(packed)}))
                at += len(packed)
        if package is not None:
            data.close()
            package.writestr(INDEX, "\n".join(index))
            package.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{place}"], "records": [len(index)]})

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, records long")


def _spans(entries: list[tuple[int, int]]) -> Iterator[tuple[int, list[int]]]:
    """(start, lengths): neighbouring records joined to reads of about ``SPAN`` bytes."""
    entries.sort()
    start, lengths, end = 0, [], 0
    for at, n in entries:
        if lengths and (at != end or end - start >= SPAN):
            yield start, lengths
            lengths = []
        if not lengths:
            start = at
        lengths.append(n)
        end = at + n
    if lengths:
        yield start, lengths


def index_spans(packages: DataFrame) -> DataFrame:
    """(path, at, lengths): stretches of neighbouring records of about ``SPAN`` bytes, absolute places in the file.

    They are what tasks are dealt, so a package takes about as many reads as it has spans
    of bytes, however many its records are.
    """

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    members = directory(file, file.size())
                    data, index = begin(file, members[DATA]), members[INDEX]
                    lines = _read(file, begin(file, index), index.size).decode().splitlines()
                entries = [json.loads(x) for x in lines]
                spans = list(_spans([(data + x["offset"], x["length"]) for x in entries]))
                for a in range(0, len(spans), 256):
                    some = spans[a : a + 256]
                    yield pa.RecordBatch.from_pydict(
                        {"path": [path] * len(some), "at": [x[0] for x in some], "lengths": [x[1] for x in some]},
                        schema=pa.schema([("path", pa.string()), ("at", pa.int64()), ("lengths", pa.list_(pa.int64()))]),
                    )

    return packages.select("path").mapInArrow(run, "path string, at long, lengths array<long>")


def read_records(spans: DataFrame) -> DataFrame:
    """The parsed records at the places that :func:`index_spans` gives, by one ranged read for each."""
    columns = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}

    def run(batches):
        opened = (None, None)
        for batch in batches:
            for path, at, lengths in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "lengths")), strict=True):
                if opened[0] != path:
                    if opened[1]:
                        opened[1].close()
                    store, place = fs.FileSystem.from_uri(path)
                    opened = (path, store.open_input_file(place))
                data, a, found = _read(opened[1], at, sum(lengths)), 0, []
                for n in lengths:
                    found.append(parse(zlib.decompress(data[a : a + n], wbits=31)))
                    a += n
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], t) for c, t in columns.items()], list(columns))
        if opened[1]:
            opened[1].close()

    return spans.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """(path, records) of the packages that hold a record for every row of ``pages``.

    Of rows with equal payloads the one with the largest page_id is the response and the
    others revisit it.  Rows that share that page_id are all responses; rows without an
    id revisit the response, and are responses if no row of their payload has an id.
    Payloads meet as SHA-1 digests; the answer of each digest is joined back, so a
    payload that most rows share is a skewed join, which adaptive execution splits.
    """
    folder = folder or shared_dir(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha"))
    last = persisted(rows.groupBy("sha").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n"))
    marked = rows.join(last, "sha", "left").withColumn("refers_to", F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")))
    return persisted(write_packages(marked, folder))


def read_packages(packages: DataFrame) -> DataFrame:
    """Every record of the packages: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Spans of the packages' records are spread over tasks, so one large package is read by
    many, each record's bytes once.  No package is extracted or held whole.
    """
    spark = packages.sparkSession
    spans = index_spans(packages).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read_records(spans)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written as WARC records in ZIP packages, then read back.

    A null html is an empty payload, a null url leaves its header out.  Repeated rows are
    separate records; other columns are ignored; an empty table gives an empty result.

    Returns page_id long, payload_bytes long, payload_digest string, record_type string,
    refers_to long.
    """
    return read_packages(archive_pages(pages))
