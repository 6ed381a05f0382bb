"""WARC records in ZIP packages: written through Spark's text writer, read back by byte ranges.

A package is a ZIP file with two stored members: ``archive/data.warc`` and ``indexes/index.cdxj``. All
sizes and places are also given in ZIP64 form, so a package may pass 4 GiB. A reader takes the
end record and, through the ZIP64 locator, the central directory; finds the stored members and their
first bytes behind the local headers; range-reads the index; and range-reads records by it,
neighbours together. Nothing is extracted, and no range is read twice.

Packages are written with ``df.write.text``: a row for each piece of the file, a line end between
pieces. Records and index lines end in one anyhow, and the one after the end record is the ZIP comment. So
Spark's own commit protocol covers them, on any file system it can write to. Readers need a
file system that Arrow can open (file, hdfs, s3, gs).

Payloads are the html in UTF-8, null counting as empty. Of the pages with one payload of at
least ``REVISIT_BYTES`` bytes, the one with the smallest page_id is a response, and the others revisit
it. Repeated rows of that page are responses too. A page without an id can only revisit; it
is a response where all pages with its payload lack an id. Control characters in an url are escaped.
An empty table gives no package and no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import urllib.parse
import zlib

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.text import table
from kerbside.session import scratch_path

REVISIT_BYTES = 100
RANGE_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
ARCHIVE, INDEX = b"archive/data.warc", b"indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the ZIP format: signatures and field layouts.
LOCAL, DESCRIPTOR, CENTRAL = b"PK\x03\x04", b"PK\x07\x08", b"PK\x01\x02"
END, END64, LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
LOCAL_HEAD, CENTRAL_HEAD = struct.Struct("<4s5H3I2H"), struct.Struct("<4s6H3I5H2I")
END_RECORD, END64_RECORD, LOCATOR_RECORD = struct.Struct("<4s4H2IH"), struct.Struct("<4sQ2H2I4Q"), struct.Struct("<4sIQI")
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


def _compressed(batches):
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        payload = pa.array([pack(p) for p in batch.column("payload").to_pylist()], pa.binary())
        yield batch.set_column(batch.schema.get_field_index("payload"), "payload", payload)


def classified(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_digest, refers_to``: null refers_to for responses, payloads in zstd."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    shared = (rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    # The join moves the payloads: compressed, they are a third of what they are.
    rows = rows.mapInArrow(_compressed, "page_id long, url string, payload binary, payload_digest string")
    return rows.join(shared, "payload_digest", "left").select("page_id", "url", "payload", "payload_digest",
                                                             refers.alias("refers_to"))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, with the two line ends that close it."""
    revisit = refers_to is not None
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _urn(page_id),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "text/html; charset=utf-8",
    }
    if url is not None:
        head["WARC-Target-URI"] = urllib.parse.quote(url, safe="".join(map(chr, range(33, 127))))
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _urn(refers_to), "X-Payload-Length": str(len(payload))}
        payload = b""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in head.items()), f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(lines).encode() + payload + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, by lower-case name, and content of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return fields, rest[: int(fields["content-length"])]


class _Package:
    """Pieces of one package, in the order of its bytes."""

    def __init__(self):
        self.at, self.members, self.index = 0, [], []

    def _member(self, name: bytes) -> bytes:
        self.name, self.head, self.crc = name, self.at, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        data = LOCAL_HEAD.pack(LOCAL, 45, 8, 0, 0, 33, 0, FULL32, FULL32, len(name), len(extra)) + name + extra
        self.at += len(data)
        self.first = self.at
        return data

    def _put(self, data: bytes) -> bytes:
        self.crc = zlib.crc32(data, self.crc)
        self.at += len(data)
        return data

    def _close(self) -> bytes:
        size = self.at - self.first
        self.members.append((self.name, self.crc, size, self.head))
        data = DESCRIPTOR + struct.pack("<IQQ", self.crc, size, size)
        self.at += len(data)
        return data

    def pieces(self, records):
        """Byte strings that each end before the line end which the writer adds."""
        lead = b""
        for page_id, data in records:
            if not self.at:
                lead = self._member(ARCHIVE)
            place = self.at - self.first
            line = {"page": page_id, "offset": place, "length": len(data)}
            self.index.append(json.dumps(line).encode() + b"\n")
            yield (lead + self._put(data))[:-1]
            lead = b""
        if not self.at:
            return
        lead = self._close() + self._member(INDEX)
        yield (lead + self._put(b"".join(self.index)))[:-1]
        lead, start = self._close(), self.at
        directory = b""
        for name, crc, size, head in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, head)
            directory += CENTRAL_HEAD.pack(CENTRAL, 45, 45, 8, 0, 0, 33, crc, FULL32, FULL32, len(name), len(extra), 0, 0, 0, 0,
                                           FULL32) + name + extra
        n = len(self.members)
        end = END64_RECORD.pack(END64, 44, 45, 45, 0, 0, n, n, len(directory), start)
        end += LOCATOR_RECORD.pack(LOCATOR, 0, start + len(directory), 1)
        end += END_RECORD.pack(END, FULL16, FULL16, FULL16, FULL16, FULL32, FULL32, 1)
        yield lead + directory + end


def write_packages(pages: DataFrame, path: str) -> None:
    """Write a WARC record per row of ``pages``; each task writes one package under ``path``."""

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress

        def records():
            for batch in batches:
                for row in batch.to_pylist():
                    payload = unpack(row["payload"])
                    yield row["page_id"], record(row["page_id"], row["url"], payload, row["payload_digest"], row["refers_to"])

        held, size = [], 0
        for piece in _Package().pieces(records()):
            held.append(piece)
            size += len(piece)
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["piece"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["piece"])

    pieces = classified(pages).mapInArrow(run, "piece binary")
    pieces.select(F.col("piece").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def _opened(path: str):
    files, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return files.open_input_file(name)


def _range(source, start: int, size: int) -> bytes:
    data = source.read_at(size, start)
    if len(data) != size:
        raise EOFError(f"{size} bytes wanted at {start}, {len(data)} read")
    return data


def directory(source, length: int) -> dict[bytes, tuple[int, int, int]]:
    """``name -> (method, first byte, size)`` of the members of a ZIP or ZIP64 file."""
    tail_at = max(0, length - (1 << 16) - END_RECORD.size)
    tail = _range(source, tail_at, length - tail_at)
    at = tail.rfind(END, 0, max(0, len(tail) - END_RECORD.size + len(END)))
    while at >= 0 and tail_at + at + END_RECORD.size + END_RECORD.unpack_from(tail, at)[7] != length:
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    _, _, _, _, count, size, start, _ = END_RECORD.unpack_from(tail, at)
    if count == FULL16 or FULL32 in (size, start):
        _, _, place, _ = LOCATOR_RECORD.unpack(_range(source, tail_at + at - LOCATOR_RECORD.size, LOCATOR_RECORD.size))
        mark, _, _, _, _, _, _, count, size, start = END64_RECORD.unpack(_range(source, place, END64_RECORD.size))
        if mark != END64:
            raise ValueError("the ZIP64 locator points elsewhere")
    entries, at, members = _range(source, start, size), 0, {}
    for _ in range(count):
        head = CENTRAL_HEAD.unpack_from(entries, at)
        method, packed, whole, place = head[4], head[8], head[9], head[16]
        name = entries[at + CENTRAL_HEAD.size :][: head[10]]
        extra = entries[at + CENTRAL_HEAD.size + head[10] :][: head[11]]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = [v for (v,) in struct.iter_unpack("<Q", extra[4 : 4 + n // 8 * 8])]
                whole = wide.pop(0) if whole == FULL32 else whole
                packed = wide.pop(0) if packed == FULL32 else packed
                place = wide.pop(0) if place == FULL32 else place
            extra = extra[4 + n :]
        local = LOCAL_HEAD.unpack(_range(source, place, LOCAL_HEAD.size))
        members[name] = method, place + LOCAL_HEAD.size + local[9] + local[10], packed
        at += CENTRAL_HEAD.size + head[10] + head[11] + head[12]
    return members


def _index_rows(batches):
    for batch in batches:
        for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
            with _opened(path) as source:
                members = directory(source, length)
                for name in (ARCHIVE, INDEX):
                    if members[name][0] != 0:
                        raise ValueError(f"{name!r} of {path} is not stored")
                archive = members[ARCHIVE][1]
                lines = _range(source, members[INDEX][1], members[INDEX][2]).splitlines()
            spots = [json.loads(line) for line in lines]
            yield pa.RecordBatch.from_arrays([
                pa.array([path] * len(spots), pa.string()),
                pa.array([archive + s["offset"] for s in spots], pa.int64()),
                pa.array([s["length"] for s in spots], pa.int64()),
            ], ["path", "start", "size"])


def _runs(batches):
    """Neighbouring records as ``(path, [(start, size), ...])``, of about ``RANGE_BYTES``."""
    path, spots = None, []
    for batch in batches:
        for p, start, size in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size"))):
            if spots and (p != path or start != sum(spots[-1]) or start + size - spots[0][0] > RANGE_BYTES):
                yield path, spots
                spots = []
            path = p
            spots.append((start, size))
    if spots:
        yield path, spots


def read_packages(spark, path: str, payloads: bool = True) -> DataFrame:
    """``page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload`` of all records.

    A response's length and digest are those of the bytes read, which must agree with its header. A
    revisit has those of its header, and no payload. ``payloads=False`` leaves the payload null.
    """
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]

    def run(batches):
        for name, spots in _runs(batches):
            with _opened(name) as source:
                data = _range(source, spots[0][0], sum(spots[-1]) - spots[0][0])
            rows = []
            for start, size in spots:
                head, content = parsed(data[start - spots[0][0] :][:size])
                digest, refers = head["warc-payload-digest"].removeprefix("sha256:"), None
                count = len(content)
                if head["warc-type"] == "revisit":
                    refers, count, content = _page(head["warc-refers-to"]), int(head["x-payload-length"]), None
                elif hashlib.sha256(content).hexdigest() != digest:
                    raise ValueError(f"damaged record at {start} of {name}")
                url = head.get("warc-target-uri")
                rows.append((_page(head["warc-record-id"]), url, head["warc-type"], count, digest, refers,
                             content if payloads else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows), fields)],
                                             [n for n, _ in fields])

    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    spots = files.repartition("path").mapInArrow(_index_rows, "path string, start long, size long")
    stretch = F.floor(F.col("start") / RANGE_BYTES)
    # The rows are small and what they stand for is not, so tasks are counted by the bytes to read.
    tasks = max(1, (files.agg(F.sum("length")).first()[0] or 0) // (2 * RANGE_BYTES))
    spots = spots.repartition(tasks, "path", stretch).sortWithinPartitions("path", "start")
    return spots.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
                                 "refers_to long, payload binary")


def op8_warc_packages(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "packages")
    write_packages(table(spark, sf_dir, "pages"), path)
    return read_packages(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
