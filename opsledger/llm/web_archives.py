"""Web archives: a converter of legacy ARC files to WARC, with revisits for equal payloads, and readers of both.

ARC files have a version block and records with one header line each, whose fields depend on the version and whose last
field declares the length of what follows. The converter reads them by these lengths and makes up what WARC asks for
and ARC does not have: record ids, record types, timestamps in the newer form, digests. All files are compressed record
by record. Spark's text writer puts them into the shared store, one file per row; the separator it adds at the end of
a row is an empty compressed member, so files stay valid.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsledger.llm.arrow import frees_memory, slices
from opsledger.session import run_folder, stored

#: Records of one archive file hold about this many bytes before compression.
ARCHIVE_BYTES = 32 << 20
#: Field names of a record line, as the version block of each ARC version states them.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"],
}
#: Fixed value: the profile of revisits that are known by the digest of their payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"
_SPACE = {c: f"%{c:02X}" for c in [*range(33), 127]}
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:web-archives:records")


class DamagedArchive(ValueError):
    """A file whose header lines or declared lengths do not fit its bytes."""


def member(data: bytes) -> bytes:
    """One compressed member."""
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def plain(data: bytes) -> bytes:
    """The bytes of all members of ``data``; data that is not compressed stays as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    view, at, parts = memoryview(data), 0, []
    while data[at:at + 2] == b"\x1f\x8b":
        unpacker = zlib.decompressobj(31)
        while not unpacker.eof and at < len(data):
            piece = view[at:at + (1 << 14)]
            try:
                parts.append(unpacker.decompress(piece))
            except zlib.error as error:
                raise DamagedArchive(str(error)) from error
            at += len(piece) - len(unpacker.unused_data)
        if not unpacker.eof:
            raise DamagedArchive("the last member is not complete")
    return b"".join(parts)


def write_files(rows: DataFrame, folder: str) -> None:
    """Write each row of the binary column ``file`` as one file of ``folder``, closed by an empty member."""
    rows.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1) \
        .option("encoding", "ISO-8859-1").option("lineSep", member(b"").decode("latin-1")).text(folder)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``content`` of the files of ``folder``; none where a table without rows was written."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).where("length > 0") \
        .select("path", "content")


@dataclass(frozen=True)
class ArcRecord:
    """A record of an ARC file: the fields of its line by name, and its bytes."""
    version: int
    fields: dict[str, str]
    body: bytes


def arc_line(version: int, fields: dict[str, str]) -> bytes:
    return (" ".join(fields.get(name, "-") or "-" for name in ARC_FIELDS[version]) + "\n").encode("utf-8")


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 pages\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_line(version, {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain",
                              "Result-code": "200", "Archive-length": str(len(body)), "Offset": "0", "Filename": name}) + body + b"\n"


def arc_records(data: bytes) -> Iterator[ArcRecord]:
    """The records of one ARC file, the version block first. A line's fields are counted from its right end, since old
    crawlers left spaces in addresses."""
    data = plain(data)
    at, version = 0, 0
    while True:
        while data[at:at + 1] == b"\n":
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        line = data[at:end].decode("utf-8", "replace") if end >= 0 else ""
        if not version:
            if not line.startswith("filedesc:"):
                raise DamagedArchive(f"no version block at byte {at}")
            number = data[end + 1:end + 3]
            if number not in (b"1 ", b"2 "):
                raise DamagedArchive(f"unknown version {number!r}")
            version = int(number)
        names = ARC_FIELDS[version]
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit() or end + 1 + int(values[-1]) > len(data):
            raise DamagedArchive(f"no record of version {version} at byte {at}")
        at = end + 1 + int(values[-1])
        yield ArcRecord(version, dict(zip(names, values)), data[end + 1:at])


def http_parts(body: bytes) -> tuple[bytes, bytes]:
    """Head (with its empty line) and payload of a response; bytes without a head are all payload."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    for stop in (b"\r\n\r\n", b"\n\n"):
        at = body.find(stop)
        if at >= 0:
            return body[:at + len(stop)], body[at + len(stop):]
    return body, b""


def head_field(head: bytes, name: str) -> str | None:
    for line in head.split(b"\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def write_arc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
              date: str = "20240229120000", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` as legacy archives, files of version 1 and 2 in turn.

    A record is an HTTP response with the page's html as payload and its key in the head. White space and control
    characters of an address are escaped, a missing one is '-'. A null html is an empty payload; a null key has no
    line in the head; repeated rows are records of their own.
    """
    rows = pages.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{url}`").cast("string").alias("u"),
                        F.col(f"`{html}`").cast("string").alias("h"))

    @frees_memory
    def run(batches):
        task, made, held, size, offset = TaskContext.get().partitionId(), 0, [], 0, 0

        def archive():
            nonlocal made, held, size
            made, content, held, size = made + 1, b"".join(held), [], 0
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["file"])

        for batch in batches:
            for part in slices(batch, 2):
                for k, u, h in zip(*(part.column(i).to_pylist() for i in range(3))):
                    version, name = 1 + (task + made) % 2, f"pages-{task}-{made}.arc.gz"
                    payload = (h or "").encode("utf-8")
                    named = "" if k is None else f"{PAGE_HEADER}: {k}\r\n"
                    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{named}\r\n" \
                        .encode() + payload
                    if not held:
                        held.append(member(arc_version_block(version, name, date)))
                        offset = len(held[0])
                    line = arc_line(version, {
                        "URL": (u or "").translate(_SPACE), "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/html",
                        "Result-code": "200", "Offset": str(offset), "Filename": name, "Archive-length": str(len(body))})
                    held.append(member(line + body + b"\n"))
                    offset += len(held[-1])
                    size += len(body)
                    if size >= archive_bytes:
                        yield archive()
        if held:
            yield archive()

    write_files(rows.mapInArrow(run, "file binary"), folder)


def warc_date(date: str) -> str:
    """The 14 digits of a legacy date (missing ones are the earliest) as an ISO timestamp."""
    whole = date if date.isdigit() and 4 <= len(date) <= 14 else "19700101000000"
    d = whole + "19700101000000"[len(whole):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(path: str, place: int, digest: str) -> str:
    """A record id made from where the record lay and its digest, so converting again gives the same one."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, " ".join([path.rsplit("/", 1)[-1], str(place), digest]))}>"


def _base32(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def _described(record: ArcRecord) -> tuple[bytes, bytes, str, str]:
    """Head, payload, hex digest of the payload, target address."""
    head, payload = http_parts(record.body)
    target = record.fields["URL"]
    return head, payload, hashlib.sha1(payload).hexdigest(), "urn:address:missing" if target == "-" else target


def warc_record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.0", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


_REFERENCE = "struct<page:bigint,id:string,target:string,date:string>"


def convert_arc(spark: SparkSession, source: str, folder: str, revisit_bytes: int = 1000) -> None:
    """Convert the ARC files of folder ``source`` to WARC files in ``folder``, file by file.

    A first pass reads record lines, lengths and payload digests. Of records with equal payloads of at least
    ``revisit_bytes``, the one with the largest key in its head stays a response (of several with that key the one
    latest by file and place), the others become revisits, which keep the head but not the payload. The choice is an
    aggregation with partial results, so a payload that a third of all records share sends one row per task; the
    revisits of a file come back to it as one list, no longer than the file has records. A second pass writes.

    A file's version block becomes its warcinfo record. Records of ``dns:`` addresses, and others that are not HTTP
    responses, become resources. A damaged file raises ``DamagedArchive`` with its path. No file gives no file.
    """
    work = run_folder(spark, "convert_arc")
    files = read_files(spark, source)

    @frees_memory
    def describe(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                found: list[list] = [[] for _ in range(8)]
                for place, record in enumerate(_records_of(path.as_py(), content.as_py())):
                    if not place:
                        continue
                    head, payload, digest, target = _described(record)
                    page = head_field(head, PAGE_HEADER)
                    for column, value in zip(found, (path.as_py(), place, digest, len(payload) if head else -1,
                                                     None if page is None else int(page), record_id(path.as_py(), place, digest),
                                                     target, warc_date(record.fields["Archive-date"]))):
                        column.append(value)
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=names)

    names = ["path", "place", "digest", "n", "page", "id", "target", "date"]
    records = stored(files.mapInArrow(describe, "path string, place bigint, digest string, n bigint, page bigint, id string, "
                                                "target string, date string").where(F.col("n") >= revisit_bytes), f"{work}/records")
    order = F.struct(F.coalesce("page", F.lit(-(1 << 63))).alias("order"), "path", "place", "page", "id", "target", "date")
    first = records.groupBy("digest").agg(F.max(order).alias("r"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    later = records.select("digest", "path", "place").join(first.select("digest", "r"), "digest") \
        .where("path <> r.path or place <> r.place").groupBy("path").agg(F.collect_list(
            F.struct("place", F.struct("r.page", "r.id", "r.target", "r.date").alias("refers"))).alias("later"))
    # written first: its size is then known, and Spark moves the small side of the join and not the files
    rows = files.join(stored(later, f"{work}/later"), "path", "left").select("path", "content", "later")

    @frees_memory
    def write(batches):
        for batch in batches:
            for path, content, later in zip(*batch.columns):
                refers = {x["place"]: x["refers"] for x in later.as_py() or []}
                yield pa.RecordBatch.from_arrays([pa.array([_converted(path.as_py(), content.as_py(), refers)], pa.binary())], names=["file"])

    write_files(rows.mapInArrow(write, "file binary"), folder)


def _records_of(path: str, content: bytes) -> Iterator[ArcRecord]:
    try:
        yield from arc_records(content)
    except DamagedArchive as error:
        raise DamagedArchive(f"{path}: {error}") from error


def _converted(path: str, content: bytes, refers: dict[int, dict]) -> bytes:
    out = []
    for place, record in enumerate(_records_of(path, content)):
        head, payload, digest, target = _described(record)
        own, date = record_id(path, place, digest), warc_date(record.fields["Archive-date"])
        ip = record.fields["IP-address"]
        about = [("WARC-Record-ID", own), ("WARC-Date", date)]
        if not place:
            info = f"format: WARC File Format 1.0\r\nconverted-from: ARC version {record.version}\r\n".encode()
            name = record.fields["URL"].removeprefix("filedesc://").removesuffix(".gz").removesuffix(".arc") + ".warc.gz"
            out.append(member(warc_record("warcinfo", [*about, ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info)))
            continue
        about += [("WARC-Target-URI", target), ("WARC-IP-Address", None if ip in ("-", "0.0.0.0") else ip),
                  ("WARC-Payload-Digest", _base32(digest))]
        if not head:
            kind, block, more = "resource", payload, [("Content-Type", record.fields["Content-type"])]
        elif place in refers:
            r = refers[place]
            kind, block = "revisit", head
            more = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", r["id"]), ("WARC-Refers-To-Target-URI", r["target"]),
                    ("WARC-Refers-To-Date", r["date"]), (f"{PAGE_HEADER}-Refers-To", None if r["page"] is None else str(r["page"])),
                    ("Content-Type", "application/http; msgtype=response")]
        else:
            kind, block, more = "response", record.body, [("Content-Type", "application/http; msgtype=response")]
        more.append(("WARC-Block-Digest", _base32(hashlib.sha1(block).hexdigest())))
        out.append(member(warc_record(kind, about + more, block)))
    return b"".join(out)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (names in lower case) and block of each record of one WARC file."""
    data, at = plain(data), 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise DamagedArchive(f"no record at byte {at}")
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        stop = end + 4 + int(fields["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise DamagedArchive(f"the record at byte {at} does not have its declared length")
        yield fields, data[end + 4:stop]
        at = stop + 4


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row per response, revisit and resource of the WARC files in ``folder``.

    Columns: ``page_id``, ``payload_bytes`` and ``payload_digest`` (hex) of the full payload, ``record_type``,
    ``refers_to`` (the page a revisit refers to), ``record_id``, ``target``, ``date`` and, if asked for, ``payload`` (null
    for revisits). Digests are checked against the blocks; a file in which one differs raises ``DamagedArchive``.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target", "date"] \
        + ["payload"] * payloads
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.binary()] * payloads

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    @frees_memory
    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                found: list[list] = [[] for _ in names]
                for fields, block in warc_records(content.as_py()):
                    kind = fields["warc-type"]
                    if kind == "warcinfo":
                        continue
                    head, payload = http_parts(block) if kind != "resource" else (b"", block)
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    whole = kind != "revisit"
                    if _base32(hashlib.sha1(block).hexdigest()) != fields["warc-block-digest"] \
                            or whole and hashlib.sha1(payload).hexdigest() != digest:
                        raise DamagedArchive(f"{path.as_py()}: wrong digest of {fields['warc-record-id']}")
                    size = len(payload) if whole else number(head_field(head, "Content-Length"))
                    row = [number(head_field(head, PAGE_HEADER)), size, digest, kind,
                           number(fields.get(f"{PAGE_HEADER}-Refers-To".lower())), fields["warc-record-id"], fields["warc-target-uri"],
                           fields["warc-date"], payload if whole else None]
                    for column, value in zip(found, row):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=names)

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, " \
             "target string, date string" + ", payload binary" * payloads
    return read_files(spark, folder).mapInArrow(run, schema)
