"""Legacy archive converter: ARC records become WARC records.

An ARC file opens with a version block, whose first field gives the version: 1 has
five fields a header line (URL, IP address, archive date, content type, length), 2 has
ten (URL, IP address, archive date, content type, result code, checksum, location,
offset, file name, length). Declared lengths alone delimit content. Fields are read from the
right, as URLs of real files hold spaces.

A WARC record gets a record id derived from file, offset, URL and date, an ISO date from the
14 digits, a type (warcinfo for the version block, response where there is an HTTP head, revisit
where an earlier record has the same payload, else resource), and SHA-256 digests of block and
payload. What cannot be read is quarantined with its file and offset, and reading goes on at
the next line that is a header line whose length fits.

Payloads do not move: digests and ids meet in a table of a few bytes a record, and only which
record revisits which comes back, broadcast after it is counted or joined by the id.

Defined cases: a null payload is empty; empty URLs and dates are ``-`` in ARC and
left out of WARC; a page without id is a response and revisits nothing; of rows with one id and
payload all are responses or all revisit the same page; payloads of any bytes and
length round-trip; an empty table or file gives no records; extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import scratch, settle, ship

FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
#: The URL-record definitions of the format's two versions.
DEFINITIONS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT = 100


def _clean(x: str | None) -> str:
    return re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", x or "") or "-"


def arc_file(records: list[dict], version: int = 1, name: str = "pages.arc") -> bytes:
    """An ARC file of records with ``url, ip, date, mime, status`` and ``content``."""
    head = f"{version} 0 converter\n{DEFINITIONS[version]}\n\n".encode()
    out = io.BytesIO()
    first = f"filedesc://{name} 0.0.0.0 19960101000000 text/plain" + (" 200 - - 0 " + name if version == 2 else "")
    out.write(f"{first} {len(head)}\n".encode() + head + b"\n")
    for r in records:
        line = [_clean(r.get("url")), r.get("ip") or "0.0.0.0", r.get("date") or "-", r.get("mime") or "text/html"]
        if version == 2:
            line += [str(r.get("status", 200)), "-", "-", str(out.tell()), name]
        out.write(" ".join([*line, str(len(r["content"]))]).encode() + b"\n" + r["content"] + b"\n")
    return out.getvalue()


def _header(data: bytes, at: int, version: int) -> tuple[dict | None, int]:
    """Fields of the header line at ``at``, None if it is none, and where the line ends."""
    end = data.find(b"\n", at)
    end = len(data) if end < 0 else end
    line = data[at:end].decode("utf-8", "replace").rstrip("\r").rsplit(" ", len(FIELDS[version]) - 1)
    record = dict(zip(FIELDS[version], line, strict=False))
    good = len(line) == len(FIELDS[version]) and re.fullmatch(r"\d{1,15}", record["length"]) and re.fullmatch(r"-|\d{4,14}", record["date"]) and record["url"]
    return (record if good else None), end


def read_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file, plain or gzipped, by its own version's header lines.

    The version block comes first, as a record of mime ``filedesc``. What is none has
    ``error`` and ``at`` alone.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    if not data:
        return
    length = re.match(rb"filedesc:[^\n]* (\d+)\r?\n([12]) ", data)
    if not length:
        yield {"at": 0, "error": f"no version block: {data[:60]!r}"}
        return
    version, after = int(length[2]), data.find(b"\n") + 1
    at = after + int(length[1])
    yield {"at": 0, "url": data.split(b" ", 1)[0].decode("utf-8", "replace"), "ip": "0.0.0.0", "date": "-", "mime": "filedesc", "version": version, "content": data[after:at]}
    lost = False
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        record, end = _header(data, at, version)
        stop = end + 1 + int(record["length"]) if record else 0
        if not record or stop > len(data) or (lost and data[stop : stop + 1] not in (b"", b"\n", b"\r")):
            if not lost:
                line = data[at : min(end, at + 200)]
                yield {"at": at, "error": f"declares {record['length']} bytes past the end: {line!r}" if record else f"no header line of version {version}: {line!r}"}
            lost, at = True, end + 1
            continue
        lost = False
        yield record | {"version": version, "at": at, "content": data[end + 1 : stop]}
        at = stop


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """Response head with its blank line, and payload; no head where none is."""
    if content.startswith(b"HTTP/"):
        end = content.find(b"\r\n\r\n")
        if end >= 0:
            return content[: end + 4], content[end + 4 :]
    return b"", content


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def warc_date(digits: str) -> str | None:
    m = re.fullmatch(r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)", digits)
    return "{}-{}-{}T{}:{}:{}Z".format(*m.groups()) if m else None


def warc_record(arc: dict, rid: str, original: dict | None = None, extra: dict | None = None) -> bytes:
    """The WARC record of an ARC record. ``original`` (``id, uri, date``) is what it revisits."""
    head, payload = split_http(arc["content"])
    block = head if original else arc["content"]
    info = arc["mime"] == "filedesc"
    fields = {
        "WARC-Type": "warcinfo" if info else "revisit" if original else "response" if head else "resource",
        "WARC-Record-ID": rid,
        "WARC-Date": warc_date(arc["date"]) or "1996-01-01T00:00:00Z",
        "WARC-Filename": arc["url"].removeprefix("filedesc://") if info else None,
        "WARC-Target-URI": None if info or arc["url"] == "-" else arc["url"],
        "WARC-IP-Address": None if info else arc["ip"],
        "WARC-Block-Digest": "sha256:" + hashlib.sha256(block).hexdigest(),
        "WARC-Payload-Digest": "sha256:" + hashlib.sha256(payload).hexdigest(),
        **({"WARC-Refers-To": original["id"], "WARC-Refers-To-Target-URI": original.get("uri"), "WARC-Refers-To-Date": original.get("date"), "WARC-Profile": PROFILE} if original else {}),
        "Content-Type": "application/http; msgtype=response" if head else "text/plain" if info else arc["mime"],
        **(extra or {}),
        "X-Payload-Bytes": len(payload),
        "Content-Length": len(block),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def read_warc(stream) -> Iterator[tuple[dict, bytes]]:
    """Fields and block of each record of a binary stream."""
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            fields[name.decode().lower()] = value.strip().decode("utf-8", "replace")
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"WARC record {fields.get('warc-record-id')} ends early")
        yield fields, block


def revisits(held: DataFrame, key: list[str], first: Column) -> DataFrame:
    """``key, digest, original``: records whose payload an earlier one has.

    ``held`` has the key, ``digest`` and the payload's length ``n``; ``first`` orders records.
    A digest that a third of all records share meets one row for it here, never a payload.
    """
    large = held.where(F.col("n") >= MIN_REVISIT)
    least = large.groupBy("digest").agg(F.min(first).alias("original"), F.max(first).alias("_last")).where("original < _last").drop("_last")
    return large.join(least, "digest").where(first != F.col("original")).select(*key, "digest", "original").distinct()


def _small(marks: DataFrame, most_broadcast: int) -> DataFrame:
    return F.broadcast(marks) if marks.count() <= most_broadcast else marks


def _converted(batches):
    """Pages to ARC, versions in turn, and by the converter to WARC records."""
    for k, batch in enumerate(batches):
        ids, urls, payloads, firsts = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "original"))
        arc = arc_file([{"url": u, "date": "20240101000000", "content": b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (p or b"")} for u, p in zip(urls, payloads, strict=True)], 1 + k % 2)
        records = list(read_arc(arc))[1:]
        out = [warc_record(r, record_id("page", i), {"id": record_id("page", o)} if o is not None else None, {"X-Page-Id": i, "X-Refers-To-Page": o}) for r, i, o in zip(records, ids, firsts, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_warc(pages: DataFrame, path: str, file_bytes: int = 256 << 20, most_broadcast: int = 200_000) -> None:
    """One record per row, in gzipped WARC files of at most ``file_bytes`` before compression.

    (A longer payload has a file of its own.) Spark's text writer puts the separator after
    each record, which is what ends a WARC record, so any store that Spark writes to can
    hold the files. Up to ``most_broadcast`` revisits (48 bytes each) are broadcast, more are
    joined by page.
    """
    ship(pages.sparkSession)
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload"), F.unhex(F.sha2(body, 256)).alias("digest"))
    held = settle(rows.select("page_id", "digest", F.octet_length("payload").alias("n")), "pages")
    marks = settle(revisits(held.where("page_id is not null"), ["page_id"], F.col("page_id")), "revisits")
    longest = held.agg(F.max("n")).first()[0] or 0
    marked = rows.join(_small(marks, most_broadcast), ["page_id", "digest"], "left").select("page_id", "url", "payload", "original")
    records = marked.mapInArrow(_converted, "record binary").select(F.col("record").cast("string").alias("value"))
    per_file = max(1, min(5000, file_bytes // (longest + 2048)))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).mode("overwrite").text(path)


def _number(x: str | None) -> int | None:
    return int(x) if x is not None else None


def _read(batches):
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri", "warc_date"]
    for batch in batches:
        for content in batch.column("content"):
            data = content.as_py()
            stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
            out: list[list] = [[] for _ in kinds]
            for f, block in read_warc(stream):
                digest = f["warc-payload-digest"].partition(":")[2]
                size = int(f["x-payload-bytes"])
                if f["warc-type"] != "revisit":
                    _, payload = split_http(block)
                    if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                        raise ValueError(f"payload of {f['warc-record-id']} differs from its digest")
                row = (_number(f.get("x-page-id")), size, digest, f["warc-type"], _number(f.get("x-refers-to-page")), f["warc-record-id"], f.get("warc-target-uri"), f["warc-date"])
                for x, v in zip(out, row, strict=True):
                    x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names)


def read_archives(spark, path: str) -> DataFrame:
    """One row per record of the WARC files under ``path``, payloads checked."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string, warc_date string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives into the shared folder and reads them back."""
    path = scratch(pages.sparkSession, "warc")
    write_warc(pages, path)
    return read_archives(pages.sparkSession, path)


PARSED = pa.schema([("file", pa.string()), ("at", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("content", pa.binary()), ("digest", pa.binary()), ("n", pa.int64()), ("error", pa.string())])


def _arc_rows(batches):
    """Records of whole files; one file is in memory at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            file, rows, size = batch.column("path")[i].as_py(), [], 0
            for r in read_arc(batch.column("content")[i].as_py()):
                if "error" not in r:
                    payload = split_http(r["content"])[1]
                    r |= {"digest": hashlib.sha256(payload).digest(), "n": 0 if r["mime"] == "filedesc" else len(payload)}
                rows.append({"file": file} | {c: r.get(c) for c in PARSED.names if c != "file"})
                size += r.get("n") or 0
                if size > 16 << 20:
                    yield pa.RecordBatch.from_pylist(rows, PARSED)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, PARSED)


def _warc_rows(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            o = r["original"]
            name = lambda x: record_id(x["file"].rsplit("/", 1)[-1], x["at"], x["url"], x["date"])
            out.append({"file": r["file"], "at": r["at"], "record": warc_record(r, name(r), {"id": name(o), "uri": None if o["url"] == "-" else o["url"], "date": warc_date(o["date"])} if o else None)})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("file", pa.string()), ("at", pa.int64()), ("record", pa.binary())]))


def convert_arc_files(spark, path: str, most_broadcast: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """Records of the ARC files under ``path`` as ``file, at, record``, and the quarantine ``file, at, error``.

    A payload is a revisit of the earliest record with the same, by date, file and offset.
    Files are read whole, as ARC files are of some 100 MB; ``binaryFile`` stops at 2 GB.
    """
    ship(spark)
    kinds = "file string, at long, url string, ip string, date string, mime string, content binary, digest binary, n long, error string"
    rows = settle(spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_arc_rows, kinds), "arc")
    good = rows.where("error is null")
    first = F.struct("date", "file", "at", "url")
    marks = settle(revisits(good.select("file", "at", "date", "url", "digest", "n"), ["file", "at"], first), "revisits").drop("digest")
    marked = good.join(_small(marks, most_broadcast), ["file", "at"], "left").select("file", "at", "url", "ip", "date", "mime", "content", "original")
    return marked.mapInArrow(_warc_rows, "file string, at long, record binary"), rows.where("error is not null").select("file", "at", "error")
