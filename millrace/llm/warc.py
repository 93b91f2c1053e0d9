"""Web archives in ZIP packages: records are written once, then found by the packages' indexes and read by range."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrow import pieces
from millrace.llm.common import null_safe, written
from millrace.llm.zipfiles import Member, content, data_start, directory, read_range
from millrace.session import scratch_path

FILE = "data.warc.gz"
DATA, INDEX, PACKAGE = f"archive/{FILE}", "indexes/index.cdxj", "datapackage.json"
GZIP = b"\x1f\x8b"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The pages carry no date of capture.
DATE = "1970-01-01T00:00:00Z"

RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def name_of(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    """The page of a record's name; null for a record that is none of a numbered page."""
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """One compressed record, and its payload's digest. A revisit holds the HTTP head only."""
    digest = hashlib.sha1(payload).digest()
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "") or name_of(page_id)[1:-1]
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name_of(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", name_of(refers_to))] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush(), digest.hex()


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None, bytes] | None:
    """A record's page, payload size, digest, type, referred page and payload (none for a revisit).

    None for records of other types, such as requests and the description of an archive.
    """
    head, _, rest = (zlib.decompress(data, 31) if data[:2] == GZIP else bytes(data)).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    told = [int(line[15:]) for line in http.decode("latin-1").split("\r\n") if line.lower().startswith("content-length:")]
    size = told[0] if told else len(payload)
    digest = hashlib.sha1(payload).digest()
    if given := fields.get("warc-payload-digest", "").removeprefix("sha1:"):
        given = base64.b32decode(given)
        if kind == "response" and (len(payload) != size or digest != given):
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
        digest = given
    refers = page_of(fields.get("warc-refers-to")) if kind == "revisit" else None
    return page_of(fields["warc-record-id"]), size, digest.hex(), kind, refers, payload


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 256 << 20) -> DataFrame:
    """Writes the records (``page_id``, ``url``, ``html``, ``refers_to``) to packages in ``folder``; gives their paths.

    Each task writes packages of its own, of about ``archive_bytes``; a repeated task writes others, and only those
    of the task that came through are named in the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        paths: list[str] = []
        parts = (part for batch in batches for part in pieces(batch, "html"))
        rows = (row for part in parts for row in zip(*(c.to_pylist() for c in part.columns)))
        row = next(rows, None)
        while row is not None:
            name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.wacz"
            index, size = [], 0
            with store.open_output_stream(f"{base}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                with package.open(DATA, "w", force_zip64=True) as member:
                    while row is not None and size < archive_bytes:
                        page_id, url, html, refers_to = row
                        data, digest = record(page_id, url, (html or "").encode(), refers_to)
                        member.write(data)
                        entry = {"url": url, "digest": f"sha1:{digest}", "filename": FILE, "offset": size, "length": len(data)}
                        index.append(f"{name_of(page_id)} {DATE} {json.dumps(entry)}\n")
                        size += len(data)
                        row = next(rows, None)
                with package.open(INDEX, "w", force_zip64=True) as member:
                    member.writelines(line.encode() for line in index)
                package.writestr(PACKAGE, json.dumps({"profile": "data-package", "resources": [DATA, INDEX]}))
            paths.append(name)
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{p}" for p in paths], pa.string())], names=["path"])

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string")


def walked(file, begin: int, size: int, piece: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(offset, length) of the compressed records of an archive that no index names, by going through it."""
    here, at, data = 0, 0, b""
    while here < size:
        packer = zlib.decompressobj(31)
        while not packer.eof:
            if not data:
                if at >= size:
                    raise ValueError("the last record of an archive is not whole")
                data = read_range(file, begin + at, min(piece, size - at))
                at += len(data)
            packer.decompress(data)
            data = packer.unused_data
        end = at - len(data)
        yield here, end - here
        here = end


def records_of(file, members: dict[str, Member]) -> Iterator[tuple[int, int]]:
    """(place in the package, length) of the records of all archives, archive by archive, each once.

    Archives are stored members of the folder ``archive``, indexes members of ``indexes``, packed or not. An index
    line names its archive, or, where there is but one, may leave the name out.
    """
    archives = {n.rpartition("/")[2]: m for n, m in members.items() if n.startswith("archive/") and n.endswith((".warc.gz", ".warc"))}
    entries: dict[str, dict[int, int]] = {name: {} for name in archives}
    for name, member in members.items():
        if not name.startswith("indexes/") or ".cdx" not in name:
            continue
        lines = content(file, member)
        for line in (gzip.decompress(lines) if lines[:2] == GZIP else lines).splitlines():
            found = re.search(rb"\{.*\}\s*$", line)
            if found is None:  # a heading
                continue
            entry = json.loads(found[0])
            of = entry.get("filename", "").rpartition("/")[2] or (next(iter(archives)) if len(archives) == 1 else "")
            if of not in entries:
                raise ValueError(f"{name} names the archive {of or '(none)'}, which is not in the package")
            entries[of][int(entry["offset"])] = int(entry["length"])
    for name, member in archives.items():
        start = data_start(file, member)
        for offset, length in sorted(entries[name].items()) or walked(file, start, member.size):
            yield start + offset, length


def read_archives(paths: DataFrame, run_bytes: int = 8 << 20) -> DataFrame:
    """Every page record of the packages named in ``path``, by range reads of their indexes and stored archives.

    A package may hold several archives and indexes; an archive without index lines is gone through once. Records lie
    in runs of about ``run_bytes`` without gaps, which are dealt evenly to as many tasks, so a large package is read by
    many. The runs are written first: their number decides how many tasks there are.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                begins, lengths, held, end = [], [], 0, None
                with store.open_input_file(place) as file:
                    for begin, length in records_of(file, directory(file, file.size())):
                        if begin != end or held >= run_bytes:
                            begins.append(begin), lengths.append([])
                            held = 0
                        lengths[-1].append(length)
                        held, end = held + length, begin + length
                columns = [pa.array([path] * len(begins), pa.string()), pa.array(begins, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(lengths, pa.list_(pa.int64()))], names=["path", "start", "lengths"]
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    data = memoryview(read_range(file, start, sum(lengths)))
                columns: tuple[list, ...] = ([], [], [], [], [])
                here = 0
                for length in lengths:
                    for column, value in zip(columns, parse(data[here : here + length]) or ()):
                        column.append(value)
                    here += length
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in RECORD.split(", ")]
                )

    runs = written(paths.mapInArrow(locate, "path string, start long, lengths array<long>"), "archive-runs")
    return runs.repartition(max(1, runs.count())).mapInArrow(read, RECORD)


def revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Which pages (by id and digest) revisit which: the largest id among equal payloads of ``least_bytes`` or more."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    facts = pages.select("page_id", F.sha1(payload).alias("digest"), F.length(payload).alias("bytes")).filter(
        F.col("bytes") >= least_bytes
    )
    target = facts.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    same = facts.select("page_id", "digest").distinct().join(target.drop("n"), "digest")
    return same.filter(F.col("page_id").isNull() | (F.col("page_id") != F.col("refers_to")))


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes a record per page to packages in ``folder`` (by default a new one in the shared folder) and reads them back.

    The payload is the html in UTF-8, a null one empty. Among equal payloads of at least 1000 bytes the largest
    page_id is a response and the others are revisits of it; all smaller ones are responses. Rows that repeat a
    page_id have a record each, of the same kind; a null page_id never is the one referred to. A null or odd url gets
    a target of its own. Only digests are grouped; a page's html moves once.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    of = revisits(pages).select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to")
    known = pages.withColumn("digest", F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")))
    both = known.join(of, null_safe(known, of, [("page_id", "_page")]) & (known["digest"] == of["_digest"]), "left")
    where = folder or scratch_path(spark, "archives")
    return read_archives(written(write_archives(both, where), "archive-paths"))


SQL = """
WITH facts AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
latest AS (SELECT payload_digest, max(page_id) AS last_id FROM facts WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN last_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN last_id <> page_id THEN last_id END AS refers_to
FROM facts LEFT JOIN latest USING (payload_digest)
"""
