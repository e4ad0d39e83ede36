"""WARC archives: write with an index, then read selected records by coalesced byte ranges.

Writing: each task writes its rows to archives of its own in the shared folder, one gzip member per
record, and returns an index row for each: archive, offset, length, url and digest. The index is
stored as a table before anything reads it, so only archives of tasks that committed are ever named
in it; what a lost attempt left behind is never read. Payloads that repeat are decided before, by
grouping digests and lengths only.

Reading: index rows are dealt by stretches of an archive, to as many tasks as their bytes need, and sorted by offset; ranges whose gap is
small merge into one read of bounded size. Payload digests are checked against the headers.

Defined cases: null html is an empty payload; a null url leaves the target header out; line breaks and
spaces of a url are percent-encoded in the header and kept in the index; rows that share the largest
page_id of a group of equal payloads are all responses; a null page_id is written as none and, if all
of a group are null, all are responses; an empty table gives an empty index. Other columns are not
carried.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import materialise, shared_dir, small, table

#: Smaller payloads are never revisits.
REVISIT_BYTES = 1000
#: A task goes on to a new archive beyond so many bytes.
ARCHIVE_BYTES = 256 << 20
#: Ranges closer than the gap merge, up to the read size.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: Bytes of archives that a task reads, about.
TASK_BYTES = 4 * READ_BYTES
_DATE = "2024-01-01T00:00:00Z"

INDEX = "page_id long, archive string, offset long, length long, url string, digest string"
_INDEX = pa.schema([("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string())])
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, refers_to`` (null: a response)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    pages = pages.withColumn("digest", F.sha1("html"))
    large = pages.where(F.octet_length("html") >= REVISIT_BYTES)
    same = large.groupBy("digest").agg(F.count("*").alias("_n"), F.max("page_id").alias("_first"))
    # few beside the pages: where they are small in fact, pages stay where they are
    same = materialise(same.where("_n > 1 AND _first IS NOT NULL").select(F.col("digest").alias("_digest"), "_first"), "same-payloads")
    same = small(same, F.octet_length("_digest"))
    on = (F.col("digest") == F.col("_digest")) & (F.octet_length("html") >= REVISIT_BYTES)
    planned = pages.join(same, on, "left")
    return planned.select("page_id", "url", "html", "digest", F.when(F.col("page_id").eqNullSafe(F.col("_first")), None).otherwise(F.col("_first")).alias("refers_to"))


def _record(page_id, url, html: bytes, digest: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + html
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").replace(" ", "%20"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _gzip(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write_archives(planned: DataFrame, folder: str) -> DataFrame:
    """The index of the archives that it writes to ``folder``; store it before use."""

    def write(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in source:
            rows = []
            for a in range(0, batch.num_rows, 500):
                for row in batch.slice(a, 500).to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                    member = _gzip(_record(row["page_id"], row["url"], row["html"].encode(), row["digest"], row["refers_to"]))
                    out.write(member)
                    rows.append((row["page_id"], name, at, len(member), row["url"], row["digest"]))
                    at += len(member)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _INDEX, strict=True)] if rows else [pa.array([], f.type) for f in _INDEX], schema=_INDEX)
        if out is not None:
            out.close()

    return planned.mapInArrow(write, INDEX)


def _parse(record: bytes) -> dict[str, str | bytes]:
    """Headers by lower-case name, ``http-length`` and ``payload``."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    found: dict[str, str | bytes] = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(found["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record doesn't end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    found["http-length"] = next(x[16:].decode() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: "))
    found["payload"] = payload
    return found


def _coalesce(rows: list[tuple[int, int]], gap: int, most: int) -> Iterator[list[tuple[int, int]]]:
    """Runs of sorted ``(offset, length)`` that one read covers."""
    run: list[tuple[int, int]] = []
    for offset, length in rows:
        if run and (offset - sum(run[-1]) > gap or offset + length - run[0][0] > most):
            yield run
            run = []
        run.append((offset, length))
    if run:
        yield run


def read_records(index: DataFrame, folder: str, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the index's records, as the archives say."""
    number = lambda x: None if x.endswith(":none>") else int(x.rpartition(":")[2][:-1])

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in source:
            of: dict[str, list[tuple[int, int]]] = {}
            for name, offset, length in zip(*(batch[c].to_pylist() for c in ("archive", "offset", "length")), strict=True):
                of.setdefault(name, []).append((offset, length))
            rows = []
            for name, wanted in of.items():
                with files.open_input_file(f"{base}/{name}") as archive:
                    for run in _coalesce(wanted, gap, most):
                        data = archive.read_at(sum(run[-1]) - run[0][0], run[0][0])
                        for offset, length in run:
                            at = offset - run[0][0]
                            got = _parse(zlib.decompress(data[at : at + length], 31))
                            digest = got["warc-payload-digest"].removeprefix("sha1:")
                            if got["warc-type"] == "response" and hashlib.sha1(got["payload"]).hexdigest() != digest:
                                raise ValueError(f"{name} at {offset}: the payload isn't what its digest says")
                            rows.append((number(got["warc-record-id"]), int(got["http-length"]), digest, got["warc-type"], number(got["warc-refers-to"]) if "warc-refers-to" in got else None))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RECORDS, strict=True)] if rows else [pa.array([], f.type) for f in _RECORDS], schema=_RECORDS)

    # tasks by the bytes that they read, of which the index's own size says nothing
    total = index.agg(F.sum("length")).first()[0] or 0
    wanted = index.select("archive", "offset", "length").withColumn("_stretch", F.floor(F.col("offset") / (2 * most)))
    wanted = wanted.repartition(max(1, -(-total // TASK_BYTES)), "archive", "_stretch").sortWithinPartitions("archive", "offset")
    return wanted.select("archive", "offset", "length").mapInArrow(read, RECORDS)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    index = materialise(write_archives(plan_records(table(spark, sf_dir, "pages")), folder), "warc-index")
    return read_records(index, folder)


OP4_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
q AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, digest AS payload_digest,
        CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS lead_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = lead_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead_id THEN lead_id END AS refers_to FROM q
"""
