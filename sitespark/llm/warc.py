"""WARC archives: writing with revisit records for repeated payloads, and reading with revisits resolved."""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, blocks

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed, so that the same table always gives the same bytes.
DATE = "2000-01-01T00:00:00Z"


def record(kind: str, key: str, uri: str, digest: str, payload: bytes, refers_to: str | None = None, refers_uri: str | None = None, date: str = DATE) -> bytes:
    """One WARC/1.1 record, a gzip member of its own. A revisit keeps the digest of the payload it leaves out."""
    block = b"" if kind == "revisit" else payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{key}>"), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Refers-To-Target-URI", refers_uri or ""), ("WARC-Refers-To-Date", date)]
    head += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(block)))]
    plain = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(plain.encode() + block + b"\r\n\r\n", 3, mtime=0)


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record of a WARC stream, gzipped or plain."""
    start = stream.read(2)
    stream.seek(0)
    f = io.BufferedReader(gzip.GzipFile(fileobj=stream)) if start == b"\x1f\x8b" else stream
    while line := f.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        head = {}
        while (line := f.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        block = f.read(size := int(head["content-length"]))
        if len(block) != size:
            raise ValueError(f"record {head.get('warc-record-id')} is cut short")
        yield head, block


def clean_uri(uri: str | None) -> str:
    """A header value can't hold control characters: they are percent-encoded."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in uri or "")


HEADER = pa.schema([("path", pa.string()), ("place", pa.int64()), ("id", pa.int64()), ("uri", pa.string()), ("digest", pa.string()), ("length", pa.int64())])


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", roll_bytes: int = 1 << 26) -> DataFrame:
    """Write every page as a response record, one .warc.gz per roll_bytes of a task: path, place, id, uri, digest, length.

    A file gets a new name in each attempt of a task and is listed only by the attempt that succeeds, so that a lost
    executor or a speculative copy leaves files nobody reads. The result must be written before it is used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        out, path, size, place = None, "", 0, 0
        for batch in blocks(batches, 200):
            rows = []
            for key, uri, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    path, size, place = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                payload, uri = (text or "").encode(), clean_uri(uri)
                digest = hashlib.sha256(payload).hexdigest()
                data = record("response", "" if key is None else str(key), uri, digest, payload)
                out.write(data)
                rows.append((path, place, key, uri, digest, len(payload)))
                size, place = size + len(data), place + 1
                if size >= roll_bytes:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), HEADER.types, strict=True)], schema=HEADER)
        if out is not None:
            out.close()

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("uri"), F.col(payload_col).cast("string").alias("payload"))
    return rows.mapInArrow(run, "path string, place long, id long, uri string, digest string, length long")


def revisits(headers: DataFrame, least_bytes: int) -> DataFrame:
    """Headers with `original` and `original_uri`: the response that a record is a revisit of, or null.

    Only headers are shuffled: the least id of each digest is found with map-side minima, digests that occur once leave
    before the join, and AQE can split the join's hot digests.
    """
    first = headers.filter(F.col("length") >= least_bytes).groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "uri")).alias("first"), F.count(F.lit(1)).alias("copies"))
    first = first.filter("copies > 1 AND first.id IS NOT NULL").select("digest", F.col("first.id").alias("original"), F.col("first.uri").alias("original_uri"))
    out = headers.join(first, "digest", "left")
    again = ~F.col("original").eqNullSafe(F.col("id")) & F.col("original").isNotNull()
    return out.withColumn("original", F.when(again, F.col("original"))).withColumn("original_uri", F.when(again, F.col("original_uri")))


def deduplicate_archives(decided: DataFrame, source: str, folder: str) -> DataFrame:
    """Rewrite archives with fresh headers: responses keep their payload, revisits refer to theirs. path, records, bytes.

    The decisions of a file meet its payloads where the file is read, so payloads are never shuffled.
    """

    def run(table: pa.Table) -> pa.Table:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        rows = table.to_pylist()
        old, path, size = rows[0]["path"], f"{root}/{uuid.uuid4().hex}.warc.gz", 0
        said = {r["place"]: r for r in rows}
        with fs.open_input_file(old) as f, fs.open_output_stream(path, compression=None) as out:
            for place, (head, block) in enumerate(records(f)):
                r = said[place]
                data = record("response" if r["original"] is None else "revisit", "" if r["id"] is None else str(r["id"]), head["warc-target-uri"], r["digest"], block, r["original"], r["original_uri"])
                out.write(data)
                size += len(data)
        return pa.table([pa.array([path]), pa.array([len(rows)], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

    return decided.groupBy("path").applyInArrow(run, "path string, records long, bytes long")


def read_archives(files: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the listed files: id, record_type, uri, digest, refers_to, length, payload (null for revisits).

    A response's digest is checked against its payload; a mismatch or a file cut short is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pyarrow.fs.FileSystem.from_uri(folder)
        schema = pa.schema([("id", pa.int64()), ("record_type", pa.string()), ("uri", pa.string()), ("digest", pa.string()), ("refers_to", pa.int64()), ("length", pa.int64()), ("payload", pa.binary())])

        def number(text):
            digits = (text or "").removeprefix("<urn:page:").removesuffix(">")
            return int(digits) if digits else None

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with fs.open_input_file(path) as f:
                    for head, block in records(f):
                        digest, kind = head["warc-payload-digest"].partition(":")[2], head["warc-type"]
                        if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                            raise ValueError(f"{head['warc-record-id']}: the payload doesn't have its digest")
                        response = kind == "response"
                        rows.append((number(head["warc-record-id"]), kind, head["warc-target-uri"], digest, number(head.get("warc-refers-to")), len(block) if response else None, block if response and payloads else None))
                        if len(rows) == 200:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    return files.select("path").repartition(files.sparkSession.sparkContext.defaultParallelism, F.rand(7)).mapInArrow(run, "id long, record_type string, uri string, digest string, refers_to long, length long, payload binary")


def resolve_revisits(found: DataFrame) -> DataFrame:
    """Records with the length of the full payload: a revisit takes it from the response it refers to, by digest."""
    originals = found.filter("record_type = 'revisit'").select("digest").distinct()
    originals = found.filter("record_type = 'response'").join(originals, "digest", "left_semi").groupBy("digest").agg(F.max("length").alias("full"))
    return found.join(originals, "digest", "left").withColumn("length", F.coalesce("length", "full")).drop("full")


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 100) -> DataFrame:
    """Write deduplicated archives of pages to the shared folder and read them back: id, record_type, uri, digest,
    refers_to, length.

    Payloads are UTF-8, null as empty. Of records with equal payloads of least_bytes or more, that with the least id is
    a response and the others are revisits of it; smaller payloads are always responses. A null id gives a record
    without a number and is never an original; if all ids of a payload are null, all are responses; rows that repeat an id with the same payload are all responses if it is the least. Other columns are ignored; an
    empty table writes nothing.
    """
    work = Work(pages.sparkSession, "warc")
    headers = work.save("headers", write_archives(pages, work.path("responses"), id_col, url_col, payload_col))
    files = work.save("files", deduplicate_archives(revisits(headers, least_bytes), work.path("responses"), work.path("archives")))
    work.drop("responses")
    found = work.save("records", read_archives(files, work.path("archives"), payloads=False).drop("payload"))
    return resolve_revisits(found)
