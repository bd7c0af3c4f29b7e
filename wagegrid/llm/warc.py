"""WARC archives written from and read into a table of payload chunks.

No record is ever held whole.  A payload is streamed as rows (record, chunk number) of at
most ``CHUNK_BYTES`` bytes; every row carries the digest of the payload up to its end, so that
the last one has the digest of all.  An archive holds a payload of one chunk as one response
record, a longer one as a first segment and continuation records, which may stand in other
archives.  Equal payloads are stored once, the other records revisit that response.

Tasks write archives below names of their own and report them in a manifest; files of an
attempt that was lost are in no manifest.  Every record is a gzip member of its own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm.common import looked_up

#: Bytes of payload in a chunk.
CHUNK_BYTES = 1 << 20
#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 1 << 28
#: Bytes of chunks in one Arrow batch, and rows.
_BATCH_BYTES, _BATCH_ROWS = 8 << 20, 5_000

#: The address of the profile for payloads that are the same.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_CHUNKS = "url string, record long, chunk int, last boolean, data binary, total long, digest string"
_RECORDS = (
    "record_id string, record_type string, page_id string, url string, segment int, part int, last boolean, "
    "data binary, total long, digest string, refers_to string, stated_bytes long, stated_digest string"
)


def base32(sha1: hashlib._Hash) -> str:
    return base64.b32encode(sha1.digest()).decode()


class _Rows:
    """Collects rows and hands them on as record batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.held = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.held += size
        if self.held >= _BATCH_BYTES or len(self.rows) >= _BATCH_ROWS:
            yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
        self.rows, self.held = [], 0


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def chunk_table(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """page_id, url, record, chunk, last, data, total, digest: the payloads in chunks.

    ``record`` numbers the rows of ``pages``, ``chunk`` counts from 0, ``total`` and ``digest``
    (base32 SHA-1) cover the payload up to the end of the chunk.  Texts are UTF-8; a null
    or empty payload is one empty chunk.  Ids are held as text.
    """
    rows = pages.select(
        F.col(id_col).cast("string").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.monotonically_increasing_id().alias("record"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("data"),
    )
    schema = _arrow(f"page_id string, {_CHUNKS}")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        for batch in batches:
            ids, urls, records = (batch.column(c).to_pylist() for c in ("page_id", "url", "record"))
            payloads = batch.column("data")
            for i, (page, url, record) in enumerate(zip(ids, urls, records, strict=True)):
                data = memoryview(payloads[i].as_buffer())
                sha1 = hashlib.sha1()
                for number, at in enumerate(range(0, max(len(data), 1), chunk_bytes)):
                    part = data[at : at + chunk_bytes]
                    sha1.update(part)
                    end = at + len(part)
                    row = (page, url, record, number, end == len(data), bytes(part), end, base32(sha1))
                    yield from out.add(row, len(part))
        yield from out.out()

    return rows.mapInArrow(cut, f"page_id string, {_CHUNKS}")


def record_roles(heads: DataFrame, kind: str, least_bytes: int = 0) -> DataFrame:
    """``heads`` (the last chunks) with ``first``: null for responses, else the record revisited.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest
    id (as ``kind``; null is the smallest), then record number, is the response.
    """
    typed = heads.withColumn("key", F.concat_ws("/", "digest", "total"))
    best = F.max(F.struct(F.col("page_id").cast(kind).alias("id"), F.col("record"), F.col("page_id"))).alias("best")
    groups = typed.where(F.col("total") >= least_bytes).groupBy("key").agg(best, F.count("*").alias("n")).where("n > 1")
    groups = settings.written(groups.select("key", "best.record", "best.page_id").toDF("key", "first", "first_page"), "warc-groups")
    found = looked_up(typed, groups, "key", F.col("record"), how="left").drop("key")
    again = F.col("first") != F.col("record")
    return found.withColumns({c: F.when(again, F.col(c)) for c in ("first", "first_page")})


def _uri(page: str | None, record: int, segment: int | None = None) -> str:
    return f"urn:page:{quote(page or '', safe='')}:{record}" + ("" if segment is None else f":{segment}")


def _member(fields: dict[str, str], *block: bytes) -> bytes:
    """One record as a gzip member."""
    size = sum(map(len, block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    made = zlib.compressobj(level=4, wbits=31)
    parts = [f"WARC/1.1\r\n{lines}Content-Length: {size}\r\n\r\n".encode(), *block, b"\r\n\r\n"]
    return b"".join([made.compress(p) for p in parts] + [made.flush()])


def _record(row: dict, date: str) -> bytes:
    """The record of a chunk, or of a revisit."""
    own = _uri(row["page_id"], row["record"])
    url = quote(row["url"], safe=":/?#[]@!$&'()*+,;=%~") if row["url"] else own
    fields = {"WARC-Type": "response", "WARC-Record-ID": f"<{own}>", "WARC-Date": date, "WARC-Target-URI": url}
    if row["data"] is None:
        fields |= {
            "WARC-Type": "revisit", "WARC-Refers-To": f"<{_uri(row['first_page'], row['first'])}>",
            "WARC-Profile": REVISIT_PROFILE, "WARC-Payload-Digest": f"sha1:{row['digest']}",
            # a field of our own, as a revisit has no payload
            "X-Payload-Length": str(row["total"]), "Content-Type": "application/http; msgtype=response",
        }
        return _member(fields, _HTTP)
    number, last, data = row["chunk"], row["last"], row["data"]
    block = (_HTTP, data) if number == 0 else (data,)
    if number:
        fields |= {
            "WARC-Type": "continuation", "WARC-Record-ID": f"<{_uri(row['page_id'], row['record'], number + 1)}>",
            "WARC-Segment-Origin-ID": f"<{own}>",
        }
    if number or not last:
        fields["WARC-Segment-Number"] = str(number + 1)
    if number and last:
        fields["WARC-Segment-Total-Length"] = str(len(_HTTP) + row["total"])
    if last:
        fields["WARC-Payload-Digest"] = f"sha1:{row['digest']}"
    sha1 = hashlib.sha1()
    for part in block:
        sha1.update(part)
    fields["WARC-Block-Digest"] = f"sha1:{base32(sha1)}"
    if number == 0:
        fields["Content-Type"] = "application/http; msgtype=response"
    return _member(fields, *block)


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a folder or file."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *,
    least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes one record per row of ``pages`` below ``folder``; the manifest: path, records, bytes.

    Payloads of fewer than ``least_bytes`` bytes are always stored.  Rows that share an id are
    records of their own.  Columns other than the three are not looked at; an empty table
    has an empty manifest.  ``date`` stands in every record, as pages have none.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    chunks = settings.written(chunk_table(pages, id_col, url_col, payload_col, chunk_bytes), "warc-chunks")
    roles = settings.written(record_roles(chunks.where("last").drop("data", "last"), kind, least_bytes), "warc-roles")
    revisits = roles.where("first IS NOT NULL")
    none = {"first": F.lit(None).cast("long"), "first_page": F.lit(None).cast("string")}
    stored = chunks.join(settings.small_side(revisits.select("record")), "record", "left_anti").withColumns(none)
    also = revisits.withColumns({"data": F.lit(None).cast("binary"), "last": F.lit(True)})
    schema = "path string, records long, bytes long"

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _opened(folder)
        system.create_dir(base, recursive=True)
        held, path, records, size, out = None, None, 0, 0, _Rows(_arrow(schema))
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if held is None:
                        name = f"pages-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                        path, records, size = f"{folder.rstrip('/')}/{name}", 0, 0
                        held = system.open_output_stream(f"{base}/{name}", compression=None)
                        info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<{uuid.uuid4().urn}>", "WARC-Date": date,
                                "WARC-Filename": name, "Content-Type": "application/warc-fields"}
                        held.write(_member(info, b"format: WARC File Format 1.1\r\n"))
                    member = _record(row, date)
                    held.write(member)
                    records, size = records + 1, size + len(member)
                    if size >= archive_bytes:
                        held.close()
                        held = None
                        yield from out.add((path, records, size))
        if held is not None:
            held.close()
            yield from out.add((path, records, size))
        yield from out.out()

    return settings.written(stored.unionByName(also).mapInArrow(write, schema), "warc-manifest")


def _each_record(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], int]]:
    """The fields of every record; its block, of the given size, must be read before the next."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins here: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, int(fields["content-length"])


def _payload_start(stream: io.BufferedIOBase, fields: dict[str, str], size: int) -> int:
    """Bytes of the block behind its HTTP header, which is read over."""
    if not fields.get("content-type", "").startswith("application/http") or fields.get("warc-type") == "continuation":
        return size
    while size:
        line = stream.readline(size)
        size -= len(line)
        if not line.strip():
            return size
    return 0


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, keep_data: bool = True) -> DataFrame:
    """The records of the archives named in ``manifest`` (column path) as chunk rows.

    record_id, record_type, page_id (as text), url, segment (null unless the record is one of
    several), part (counts the chunks of a record or segment), last (of its segment), data,
    total and digest (of the payload so far, within a segment), refers_to (the page id of the
    response), stated_bytes and stated_digest (what the record says about its payload).
    Each archive is read by one task, chunk by chunk, whatever the size of its records.  Other
    kinds of records are left out.  Without ``keep_data`` only segments hold data.
    """
    schema = _arrow(_RECORDS)

    def ref(value: str | None) -> str | None:
        return unquote(value.strip("<>").split(":")[2]) or None if value else None

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, name = _opened(path)
                with system.open_input_stream(name, compression=None) as raw, gzip.GzipFile(fileobj=raw) as packed:
                    stream = io.BufferedReader(packed, 1 << 18)
                    for fields, size in _each_record(stream):
                        kind = fields.get("warc-type")
                        if kind not in ("response", "revisit", "continuation", "resource"):
                            while size:
                                size -= len(stream.read(min(size, chunk_bytes)))
                            continue
                        size = _payload_start(stream, fields, size)
                        segment = int(fields["warc-segment-number"]) if "warc-segment-number" in fields else None
                        own = (fields.get("warc-segment-origin-id") or fields["warc-record-id"]).strip("<>")
                        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        length = int(fields["x-payload-length"]) if "x-payload-length" in fields else None
                        sha1, total, part, left = hashlib.sha1(), 0, 0, size
                        while left or not part:
                            data = stream.read(min(left, chunk_bytes))
                            if left and not data:
                                raise ValueError(f"{path} ends within a record")
                            sha1.update(data)
                            left, total = left - len(data), total + len(data)
                            held = data if keep_data or segment is not None else None
                            yield from out.add((
                                own, kind, ref(own), fields.get("warc-target-uri"), segment, part, not left, held,
                                total, base32(sha1), ref(fields.get("warc-refers-to")), length, stated,
                            ), len(data))
                            part += 1
        yield from out.out()

    # one archive a task: archives are of bounded size
    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(read, _RECORDS)


def read_records(chunks: DataFrame) -> DataFrame:
    """record_id, record_type, page_id, refers_to, payload_bytes, payload_digest of every record.

    The segments of a record are brought together in order and digested as a stream, with
    the state of the digest alone between chunks.  A digest that differs from the one the
    record states ends the job.
    """
    chunks = settings.written(chunks, "warc-read")
    whole = chunks.where("segment IS NULL AND last").select(
        "record_id", "record_type", "page_id", "refers_to", F.coalesce("stated_bytes", "total").alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.col("stated_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "stated_digest",
    )
    parts = chunks.where("segment IS NOT NULL").select("record_id", "segment", "part", "page_id", "data", "stated_digest")
    parts = parts.repartition("record_id").sortWithinPartitions("record_id", "segment", "part")
    schema = "record_id string, record_type string, page_id string, refers_to string, payload_bytes long, payload_digest string, stated_digest string"

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, page, sha1, total, stated = _Rows(_arrow(schema)), None, None, hashlib.sha1(), 0, None
        for batch in batches:
            data = batch.column("data")
            names, pages, says = (batch.column(c).to_pylist() for c in ("record_id", "page_id", "stated_digest"))
            for i, name in enumerate(names):
                if name != now:
                    if now is not None:
                        yield from out.add((now, "response", page, None, total, base32(sha1), stated))
                    now, page, sha1, total, stated = name, pages[i], hashlib.sha1(), 0, None
                part = data[i].as_buffer()
                sha1.update(part)
                total, stated = total + part.size, says[i] or stated
        if now is not None:
            yield from out.add((now, "response", page, None, total, base32(sha1), stated))
        yield from out.out()

    found = whole.unionByName(parts.mapInArrow(joined, schema))
    wrong = F.raise_error(F.concat(F.lit("digest differs in "), F.col("record_id")))
    right = F.when(F.col("payload_digest") != F.col("stated_digest"), wrong).otherwise(F.col("payload_digest"))
    return found.withColumn("payload_digest", right.cast("string")).drop("stated_digest")


def round_trip(pages: DataFrame, folder: str, id_col: str = "page_id", **options) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back from the archives of ``pages``."""
    manifest = write_archives(pages, folder, id_col, **options)
    records = read_records(read_archives(manifest, keep_data=False))
    kind = pages.schema[id_col].dataType
    return records.select(
        F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
