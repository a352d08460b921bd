"""WARC archives: written by tasks, read back through an index by coalesced byte ranges.

Every record is a gzip member of its own. Writing returns an index with the file, offset,
length, URL and digest of each record; it is stored beside the archives and names only files of
tasks that were committed, so files of failed attempts are never read. The index also holds
the pages' ids in their own type; records name them as text, and reading compares the two. It
sorts the selected index rows by file and offset, merges neighbouring ranges, and fetches each merged
range once. Files are reached through pyarrow's file systems, by the folder's URI.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROLL = 64 << 20  # bytes after which a task starts another file
GAP = 64 << 10  # bytes not asked for that a merged range may hold between two records
RANGE = 8 << 20  # bytes of a merged range, unless one record is longer
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("path", "offset", "length", "url", "digest", "type", "id", "refers_to")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _name(page, digest: str) -> str:
    return f"<urn:x-page:{'' if page is None else quote(str(page), safe='')}:{digest}>"


def page_record(page, url: str | None, payload: bytes, refers_to, revisit: bool, date: str):
    """(bytes, digest) of a page's response, or of its revisit of another page's response."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [("WARC-Record-ID", _name(page, digest)), ("WARC-Date", date)]
    if url is not None:
        clean = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
        headers.append(("WARC-Target-URI", clean))
    headers.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    headers.append(("Content-Type", "application/http; msgtype=response"))
    if revisit:
        headers += [("WARC-Refers-To", _name(refers_to, digest)), ("WARC-Profile", REVISIT)]
        return _record("revisit", headers, http.encode()), digest
    return _record("response", headers, http.encode() + payload), digest


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class _Writer:
    """Files of one task; a new one after ROLL bytes, each with a warcinfo record first."""

    def __init__(self, folder: str, date: str):
        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.date, self.out, self.name, self.at = date, None, "", 0

    def put(self, record: bytes) -> tuple[str, int, int]:
        if self.out is None:
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.out, self.at = self.files.open_output_stream(f"{self.folder}/{self.name}", compression=None), 0
            info = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", self.date)]
            info.append(("Content-Type", "application/warc-fields"))
            self._append(_record("warcinfo", info, b"format: WARC File Format 1.1\r\n"))
        at, size = self.at, self._append(record)
        placed = self.name, at, size
        if self.at >= ROLL:
            self.close()
        return placed

    def _append(self, record: bytes) -> int:
        data = _member(record)
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def with_originals(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int
) -> DataFrame:
    """(id, url, payload, refers_to, revisit): of equal payloads the largest id is the response.

    Payloads are compared by SHA-1. A payload under ``least_bytes`` is always a response, as are
    all rows of a payload that have the largest id, and all if no row has an id.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    copies = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("sha")
        .agg(F.max("id").alias("original"), F.count("*").alias("n"))
        .where("n > 1 and original is not null")
        .select("sha", "original")
    )
    out = rows.join(copies, "sha", "left")
    revisit = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    out = out.withColumn("revisit", revisit)
    original = F.when(F.col("revisit"), F.col("original"))
    return out.select("id", "url", "payload", original.alias("refers_to"), "revisit")


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Archives of pages in ``folder``, a URI that all executors reach, and their index.

    One record per row: a null payload is empty, a null URL is left out, a null id is written
    without a name, repeated rows have records of their own. Ids may be of any simple type. An
    empty table writes an empty index and no archive.
    """
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder, date)
        for batch in batches:
            ids, others = batch.column(0), batch.column(3)
            made: list[tuple] = []
            for page, url, payload, other, revisit in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                data, digest = page_record(page, url, payload.encode(), other, revisit, date)
                kind = "revisit" if revisit else "response"
                made.append((*writer.put(data), url, digest, kind))
            if batch.num_rows:
                kinds = (pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3)
                cols = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*cols, ids, others], names=list(INDEX))
        writer.close()

    rows = with_originals(pages, id_col, url_col, payload_col, least_bytes)
    kind = dict(rows.dtypes)["id"]
    schema = (
        "path string, offset long, length long, url string, digest string, type string, "
        f"id {kind}, refers_to {kind}"
    )
    rows.mapInArrow(run, schema).write.parquet(f"{folder}/index")


def merged_ranges(rows: Iterator[tuple]) -> Iterator[tuple[str, list[tuple]]]:
    """(path, [(offset, length, ...), ...]) of neighbouring records, from rows sorted by place."""
    path, held = None, []
    for name, offset, length, *more in rows:
        if held:
            end = held[-1][0] + held[-1][1]
            if name != path or offset - end > GAP or offset + length - held[0][0] > RANGE:
                yield path, held
                held = []
        path = name
        held.append((offset, length, *more))
    if held:
        yield path, held


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one gzip member."""
    record = zlib.decompress(data, 31)
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


def _read_page(data: bytes, page, other) -> tuple:
    """A record's columns; ``page`` and ``other`` are what the index says of its ids."""
    headers, block = parse_record(data)
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)\r\ncontent-length: ([0-9]+)", head)[1])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind, name = headers["warc-type"], headers["warc-record-id"]
    if kind == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"record {name} is damaged")
    refers = None if kind == "response" else _name(other, digest)
    if name != _name(page, digest) or headers.get("warc-refers-to") != refers:
        raise ValueError(f"record {name} is not the one that the index names")
    url = headers.get("warc-target-uri")
    return page, url, length, digest, kind, other, payload if kind == "response" else None


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """(path, offset, length, url, digest, type, id, refers_to) of every record."""
    return spark.read.parquet(f"{folder}/index").select(*INDEX)


def read_warc(selected: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """(id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of index rows.

    A revisit's length and digest are those of the payload it stands for; its payload is null.
    Digests of responses are verified. A file's records are read by one task: files are small.
    """
    parts = int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The number is given: merging partitions by the index's few bytes would leave few readers.
    placed = selected.select("path", "offset", "length", "id", "refers_to")
    placed = placed.repartition(parts, "path").sortWithinPartitions("path", "offset")
    kind = dict(selected.dtypes)["id"]
    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = ", ".join(
        f"{n} {k}" for n, k in zip(names, (kind, "string", "long", "string", "string", kind))
    )
    if payloads:
        names, schema = [*names, "payload"], schema + ", payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        own: list = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                own[:] = [batch.schema.field("id").type]
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        for path, places in merged_ranges(rows()):
            first = places[0][0]
            with files.open_input_file(f"{root}/{path}") as source:
                data = source.read_at(places[-1][0] + places[-1][1] - first, first)
            made = [_read_page(data[o - first : o - first + n], *ids) for o, n, *ids in places]
            kinds = [own[0], pa.string(), pa.int64(), pa.string(), pa.string(), own[0], pa.binary()]
            columns = list(zip(*made, strict=True))[: len(names)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names
            )

    return placed.mapInArrow(run, schema)
