"""Web archives: an index first, then coalesced byte-range reads of the records it selects.

Writing gives each page a record in a gzip member of its own (WARC 1.1, ``.warc.gz``), and an index row with
file, offset, length, URL and payload digest. Of pages with equal payloads that with the largest id becomes a response,
the others revisits without a body. Who that is comes from one small table, a row for each payload that occurs twice;
pages meet it by their payload's hash, and a payload of a third of all pages is summed per task first.

Reading sorts the selected index rows by file and offset, joins neighbouring ranges into reads of some megabytes, and
checks every payload against its digest. Only an index row makes a record count: files of lost or repeated
task attempts have names of their own and are never read. Archives lie in the shared folder and go through ``pyarrow.fs``.

Defined cases: null html is an empty payload; rows that repeat the largest id of a payload are all responses; a null id is
a response only where its payload has no id at all, with a record id of its own; rows that repeat an id share a record id; a null URL leaves out the
header; very long pages are one record; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store

FILE_BYTES, READ_BYTES, GAP_BYTES, SPAN_BYTES = 256 << 20, 8 << 20, 64 << 10, 64 << 20
MOST_TASKS = 100_000
PAGE = "urn:x-page:"
# the profile that the standard names for revisits of an identical payload: a fixed value
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset bigint, length bigint, page_id bigint, url string, digest string, record_type string"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to, kind: str, date: str) -> bytes:
    """One record, compressed; a revisit keeps the HTTP header with the length of the payload it leaves out."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if kind == "response" else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{f'urn:uuid:{uuid.uuid4()}' if page_id is None else f'{PAGE}{page_id}'}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(0x21, 0x7F)))))
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{PAGE}{refers_to}>"]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + deflate.flush()


def parsed(member: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and declared payload length of a compressed record."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    return headers, payload, length


def _page(urn: str | None):
    return int(urn.strip("<>").removeprefix(PAGE)) if urn is not None and PAGE in urn else None


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def _written(folder: str, date: str):
    def run(batches):
        system, place = _opened(folder)
        system.create_dir(place, recursive=True)
        name, stream, at = None, None, 0
        try:
            for batch in batches:
                rows = {n: [] for n in ("file", "offset", "length", "page_id", "url", "digest", "record_type")}
                for page_id, url, payload, sha1, refers_to, kind in zip(*(c.to_pylist() for c in batch.columns)):
                    if stream is None or at >= FILE_BYTES:
                        if stream is not None:
                            stream.close()
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        stream = system.open_output_stream(f"{place}/{name}", compression=None)
                    digest = base32(bytes.fromhex(sha1))
                    member = record(page_id, url, payload, digest, refers_to, kind, date)
                    stream.write(member)
                    for column, value in zip(rows.values(), (name, at, len(member), page_id, url, digest, kind)):
                        column.append(value)
                    at += len(member)
                yield pa.RecordBatch.from_pydict(
                    rows,
                    pa.schema([(n, pa.int64() if n in ("offset", "length", "page_id") else pa.string()) for n in rows]),
                )
        finally:
            if stream is not None:
                stream.close()

    return run


def write_archives(pages: DataFrame, folder: str, store: Store, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archives of ``pages`` (``page_id, url, html``) below ``folder``; the index, one row per record."""
    bodies = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    several = store.write(
        "several",
        bodies.where(F.octet_length("payload") >= least_bytes).groupBy("sha1")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keeper"))
        .where("n > 1").select("sha1", "keeper", F.lit(True).alias("again")),
    )
    typed = bodies.join(several, "sha1", "left").select(
        "page_id", "url", "payload", "sha1", "keeper",
        F.when(F.col("again").isNull() | F.col("page_id").eqNullSafe(F.col("keeper")), "response").otherwise("revisit").alias("kind"),
    )
    return store.write("index", typed.mapInArrow(_written(folder, date), INDEX))


def _read(folder: str, with_payload: bool):
    def fetched(system, name: str, group: list[tuple[int, int]], rows: dict[str, list]) -> None:
        first, last = group[0][0], max(o + n for o, n in group)
        with system.open_input_file(name) as file:
            data = file.read_at(last - first, first)
        for offset, length in group:
            headers, payload, declared = parsed(data[offset - first : offset - first + length])
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if headers["WARC-Type"] == "response" and (len(payload) != declared or base32(hashlib.sha1(payload).digest()) != digest):
                raise ValueError(f"damaged record at {offset} of {name}")
            values = (
                _page(headers["WARC-Record-ID"]), declared, digest, headers["WARC-Type"], _page(headers.get("WARC-Refers-To")),
                payload if with_payload else None,
            )
            for column, value in zip(rows.values(), values):
                column.append(value)

    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())

    def run(batches):
        system, place = _opened(folder)
        held: list[tuple[int, int]] = []
        current = None
        for batch in batches:
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                far = held and (
                    name != current or offset - (held[-1][0] + held[-1][1]) > GAP_BYTES or offset + length - held[0][0] > READ_BYTES
                )
                if far:
                    rows = {n: [] for n in names}
                    fetched(system, f"{place}/{current}", held, rows)
                    held = []
                    yield pa.RecordBatch.from_pydict(rows, pa.schema(list(zip(names, kinds))))
                current = name
                held.append((offset, length))
        if held:
            rows = {n: [] for n in names}
            fetched(system, f"{place}/{current}", held, rows)
            yield pa.RecordBatch.from_pydict(rows, pa.schema(list(zip(names, kinds))))

    return run


def read_archives(selected: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of index rows ``selected``, in reads of neighbouring ranges; a large file is shared by several tasks.

    The number of tasks follows the bytes to be read, not those of the index.
    """
    to_read = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-to_read // SPAN_BYTES), selected.sparkSession.sparkContext.defaultParallelism)
    sorted_rows = (
        selected.select("file", "offset", "length", F.floor(F.col("offset") / SPAN_BYTES).alias("span"))
        .repartition(min(tasks, MOST_TASKS), "file", "span")
        .sortWithinPartitions("file", "offset")
        .select("file", "offset", "length")
    )
    return sorted_rows.mapInArrow(_read(folder, with_payload), RECORDS)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes all pages and reads all records back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    store = Store(pages.sparkSession, "archives")
    folder = store.path("warc")
    index = write_archives(pages, folder, store, least_bytes)
    return read_archives(index, folder, with_payload=False).drop("payload")
