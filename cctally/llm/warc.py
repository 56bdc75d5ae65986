"""Operator 9: WARC archives with an index first, read back by coalesced byte ranges.

Writing: a page's payload digest is grouped with the others' (combined before
the shuffle); of equal payloads the least page_id becomes the response and the
rest revisit it. Each task then writes its records, one gzip member each, to
files of its own in the shared folder and returns an index row per record:
file, offset, length, URL and digest. A repeated task writes new files; only
those that the saved index names count, so a lost executor does no harm.

Reading: the selected index rows are sorted by file and offset, neighbouring
byte ranges are read in one request, and every record's payload is checked
against its digest.

Defined results: a null html is an empty payload and a null URL a URN of the
page. Rows that repeat the least page_id of a payload are responses each; a
null page_id never is the one revisited, and if all ids of a payload are null,
its records are all responses. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cctally.llm.common import stage
from cctally.session import staging_dir

#: Payloads shorter than this are never revisited.
MIN_REVISIT_BYTES = 0
#: A task starts a new file beyond so many bytes.
FILE_BYTES = 256 << 20
#: Ranges no further apart than this are read together, up to a limit.
GAP_BYTES, RANGE_BYTES = 64 << 10, 8 << 20
#: Index rows are dealt by file and stretches of so many bytes.
STRETCH_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX = ("page_id long, url string, file string, offset long, length long, payload_digest string, "
         "payload_bytes long, record_type string, refers_to long")


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def digest32(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def build_record(page_id, url: str | None, payload: bytes, digest: str, date: str, refers: int | None, revisit: bool) -> bytes:
    """One uncompressed WARC record."""
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    target = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{page_id}"
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Block-Digest", f"sha1:{digest32(block)}")]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers, digest)),
                 ("X-Refers-To-Page", str(refers))]
    if page_id is not None:
        head.append(("X-Page", str(page_id)))
    head += [("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, block) of one uncompressed record; raises ValueError if it is malformed."""
    version, _, rest = data.partition(b"\r\n")
    head, _, body = rest.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    n = int(fields["Content-Length"])
    if version != b"WARC/1.1" or body[n:] != b"\r\n\r\n" or f"sha1:{digest32(body[:n])}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"malformed WARC record {fields.get('WARC-Record-ID')}")
    return fields, body[:n]


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, revisit, refers in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if out is None or offset >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (html or "").encode("utf-8")
                    digest = digest32(payload)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(build_record(page_id, url, payload, digest, date, refers, revisit)) + packer.flush()
                    out.write(member)
                    rows.append((page_id, url, name, offset, len(member), digest, len(payload),
                                 "revisit" if revisit else "response", refers if revisit else None))
                    offset += len(member)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(),
                         pa.int64()]
                columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 names=[x.split()[0] for x in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()
    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder``; returns the saved index."""
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.unhex(F.sha1(html.cast("binary"))).alias("sha"))
    # written first, so that the join deals its sides anew and adaptive execution can split a hot payload
    least = stage(rows.filter(F.octet_length("html") >= min_bytes).groupBy("sha").agg(
        F.min("page_id").alias("least"), F.count("*").alias("n"))
        .filter("n > 1 and least is not null").select(F.col("sha").alias("_sha"), "least"), "warc_least")
    revisit = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    chosen = rows.join(least, F.col("sha") == F.col("_sha"), "left").select(
        "page_id", "url", "html", revisit.alias("revisit"), "least")
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return stage(chosen.mapInArrow(_write(folder, date), INDEX), "warc_index")


def coalesce_ranges(spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, number of spans) of the reads that cover sorted (offset, length) spans."""
    out: list[list[int]] = []
    for offset, length in spans:
        end = offset + length
        if out and offset - out[-1][1] <= GAP_BYTES and end - out[-1][0] <= RANGE_BYTES:
            out[-1][1], out[-1][2] = max(out[-1][1], end), out[-1][2] + 1
        else:
            out.append([offset, end, 1])
    return [tuple(x) for x in out]


def _read(folder: str, keep_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            rows = []
            files: dict[str, list[tuple[int, int]]] = {}
            for name, offset, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                files.setdefault(name, []).append((offset, length))
            for name, spans in files.items():
                at = 0
                with store.open_input_file(f"{root}/{name}") as f:
                    for start, end, n in coalesce_ranges(spans):
                        data = f.read_at(end - start, start)
                        for offset, length in spans[at:at + n]:
                            member = data[offset - start:offset - start + length]
                            fields, block = parse_record(zlib.decompress(member, 31))
                            payload = block[len(HTTP_HEAD):]
                            kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                            if kind == "response" and digest32(payload) != digest:
                                raise ValueError(f"wrong payload digest in {name} at {offset}")
                            page, refers = fields.get("X-Page"), fields.get("X-Refers-To-Page")
                            rows.append((None if page is None else int(page), fields["WARC-Target-URI"],
                                         int(fields["X-Payload-Length"]), digest, kind,
                                         int(refers) if refers else None,
                                         payload.decode() if keep_payload and kind == "response" else None))
                        at += n
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["page_id", "target_uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
    return run


def read_archives(index: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """The records that rows of ``index`` name: ids, URL, payload size and digest, type, page referred to, payload."""
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the rows are small, the reads are not
    spans = index.select("file", "offset", "length", F.floor(F.col("offset") / STRETCH_BYTES).alias("stretch")) \
        .repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset").select("file", "offset", "length")
    return spans.mapInArrow(_read(folder, keep_payload), (
        "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload string"))


def archive_folder(pages: DataFrame) -> str:
    return staging_dir(pages.sparkSession, "warc")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h,
             min(page_id) OVER (PARTITION BY html) AS least FROM p),
b AS (SELECT *, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((CAST('0x' || substr(h, CAST(i // 4 AS INTEGER) * 5 + 1, 5) AS INTEGER)) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)),
    'string_agg', '') AS payload_digest FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = least OR least IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = least OR least IS NULL THEN NULL ELSE least END AS refers_to FROM b
"""
