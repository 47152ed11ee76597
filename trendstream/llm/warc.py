"""WARC archives with an index written beside the records.

Writing: records of equal payloads (SHA-1) are written once; later ones become
revisit records that name the first.  Every task writes archives of its own
with one gzip member per record and returns one index row per record: archive,
offset, length, URL, digest.  The index is an ordinary table that Spark commits,
so a lost task's half-written archive is never referred to.

Reading: selected index rows are sorted by archive and offset, neighbouring
byte ranges are read in one go, and each record is parsed from its range.  The
archives live in a folder that all executors reach, by its URI.
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
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstream.llm.common import quoted, text_or_empty
from trendstream.session import default_parallelism, fresh_path, materialize

RESPONSE, REVISIT = "response", "revisit"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
ARCHIVE_BYTES = 1 << 30       # an archive is closed when it is larger
READ_BYTES = 8 << 20          # one read is not larger, unless a record is
GAP_BYTES = 64 << 10          # a smaller gap between two ranges is read with them
CHUNK_BYTES = 64 << 20        # ranges of one archive that go to one reader
TASK_BYTES = 256 << 10        # a reading task gets more than this before there are as many as cores
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                    ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
                    ("record_type", pa.string())])
_INDEX_DDL = ("archive string, offset long, length long, page_id long, url string, digest string, "
              "record_type string")
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("payload", pa.binary())])
_RECORD_DDL = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
               "payload_digest string, payload binary")


def _file_system(uri: str):
    """The file system of a URI and the path in it; Hadoop's names of S3 are S3."""
    from pyarrow.fs import FileSystem
    return FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _page_urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    digits = urn.strip("<>").rpartition(":")[2]
    return int(digits) if digits else None


def record_bytes(page_id, url: str, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record; a revisit (refers_to is not None) carries the HTTP head only."""
    revisit = refers_to is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    head = [("WARC-Type", REVISIT if revisit else RESPONSE), ("WARC-Record-ID", _page_urn(page_id)),
            ("WARC-Date", date),
            ("WARC-Target-URI", quote(url, safe="".join(map(chr, range(0x21, 0x7F))))),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload))),
            ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _page_urn(refers_to))]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _gzip(raw: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_payload: int = 0, date: str = "2024-01-01T00:00:00Z", folder: str | None = None,
               level: int = 3) -> DataFrame:
    """Write one record per row; the index (archive, offset, length, page_id, url, digest, record_type).

    Of rows with equal payloads of at least ``min_payload`` bytes the one with
    the smallest id is the response and the others revisit it; rows repeated
    with that id are responses too.  Null html is an empty payload, a null url
    an empty one.  Rows with a null id are revisits when a row with an id has
    their payload, else responses.  An empty table gives an empty index.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    payload = text_or_empty(F.col(quoted(html_col))).cast("binary")
    rows = pages.select(F.col(quoted(id_col)).cast("long").alias("page_id"),
                        text_or_empty(F.col(quoted(url_col))).alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("sha1"))
    firsts = materialize(
        rows.filter(F.octet_length("payload") >= min_payload).groupBy("sha1")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
        .filter("n > 1").select("sha1", "first"), "warc-firsts")
    marked = rows.join(firsts.hint("shuffle_hash"), "sha1", "left").select(
        "page_id", "url", "payload", "sha1",
        F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        part, out, name, at = TaskContext.get().partitionId(), None, "", 0
        for batch in batches:
            index = []
            for r in batch.to_pylist():
                if out is None:
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, at = fs.open_output_stream(f"{base}/{name}", compression=None), 0
                digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                raw = _gzip(record_bytes(r["page_id"], r["url"], r["payload"], digest, r["refers_to"], date), level)
                out.write(raw)
                index.append((f"{folder}/{name}", at, len(raw), r["page_id"], r["url"], digest,
                              RESPONSE if r["refers_to"] is None else REVISIT))
                at += len(raw)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            columns = list(zip(*index)) if index else [[]] * len(_INDEX)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _INDEX)], schema=_INDEX)
        if out is not None:
            out.close()

    return materialize(marked.mapInArrow(write, _INDEX_DDL), "warc-index")


def read_warc(index: DataFrame, where: Column | None = None) -> DataFrame:
    """Records of the selected index rows: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest and payload (null for a revisit).

    Length and digest of a response are those of the bytes read; of a revisit,
    those its header states.  A response whose bytes don't have the digest of
    its header stops the job.
    """
    chosen = index if where is None else index.filter(where)
    # tasks by the bytes to be read: the index rows that are dealt out are far smaller
    n_bytes = chosen.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-n_bytes // CHUNK_BYTES), min(default_parallelism(index.sparkSession), -(-n_bytes // TASK_BYTES)))
    chunk = F.floor(F.col("offset") / max(1, -(-n_bytes // tasks)))
    ranges = (chosen.select("archive", "offset", "length", "url", chunk.alias("chunk"))
              .repartition(tasks, "archive", "chunk").sortWithinPartitions("archive", "offset"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _coalesced(batch.to_pylist()):
                first, last = group[0], group[-1]
                fs, path = _file_system(first["archive"])
                with fs.open_input_file(path) as f:
                    f.seek(first["offset"])
                    data = f.read(last["offset"] + last["length"] - first["offset"])
                at = [r["offset"] - first["offset"] for r in group]
                rows = [_record(r, data[a:a + r["length"]]) for r, a in zip(group, at)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORD)], schema=_RECORD)

    return ranges.mapInArrow(read, _RECORD_DDL)


def _coalesced(rows: list[dict]) -> Iterator[list[dict]]:
    """Sorted ranges in groups, each to be read at once."""
    group: list[dict] = []
    for r in rows:
        if group:
            end = group[-1]["offset"] + group[-1]["length"]
            near = r["archive"] == group[0]["archive"] and r["offset"] - end <= GAP_BYTES
            if not near or r["offset"] + r["length"] - group[0]["offset"] > READ_BYTES:
                yield group
                group = []
        group.append(r)
    if group:
        yield group


def _record(entry: dict, raw: bytes) -> tuple:
    fields, payload = parse_record(zlib.decompress(raw, 31))
    digest = fields["WARC-Payload-Digest"].partition(":")[2]
    page_id, kind = _page_of(fields["WARC-Record-ID"]), fields["WARC-Type"]
    if kind == REVISIT:
        return (page_id, entry["url"], kind, _page_of(fields["WARC-Refers-To"]),
                int(fields["X-Payload-Length"]), digest, None)
    if sha1_base32(payload) != digest:
        raise ValueError(f"record at {entry['archive']}:{entry['offset']} doesn't have its digest")
    return page_id, entry["url"], kind, None, len(payload), digest, payload
