"""Web archives: a writer that stores equal payloads once, and a splittable reader.

Every record is a gzip member of its own. A reading task gets a byte range of an archive, looks in it for the gzip
magic, accepts a candidate member if it decodes to a record header, and owns the records whose members start inside its
range; the last of them it reads beyond the end of the range.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import partitions_of, stored
from quayside.session import checkpoint_dir

SPLIT = 8 << 20         # bytes of an archive that one range covers
BLOCK = 1 << 20         # bytes read at once
LEVEL = 4               # of compression

# Fixed values of the archive and gzip formats.
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"
_RECORD_ID = "<urn:quayside:page:{}>"
_HEADER_LIMIT = 1 << 16


# -- writing ----------------------------------------------------------------------------------------------------------

def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The pages with payload, its SHA-1, and ``first_id``: the page that holds an equal payload of at least
    ``least_bytes`` bytes with the smallest id, or null where no other page does."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    groups = rows.filter(F.col("size") >= least_bytes).groupBy("sha1", "size").agg(
        F.count("*").alias("n"), F.min("page_id").alias("first_id"))
    # Stored, so that its size is known when the join is planned; hot payloads meet a single row.
    shared = stored(groups.filter("n > 1 AND first_id IS NOT NULL").drop("n"))
    return rows.join(shared, ["sha1", "size"], "left")


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, first_id: int | None) -> bytes:
    """One record, not yet compressed. A revisit keeps the HTTP header with the length of the payload, not the payload."""
    revisit = first_id is not None and first_id != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_RECORD_ID.format('' if page_id is None else page_id)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_RECORD_ID.format(first_id)}"]
    return _VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write an archive per partition to the shared folder; the result lists ``path`` and ``bytes`` of each.

    A file's name carries the attempt, so a task that runs again writes another file, and only the files of successful
    attempts are listed.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        written = 0
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                columns = [batch.column(c) for c in ("page_id", "url", "payload", "sha1", "first_id")]
                for values in zip(*columns):
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(record(*(v.as_py() for v in values))) + packer.flush()
                    out.write(member)
                    written += len(member)
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [written]})

    return stored(records.select("page_id", "url", "payload", "sha1", "first_id").mapInArrow(run, "path string, bytes long"))


# -- reading ----------------------------------------------------------------------------------------------------------

def _member(file, at: int, data: bytes) -> tuple[bytes, int] | None:
    """The record whose member starts at ``at``, and where the member ends; None if none starts there. ``data`` holds
    the first bytes from there on."""
    unpacker, out, taken = zlib.decompressobj(31), [], 0
    known = False
    try:
        while True:
            part = unpacker.decompress(data)
            taken += len(data) - len(unpacker.unused_data)
            out.append(part)
            if not known:
                head = b"".join(out)
                if not _VERSION.startswith(head[:len(_VERSION)]):
                    return None
                known = b"\r\n\r\n" in head[:_HEADER_LIMIT]
                if not known and len(head) > _HEADER_LIMIT:
                    return None
            if unpacker.eof:
                return (b"".join(out), at + taken) if known else None
            file.seek(at + taken)
            data = file.read(BLOCK)
            if not data:
                return None
    except zlib.error:
        return None


def read_range(file, start: int, end: int) -> Iterator[bytes]:
    """The records whose gzip members start at ``start`` or later and before ``end``."""
    at, data, base = start, b"", start
    while at < end:
        place = data.find(_MAGIC, at - base)
        if place < 0:
            # Keep what may be the beginning of a magic, and go on.
            at = max(at, base + len(data) - len(_MAGIC) + 1)
            file.seek(at)
            base, data = at, file.read(BLOCK)
            if len(data) < len(_MAGIC):
                return
            continue
        at = base + place
        if at >= end:
            return
        found = _member(file, at, data[place:])
        if found is None:
            at += 1
            continue
        yield found[0]
        at = found[1]
        if at > base + len(data):
            base, data = at, b""


_ID = re.compile(_RECORD_ID.replace("{}", "(-?[0-9]*)"))
_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
                     ("intact", pa.bool_())])


def parse(data: bytes) -> tuple:
    """The fields of one record; ``intact`` says that the payload has the digest and the length that the headers name."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: ([0-9]+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    intact = kind == "revisit" or (
        len(payload) == size and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest)

    def page(name: str) -> int | None:
        found = _ID.fullmatch(fields.get(name, ""))
        return int(found[1]) if found and found[1] else None

    return (page("WARC-Record-ID"), size, digest, kind, page("WARC-Refers-To"), fields["WARC-Target-URI"], intact)


def read_archives(spark: SparkSession, archives: DataFrame, split: int = SPLIT) -> DataFrame:
    """Every record of the listed archives (``path``, ``bytes``), read in byte ranges of ``split`` bytes."""
    ranges = archives.filter("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long")))
        .alias("start"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start"))):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    rows = [parse(r) for r in read_range(file, start, min(size, start + split))]
                columns = list(zip(*rows)) or [()] * len(_SCHEMA)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    return ranges.repartition(partitions_of(spark)).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
             "target_uri string, intact boolean")


def archive_round_trip(pages: DataFrame, least_bytes: int = 0, split: int = SPLIT) -> DataFrame:
    """Write the pages to archives and read the records back: one row per page.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the smallest id is a response and the
    others revisit it; smaller payloads are all responses. A null html is an empty payload, a null url an empty URI.
    Rows that repeat an id and its payload are all responses; a page without an id revisits like others, and is a
    response if no page with an id has its payload. Other columns are ignored; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = f"{checkpoint_dir(spark)}/warc-{uuid4().hex}"
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_archives(spark, write_archives(plan_records(pages, least_bytes), folder), split)
