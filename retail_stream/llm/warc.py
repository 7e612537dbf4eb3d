"""WARC archives: write, index first, then read selected records by coalesced byte ranges.

Every page becomes one gzip member of a WARC 1.1 file. Writing yields the index: file, offset, length,
URL and payload digest of each record. Reading starts from index rows: those of a file are sorted by
offset, neighbours are fetched in one range, and only selected records are unpacked.

Archives go below any folder Spark's configuration names as shared, opened through Arrow's file
systems. A file belongs to one task attempt and its name is in no index but that attempt's, so a task
that is run again leaves an unused file at worst.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_stream.llm.common import stored
from retail_stream.scratch import scratch_dir

# Shorter payloads are always written in full.
MIN_REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
# A range is read at once if the gap to the next selected record is at most GAP, up to RANGE bytes.
GAP_BYTES = 64 << 10
RANGE_BYTES = 8 << 20
# Archive bytes a task reads.
TASK_BYTES = 16 << 20

INDEX = "page_id bigint, file string, offset bigint, length bigint, url string, digest string, record_type string"
RECORD = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string,"
    " payload_bytes bigint, payload binary"
)


def record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest and ``refers_to``: the page that holds the same payload, or null
    where the page is a response itself.

    Of pages with equal payloads of at least ``min_bytes``, that with the largest page_id is the
    response; pages that share this largest id are all responses, and so are pages of a group in which
    no page has an id. A null html is an empty payload. Groups are found by (digest, length); a group
    that holds most pages is reduced before its shuffle, and the join to it is split by AQE.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("bigint")})
    groups = (
        rows.filter(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.count(F.lit(1)).alias("pages"), F.max("page_id").alias("response"))
        .filter("pages > 1 and response is not null")
        .select("digest", "bytes", "response")
    )
    other = ~F.col("page_id").eqNullSafe(F.col("response"))
    refers = F.when(F.col("response").isNotNull() & other, F.col("response"))
    return rows.join(groups, ["digest", "bytes"], "left").select(
        "page_id", "url", "payload", "digest", refers.alias("refers_to")
    )


def _number(value) -> str:
    return "null" if value is None or pd.isna(value) else str(int(value))


def _page(text: str):
    tail = text.rpartition(":")[2].rstrip(">")
    return None if tail == "null" else int(tail)


def pack(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record as a gzip member."""
    revisit = refers_to is not None and not pd.isna(refers_to)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{_number(page_id)}>",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None and not pd.isna(url):
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head.append(f"WARC-Refers-To: <urn:page:{_number(refers_to)}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 3, mtime=0)


def unpack(member: bytes) -> tuple:
    """The fields of RECORD of one gzip member; digest and length of a response are taken anew from
    its payload, those of a revisit from its headers."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, page, url = fields["WARC-Type"], _page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI")
    if kind == "response":
        return page, url, kind, None, hashlib.sha1(payload).hexdigest(), len(payload), payload
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].partition(":")[2]
    return page, url, kind, _page(fields["WARC-Refers-To"]), digest, size, None


def _place(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the rows of ``record_types`` and give the index, itself stored."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, base = _place(folder)
        where.create_dir(base, recursive=True)
        out, name, at, index = None, "", 0, []
        try:
            for frame in frames:
                for row in frame.itertuples(index=False):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                        out = where.open_output_stream(f"{base}/{name}", compression=None)
                    member = pack(row.page_id, row.url, row.payload, row.digest, row.refers_to)
                    kind = "response" if pd.isna(row.refers_to) else "revisit"
                    index.append((row.page_id, name, at, len(member), row.url, row.digest, kind))
                    out.write(member)
                    at += len(member)
                yield _frame(index, INDEX)
                index = []
        finally:
            if out is not None:
                out.close()

    return stored(rows.mapInPandas(run, INDEX), "warc-index")


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    fields = [f.split() for f in schema.split(", ")]
    frame = pd.DataFrame(rows, columns=[n for n, _ in fields])
    return frame.astype({n: "Int64" for n, kind in fields if kind == "bigint"})


def read_archives(
    selected: DataFrame, folder: str, gap: int = GAP_BYTES, most: int = RANGE_BYTES, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """The records of the selected index rows. Rows of one stretch of one file come to one task, sorted
    by offset; a stretch is ``most`` bytes long, whatever the file's size. There are as many tasks as the
    bytes to read need: the index rows alone say nothing of them."""
    stretch = F.floor(F.col("offset") / most)
    tasks = max(1, -(-(selected.agg(F.sum("length")).first()[0] or 0) // task_bytes))
    sorted_rows = (
        selected.select("file", "offset", "length", stretch.alias("stretch"))
        .repartition(tasks, "file", "stretch")
        .sortWithinPartitions("file", "offset")
    )

    def ranges(frames):
        """Runs of neighbouring records: (file, start, end, [(offset, length)])."""
        run = None
        for frame in frames:
            for name, offset, length in zip(frame["file"], frame["offset"], frame["length"]):
                if run and run[0] == name and offset - run[2] <= gap and offset + length - run[1] <= most:
                    run[2] = max(run[2], offset + length)
                    run[3].append((offset, length))
                    continue
                if run:
                    yield run
                run = [name, offset, offset + length, [(offset, length)]]
        if run:
            yield run

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, base = _place(folder)
        name, source = None, None
        for file, start, end, members in ranges(frames):
            if file != name:
                if source is not None:
                    source.close()
                name, source = file, where.open_input_file(f"{base}/{file}")
            source.seek(int(start))
            data = io.BytesIO(source.read(int(end - start))).getbuffer()
            yield _frame([unpack(data[o - start : o - start + n]) for o, n in members], RECORD)
        if source is not None:
            source.close()

    return sorted_rows.mapInPandas(run, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Archive all pages and read every record back."""
    folder = scratch_dir(spark, "warc")
    index = write_archives(record_types(pages, min_bytes), folder)
    return read_archives(index, folder)
