"""WARC archives as seekable Zstandard bundles.

A bundle is one ``.warc.zst`` file: independent Zstandard frames of whole records, followed by a
seek table in a skippable frame (the public seekable format), so any Zstandard reader sees one
stream and a reader with the table fetches a single frame. The index maps each record to its
bundle, frame and offset inside the frame.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with the smallest page
id is a response and all others revisit it; a revisit keeps the HTTP header of its payload but not
the payload. Digests meet in a join with one row per repeated digest, which adaptive execution can
split, so a payload with a third of all pages is no single task.

Tasks write bundles to the shared work folder through ``pyarrow.fs``, under a name of their own
that is moved into place when complete; a task that runs again writes the same bundle anew. The
written index names the bundles that count.

Defined cases: null html is an empty payload; a null page id gives a record without a page name,
which is a response only if no equal payload has an id or it is the only kind; a null url leaves
the target header out; pages that repeat an id each get a record, those that tie with the
response are responses too; an empty table gives no bundle and an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procurelens.llm.common import saved, table
from procurelens.session import work_dir

LEAST_BYTES = 0
#: Raw bytes after which a frame, and a bundle, is closed.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 32 << 20
LEVEL = 3
# Fixed values of the seekable format: magic of its skippable frame and of its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2020-01-01T00:00:00Z"
_RECORDS = "page_id long, bundle string, frame long, frame_at long, frame_size long, offset long, size long"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_types(pages: DataFrame, id_col: str, body_col: str, url_col: str, least_bytes: int) -> DataFrame:
    """(page_id, url, payload, digest, first_id) where first_id is set for revisits only."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(body_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.length("payload") >= least_bytes)
    groups = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(groups, "digest", "left")
    revisit = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.withColumn("first_id", F.when(revisit, F.col("first_id")))


def _name(page_id) -> str:
    return "urn:page:" + ("null" if pd.isna(page_id) else str(int(page_id)))


def record(page_id, url, payload: bytes, first_id) -> bytes:
    """One WARC record; a revisit holds the HTTP header only."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = not pd.isna(first_id)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_name(page_id)}>"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}")
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{_name(first_id)}>")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield headers, data[start:stop]
        at = stop + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer: compressed and raw size of every frame."""
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    return struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)


def read_seek_table(tail: bytes) -> list[tuple[int, int]]:
    """Sizes of the frames, from the end of a bundle (all of it, or at least its table)."""
    count, flags, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    start = len(tail) - 9 - count * width
    return [struct.unpack_from("<II", tail, start + i * width) for i in range(count)]


class Bundle:
    """Collects records into frames, and frames into one file."""

    def __init__(self) -> None:
        self.done, self.frames, self.open, self.raw = [], [], [], 0
        self.index: list[tuple] = []
        self.size = self.written = 0
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress

    def add(self, page_id, data: bytes) -> None:
        self.index.append((page_id, len(self.frames), self.raw, len(data)))
        self.open.append(data)
        self.raw += len(data)
        self.size += len(data)
        if self.raw >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            packed = self.compress(b"".join(self.open))
            self.frames.append((self.written, len(packed), self.raw))
            self.written += len(packed)
            self.done.append(packed)
            self.open, self.raw = [], 0

    def finish(self, folder: str, name: str) -> pd.DataFrame:
        """Write the file, then move it into place; returns the index rows."""
        self.close_frame()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        own = f"{root}/.{name}-{uuid.uuid4().hex}"
        with store.open_output_stream(own, compression=None) as out:  # the frames are compressed already
            out.write(b"".join(self.done))
            out.write(seek_table([f[1:] for f in self.frames]))
        store.move(own, f"{root}/{name}")
        rows = [(i, f"{folder}/{name}", f, *self.frames[f][:2], at, n) for i, f, at, n in self.index]
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _RECORDS.split(", ")])
        return frame.astype({"page_id": "Int64"})


def _uri(path: str) -> str:
    return path if "://" in path else "file://" + path.removeprefix("file:")


def _write(folder: str, bundle_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        # Names of this attempt's own: a repeated task, whose records may come in another order, makes
        # other bundles, and those that count are the ones that the committed index names.
        task, nth, bundle = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, Bundle()
        for batch in batches:
            for page_id, url, payload, first_id in batch.itertuples(index=False):
                bundle.add(page_id, record(page_id, url, payload, first_id))
                if bundle.size >= bundle_bytes:
                    yield bundle.finish(folder, f"pages-{task}-{nth:04d}.warc.zst")
                    nth, bundle = nth + 1, Bundle()
        if bundle.index:
            yield bundle.finish(folder, f"pages-{task}-{nth:04d}.warc.zst")

    return run


def write_archives(
    spark: SparkSession, pages: DataFrame, id_col: str = "page_id", body_col: str = "html", url_col: str = "url",
    least_bytes: int = LEAST_BYTES, bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write the bundles; returns the written index of their records."""
    folder = _uri(work_dir(spark, "warc"))
    rows = record_types(pages, id_col, body_col, url_col, least_bytes).select("page_id", "url", "payload", "first_id")
    return saved(spark, rows.mapInPandas(_write(folder, bundle_bytes), _RECORDS), "warc-index")


def _page(name: str | None):
    text = (name or "").strip("<>").removeprefix("urn:page:")
    return int(text) if text.lstrip("-").isdigit() else None


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for path in batch["bundle"]:
            store, inner = fs.FileSystem.from_uri(path)
            with store.open_input_file(inner) as file:
                file.seek(file.size() - 9)
                count = struct.unpack("<I", file.read(4))[0]
                file.seek(file.size() - 9 - 8 * count)
                sizes, at = read_seek_table(file.read()), 0
                for packed, raw in sizes:
                    file.seek(at)
                    frame = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=raw)
                    at += packed
                    for headers, block in parse(frame):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        declared = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
                        size, digest = int(declared["Content-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if headers["WARC-Type"] == "response":
                            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                            if (len(payload), found) != (size, digest):
                                raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
                        out.append((_page(headers["WARC-Record-ID"]), size, digest, headers["WARC-Type"], _page(headers.get("WARC-Refers-To"))))
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in _READ.split(", ")])
        yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, index: DataFrame) -> DataFrame:
    """One row per record of the bundles that an index names, read frame by frame."""
    bundles = index.select("bundle").distinct()
    # The list is a few bytes, but each name stands for a whole bundle: one task for each.
    return bundles.repartition(max(1, bundles.count())).mapInPandas(_read, _READ)


def read_record(bundle: str, frame_at: int, frame_size: int, offset: int, size: int) -> bytes:
    """One record by its index row: reads its frame alone."""
    store, inner = fs.FileSystem.from_uri(bundle)
    with store.open_input_file(inner) as file:
        file.seek(frame_at)
        frame = zstandard.ZstdDecompressor().decompressobj().decompress(file.read(frame_size))
    return frame[offset : offset + size]


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(spark, write_archives(spark, table(spark, sf_dir, "pages")))


OP7_SQL = """
WITH paged AS (
    SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
    SELECT DISTINCT hex, array_to_string(list_transform(string_split(hex, ''), lambda x: CASE x
        WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011'
        WHEN '4' THEN '0100' WHEN '5' THEN '0101' WHEN '6' THEN '0110' WHEN '7' THEN '0111'
        WHEN '8' THEN '1000' WHEN '9' THEN '1001' WHEN 'a' THEN '1010' WHEN 'b' THEN '1011'
        WHEN 'c' THEN '1100' WHEN 'd' THEN '1101' WHEN 'e' THEN '1110' ELSE '1111' END), '') AS bits
    FROM paged
), coded AS (
    SELECT hex, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + 16 * CAST(substr(bits, CAST(5 * i + 1 AS INT), 1) AS INT) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS INT), 1) AS INT)
        + 4 * CAST(substr(bits, CAST(5 * i + 3 AS INT), 1) AS INT) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS INT), 1) AS INT)
        + CAST(substr(bits, CAST(5 * i + 5 AS INT), 1) AS INT), 1)), '') AS digest
    FROM bits
), firsts AS (
    SELECT hex, min(page_id) AS first_id FROM paged GROUP BY hex
)
SELECT p.page_id, CAST(strlen(p.body) AS BIGINT) AS payload_bytes, c.digest AS payload_digest,
       CASE WHEN p.page_id = f.first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> f.first_id THEN f.first_id END AS refers_to
FROM paged p JOIN coded c USING (hex) JOIN firsts f USING (hex)
"""
