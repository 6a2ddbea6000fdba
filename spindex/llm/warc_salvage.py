"""WARC archives: a deduplicating writer and a salvage reader.

Writer: one WARC/1.1 record a row, each a gzip member of its own. Rows with
equal payloads of at least ``least`` bytes share one response (the smallest
id); the others are revisit records (identical-payload-digest profile) without
a block. A task writes numbered files of bounded size under names of its own
and renames them at the end; run again, it writes the same files.

Reader: a file is read in pieces of bounded size, record by record. A record
counts only if its gzip member inflates with a right checksum, its version
line, header and length are well formed and, for a response, its block has
the digest the header names. After a failed check the reader searches the next
gzip magic (or, in plain files, the next ``WARC/1.`` line), tries the checks
there, goes on from the first place that passes them, and logs the byte gap
(file, start, end, reason) it left out. Later records are never lost.

Null payload is an empty payload; a null id is written without an id and read
back as null (it loses to any other id as a group's response); rows that
repeat the smallest id of a group are all responses; other columns are not
read. An empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rows, columns_of, filesystem, lookup_join, saved, workers

#: An archive file is closed at this size; the reader holds this much of a file beside the record it reads.
FILE_BYTES, PIECE = 64 << 20, 1 << 20
GZIP, VERSION = b"\x1f\x8b\x08", b"WARC/1."
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: ASCII digits, of which no more count than a file's size can have.
LENGTH = re.compile(r"0*([0-9]{1,18})")
HEAD_LINE = re.compile(rb"([!-9;-~]+):[ \t]*(.*)")

MANIFEST = "path string, records long"
MANIFEST_ARROW = pa.schema([("path", pa.string()), ("records", pa.int64())])
RECORDS = ("page_id long, record_type string, refers_to long, payload_digest string, payload binary, "
           "path string, start long, end long, gap string")
RECORDS_ARROW = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                           ("payload_digest", pa.string()), ("payload", pa.binary()), ("path", pa.string()),
                           ("start", pa.int64()), ("end", pa.int64()), ("gap", pa.string())])


# -- writing ---------------------------------------------------------------
def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str,
           refers_to: int | None) -> bytes:
    """One uncompressed record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{kind}:{page_id}:{digest}>",
             "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT}", f"X-Refers-To-Page-ID: {refers_to}",
                  f"WARC-Refers-To: <urn:page:response:{refers_to}:{digest}>"]
        payload = b""
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    made = zlib.compressobj(level, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def write_part(batches: Iterator[pa.RecordBatch], out: str, most: int) -> Iterator[pa.RecordBatch]:
    task, (fs, folder) = TaskContext.get(), filesystem(out)
    stream, done, size, n = None, [], 0, 0

    def close():
        stream.close()
        name = f"part-{task.partitionId():06d}-{len(done):04d}.warc.gz"
        fs.move(mine, f"{folder}/{name}")
        done.append({"path": f"{out}/{name}", "records": n})

    for batch in batches:
        for values in columns_of(batch, "page_id", "url", "payload", "digest", "kind", "refers_to"):
            if stream is None:
                fs.create_dir(folder, recursive=True)
                mine = f"{folder}/_{task.partitionId()}-{len(done)}-{task.taskAttemptId()}"
                stream, size, n = fs.open_output_stream(mine, compression=None), 0, 0
            page_id, url, payload, digest, kind, refers_to = values
            made = member(record(page_id, url, bytes(payload), digest, kind, refers_to))
            stream.write(made)
            size, n = size + len(made), n + 1
            if size >= most:
                close()
                stream = None
    if stream is not None:
        close()
    if done:
        yield pa.RecordBatch.from_pylist(done, MANIFEST_ARROW)


def write_archives(pages: DataFrame, out: str, least: int = 100, most: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row of (page_id, url, html); the archives'
    manifest (path, records), saved, so the archives are written once.

    Digests are counted without the payloads; a payload moves only if its
    digest occurs twice in a table too large to broadcast."""
    workers(pages.sparkSession)
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = (rows.where(F.octet_length("payload") >= least).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("digest", "first", "n"))
    marked = lookup_join(rows, saved(firsts, "warc-digests"), "digest", "n")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = (marked.withColumn("kind", F.when(again, "revisit").otherwise("response"))
              .withColumn("refers_to", F.when(again, F.col("first"))))
    return saved(marked.mapInArrow(partial(write_part, out=out, most=most), MANIFEST), "warc-manifest")


# -- reading ---------------------------------------------------------------
class Damaged(Exception):
    """A check failed."""


class Window:
    """A file seen through a window of bounded size that moves forwards.
    ``size`` is the file's size, None if it isn't known."""

    def __init__(self, file, size: int | None = None):
        self.file, self.size, self.at, self.data, self.end = file, size, 0, b"", False

    def read(self, start: int, n: int) -> bytes:
        """Up to n bytes from ``start``, which never lies before an earlier ``drop``."""
        lack, parts = start + n - self.at - len(self.data), [self.data]
        while not self.end and lack > 0:
            parts.append(self.file.read(PIECE))
            self.end = not parts[-1]
            lack -= len(parts[-1])
        if len(parts) > 1:
            self.data = b"".join(parts)
        return self.data[start - self.at:start - self.at + n]

    def drop(self, start: int) -> None:
        """Bytes before ``start`` aren't needed any more."""
        if start - self.at >= PIECE:
            self.data, self.at = self.data[start - self.at:], start

    def find(self, start: int, marks: tuple[bytes, ...]) -> int:
        """Where the first of the marks begins at or after ``start``; the end of the file if nowhere."""
        while True:
            piece = self.read(start, PIECE)
            hits = [k for m in marks if (k := piece.find(m)) >= 0]
            if hits:
                return start + min(hits)
            if len(piece) < PIECE:
                return start + len(piece)
            start += PIECE - 16
            self.drop(start)


def parse_head(head: bytes) -> dict[str, str]:
    version, *lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", version):
        raise Damaged("no version line")
    fields = {}
    for line in lines:
        if not (m := HEAD_LINE.fullmatch(line)):
            raise Damaged("a header line is malformed")
        fields[m[1].decode().lower()] = m[2].decode("utf-8", "replace").strip()
    if not (m := LENGTH.fullmatch(fields.get("content-length", ""))):
        raise Damaged("no content length")
    fields["content-length"] = m[1]
    return fields


def checked(fields: dict[str, str], block: bytes, tail: bytes) -> tuple[dict[str, str], bytes]:
    if len(block) != int(fields["content-length"]) or tail != b"\r\n\r\n":
        raise Damaged("the block is shorter or longer than its length")
    named = fields.get("warc-payload-digest", "").rpartition(":")[2]
    if fields.get("warc-type") == "response" and named and hashlib.sha256(block).hexdigest() != named:
        raise Damaged("the block's digest is wrong")
    return fields, block


def inflate(w: Window, start: int) -> tuple[dict[str, str], bytes, int]:
    """The record of the gzip member at ``start`` and the member's end."""
    z, at, parts = zlib.decompressobj(31), start, []
    try:
        while not z.eof:
            piece = w.read(at, 64 << 10)
            if not piece:
                raise Damaged("the member is cut short")
            parts.append(z.decompress(piece))
            if at == start and parts[0] and not parts[0].startswith(VERSION[:len(parts[0])]):
                raise Damaged("the member holds no record")
            at += len(piece)
    except zlib.error as e:
        raise Damaged("the member doesn't inflate") from e
    data = b"".join(parts)
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        raise Damaged("the header doesn't end")
    return *checked(parse_head(head), rest[:-4], rest[-4:]), at - len(z.unused_data)


def plain(w: Window, start: int) -> tuple[dict[str, str], bytes, int]:
    """The uncompressed record at ``start`` and its end."""
    n = 64 << 10
    head, found, _ = w.read(start, n).partition(b"\r\n\r\n")
    if not found:
        raise Damaged("the header doesn't end")
    fields = parse_head(head)
    body, size = start + len(head) + 4, int(fields["content-length"])
    if w.size is not None and body + size + 4 > w.size:
        raise Damaged("the record is longer than the file")
    after = w.read(body + size, 4)
    if len(after) < 4:
        raise Damaged("the record is cut short")
    return *checked(fields, w.read(body, size), after), body + size + 4


def salvage(file, size: int | None = None) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str | None]]:
    """(start, end, header, block, None) of each sound record and (start, end,
    None, b"", reason) of each gap, in file order; the two cover the file."""
    w, at, gap = Window(file, size), 0, None
    while w.read(at, 1):
        mark = w.read(at, 7)
        try:
            if mark.startswith(GZIP):
                fields, block, end = inflate(w, at)
            elif mark == VERSION:
                fields, block, end = plain(w, at)
            else:
                raise Damaged("neither a member nor a version line")
        except Damaged as e:
            gap = gap or (at, str(e))
            at = w.find(at + 1, (GZIP, VERSION))
            continue
        if gap:
            yield gap[0], at, None, b"", gap[1]
            gap = None
        yield at, end, fields, block, None
        at = end
        w.drop(at)
    if gap:
        yield gap[0], at, None, b"", gap[1]


def number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d{1,19}", text) else None


def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = Rows(RECORDS_ARROW)
    for batch in batches:
        for (path,) in columns_of(batch, "path"):
            fs, name = filesystem(path)
            with fs.open_input_stream(name, buffer_size=PIECE, compression=None) as f:
                for start, end, h, block, gap in salvage(f, fs.get_file_info(name).size):
                    if h is None:
                        rows.add(None, None, None, None, None, path, start, end, gap)
                    else:
                        digest = h.get("warc-payload-digest", "").rpartition(":")[2] or None
                        rows.add(number(h.get("x-page-id")), h.get("warc-type"), number(h.get("x-refers-to-page-id")),
                                 digest, block, path, start, end, None, weight=len(block))
                    if rows.full():
                        yield rows.take()
    if len(rows):
        yield rows.take()


def read_archives(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """Records and gaps (``gap`` not null) of the archives in column ``path``, a file a task at most."""
    workers(spark)
    return paths.select("path").repartition(max(1, min(paths.count(), 10_000)), "path").mapInArrow(read_files, RECORDS)


def resolved(records: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): a
    revisit has the size of the response with its digest, recomputed from that
    response's block; its own record has none. With the manifest of the writer,
    fewer records than were written are an error that names the gaps."""
    small = saved(records.select("page_id", "record_type", "refers_to", "payload_digest", "path", "gap",
                                 F.octet_length("payload").cast("long").alias("own_bytes")), "warc-records")
    if manifest is not None:
        written = manifest.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
        found = small.where(F.col("gap").isNull()).count()
        if found != written:
            gaps = [f"{r.path}: {r.gap}" for r in small.where(F.col("gap").isNotNull()).limit(20).collect()]
            raise RuntimeError(f"{found} of {written} records could be read; gaps: {gaps}")
    small = small.where(F.col("gap").isNull()).drop("path", "gap")
    response = F.col("record_type") == "response"
    sizes = (small.groupBy("payload_digest")
             .agg(F.max(F.when(response, F.col("own_bytes"))).alias("payload_bytes"), F.count(F.lit(1)).alias("n"),
                  F.max((~response).cast("int")).alias("wanted")).where("wanted = 1"))
    joined = lookup_join(small, saved(sizes, "warc-sizes"), "payload_digest", "n")
    return joined.select("page_id", F.when(response, F.col("own_bytes")).otherwise(F.col("payload_bytes"))
                         .alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first, strlen(html) AS n FROM p)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to FROM g
"""
