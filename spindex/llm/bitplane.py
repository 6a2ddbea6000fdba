"""Token ids in files of bit or byte planes.

Documents are range-partitioned by id; each task writes its share as one file,
so the files in order hold all ids in ascending document order. A file is cut
into blocks of 65,536 ids. A block is transposed into planes (one byte or bit
of every id), planes of zeros are left out, the others compressed by
zstandard. The footer holds the chunk index (offset, ids and plane sizes of
every block) and each document's id and length, so a reader gets any block or
document without the rest.

  file    = block* footer length-of-footer(8) crc32-of-footer(4) magic(4)
  footer  = zstandard of: JSON header, then int64 arrays (block offsets, block
            lengths, plane sizes, document ids, null marks, document lengths)

A task writes under a name of its own and renames at the end; a task that runs
again writes the same bytes to the same place.

Null text is an empty text (the end token alone). Null ids come first, repeated
ids stand next to each other (by their text's hash), repeated rows are all
kept, other columns are not read. An empty table gives no file and no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rows, columns_of, filesystem, id_text, saved, workers
from .token_ids import encoder, packed

BLOCK = 65_536
MAGIC = b"BPL1"
MANIFEST = "part int, path string, n_docs long, n_tokens long, n_bytes long"
MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                            ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])
DOCS = "doc_id long, start long, n_tokens long, ids binary"
SUMS = "doc_id long, start long, n_tokens long, ids_crc32 long"
SUMS_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
DOCS_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The 4 byte planes or 32 bit planes of uint32 ids, lowest first; a plane of zeros is empty."""
    by_byte = np.ascontiguousarray(ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T)
    out = []
    for plane in by_byte:
        if not plane.any():
            out += [b""] * (1 if unit == "byte" else 8)
        elif unit == "byte":
            out.append(plane.tobytes())
        else:
            bits = (np.packbits(plane >> b & 1) for b in range(8))
            out += [p.tobytes() if p.any() else b"" for p in bits]
    return out


def from_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    """The inverse of ``to_planes``."""
    by_byte = np.zeros((n, 4), np.uint8)
    for k in range(4):
        if unit == "byte":
            if planes[k]:
                by_byte[:, k] = np.frombuffer(planes[k], np.uint8)
        else:
            for b in range(8):
                if planes[8 * k + b]:
                    by_byte[:, k] |= np.unpackbits(np.frombuffer(planes[8 * k + b], np.uint8), count=n) << b
    return by_byte.reshape(-1).view("<u4")


class Writer:
    """One file, block by block."""

    def __init__(self, stream, unit: str, level: int):
        import zstandard

        self.stream, self.unit, self.zip = stream, unit, zstandard.ZstdCompressor(level=level)
        self.at, self.pending, self.held = 0, [], 0
        self.offsets, self.lengths, self.sizes, self.ids, self.nulls, self.tokens = [], [], [], [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.tokens.append(len(ids) // 4)
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= 4 * BLOCK:
            whole = b"".join(self.pending)
            cut = len(whole) - len(whole) % (4 * BLOCK)
            for k in range(0, cut, 4 * BLOCK):
                self.block(whole[k:k + 4 * BLOCK])
            self.pending, self.held = [whole[cut:]], len(whole) - cut

    def block(self, ids: bytes) -> None:
        planes = [self.zip.compress(p) if p else b"" for p in to_planes(np.frombuffer(ids, "<u4"), self.unit)]
        self.offsets.append(self.at)
        self.lengths.append(len(ids) // 4)
        self.sizes += [len(p) for p in planes]
        self.at += self.stream.write(b"".join(planes))

    def close(self) -> int:
        if self.held:
            self.block(b"".join(self.pending))
        arrays = [self.offsets, self.lengths, self.sizes, self.ids, self.nulls, self.tokens]
        head = json.dumps({"unit": self.unit, "block": BLOCK, "arrays": [len(a) for a in arrays]}).encode()
        foot = self.zip.compress(len(head).to_bytes(8, "little") + head
                                 + b"".join(np.array(a, "<i8").tobytes() for a in arrays))
        self.stream.write(foot + len(foot).to_bytes(8, "little") + zlib.crc32(foot).to_bytes(4, "little") + MAGIC)
        return self.at + len(foot) + 16


class Reader:
    """Blocks and documents of one file, by its index."""

    def __init__(self, file, size: int):
        import zstandard

        self.file, self.zip = file, zstandard.ZstdDecompressor()
        file.seek(size - 16)
        tail = file.read(16)
        if tail[12:] != MAGIC:
            raise ValueError("not a plane file, or cut short")
        n = int.from_bytes(tail[:8], "little")
        file.seek(size - 16 - n)
        foot = file.read(n)
        if zlib.crc32(foot) != int.from_bytes(tail[8:12], "little"):
            raise ValueError("the footer is damaged")
        foot = self.zip.decompress(foot)
        start = 8 + int.from_bytes(foot[:8], "little")
        head = json.loads(foot[8:start])
        self.unit, arrays = head["unit"], []
        for k in head["arrays"]:
            arrays.append(np.frombuffer(foot, "<i8", k, start))
            start += 8 * k
        self.offsets, self.lengths, self.sizes, self.ids, self.nulls, self.tokens = arrays
        self.sizes = self.sizes.reshape(len(self.offsets), -1)

    def block(self, k: int) -> np.ndarray:
        """The ids of block k."""
        self.file.seek(int(self.offsets[k]))
        data, at, planes = self.file.read(int(self.sizes[k].sum())), 0, []
        for size in self.sizes[k].tolist():
            planes.append(self.zip.decompress(data[at:at + size]) if size else b"")
            at += size
        return from_planes(planes, int(self.lengths[k]), self.unit)

    def documents(self) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids) in file order, holding one block and one document."""
        k, held = 0, b""
        for doc_id, null, n in zip(self.ids.tolist(), self.nulls.tolist(), self.tokens.tolist(), strict=True):
            parts, need = [], 4 * n
            while need:
                if not held:
                    held, k = self.block(k).tobytes(), k + 1
                parts.append(held[:need])
                held, need = held[need:], need - len(parts[-1])
            yield None if null else doc_id, b"".join(parts)


def write_part(batches: Iterator[pa.RecordBatch], out: str, path: str, end_id: int, unit: str,
               level: int) -> Iterator[pa.RecordBatch]:
    task, writer, enc, end = TaskContext.get(), None, encoder(path), packed([end_id])
    fs, folder = filesystem(out)
    name = f"{folder}/part-{task.partitionId():06d}.bpl"
    for batch in batches:
        for doc_id, text in columns_of(batch, "doc_id", "text"):
            if writer is None:
                fs.create_dir(folder, recursive=True)
                stream = fs.open_output_stream(f"{name}.{task.taskAttemptId()}", compression=None)
                writer = Writer(stream, unit, level)
            writer.add(doc_id, enc.ids(text) + end)
    if writer is not None:
        size = writer.close()
        stream.close()
        fs.move(f"{name}.{task.taskAttemptId()}", name)
        yield pa.RecordBatch.from_pylist([{"part": task.partitionId(), "path": f"{out}/{name.rpartition('/')[2]}",
                                           "n_docs": len(writer.ids), "n_tokens": sum(writer.tokens),
                                           "n_bytes": size}], MANIFEST_ARROW)


def write_planes(docs: DataFrame, out: str, path: str, end_id: int, unit: str = "byte", level: int = 1) -> DataFrame:
    """Encode, append ``end_id`` to each document and write the files; their
    manifest (one row a file, saved, so the files are written once)."""
    workers(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_first(), F.col("_llm_tie")]
    ranged = (id_text(docs).withColumn("_llm_tie", F.xxhash64("text"))
              .repartitionByRange(*order).sortWithinPartitions(*order).drop("_llm_tie"))
    return saved(ranged.mapInArrow(partial(write_part, out=out, path=path, end_id=end_id, unit=unit, level=level),
                                   MANIFEST), "planes-manifest")


def read_part(batches: Iterator[pa.RecordBatch], sums: bool) -> Iterator[pa.RecordBatch]:
    rows = Rows(SUMS_ARROW if sums else DOCS_ARROW)
    for batch in batches:
        for file, start in columns_of(batch, "path", "base"):
            fs, name = filesystem(file)
            with fs.open_input_file(name) as f:
                for doc_id, ids in Reader(f, f.size()).documents():
                    rows.add(doc_id, start, len(ids) // 4, zlib.crc32(ids) if sums else ids, weight=0 if sums else len(ids))
                    start += len(ids) // 4
                    if rows.full():
                        yield rows.take()
    if len(rows):
        yield rows.take()


def read_planes(spark: SparkSession, manifest: DataFrame, sums: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of all files, one task a
    file; with ``sums`` a checksum ``ids_crc32`` of the ids in their place,
    taken where they are read. The manifest has one row a file, which is one a task of the writing
    job: the driver numbers the files' first ids."""
    workers(spark)
    files, base, rows = sorted(manifest.select("part", "path", "n_tokens").collect()), 0, []
    for _, file, n in files:
        rows.append((file, base))
        base += n
    table = spark.createDataFrame(rows, "path string, base long")
    if rows:
        table = table.repartitionByRange(len(rows), "base")
    return table.mapInArrow(partial(read_part, sums=sums), SUMS if sums else DOCS)


def digests(read: DataFrame) -> DataFrame:
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
