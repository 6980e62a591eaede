"""Token ids of documents in files of independent zstandard frames that can be read document by document.

A file is a row of zstandard frames, each with up to ``FRAME_IDS`` ids (unsigned little-endian 32-bit) of one
document, then a skippable frame with the documents' ids and their numbers of frames, and last the seek table
of the public seekable format: a skippable frame that lists the compressed size, decompressed size and
checksum (low half of XXH64) of every frame before it. Any zstandard tool unpacks such a file as one stream
of ids. A reader takes the seek table from the end, the list of documents before it, and then reads and
unpacks the frames of the documents it wants, and checks each against its checksum.

Documents are sorted into range partitions by doc_id and each task writes one file. Its name holds the task
attempt, and the manifest, which Spark commits, names the attempt that counts; files of lost attempts are
named by nobody. Files lie in the shared folder and are opened by pyarrow's file systems (local, HDFS, S3,
GCS). Tasks hold some MB of texts and 13 bytes per document and 12 per frame of one file.

Inputs: documents (doc_id, text). Cases: a null or empty text is the end id alone; rows of one doc_id, null
ones first of all, follow each other in the order of a hash of their text and are documents of their own, so
equal rows differ in ``start`` only; a text of any length is cut into frames; other columns are ignored; an
empty table gives no file and no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext
from xxhash import xxh64_intdigest

from ticketloom.llm.common import buckets_for, shared, opened, stored, table
from ticketloom.llm.registry import query
from ticketloom.llm.tokens import TOKENIZER, encoder, slices
from ticketloom.session import scratch_path

END_ID = 0
FRAME_IDS = 1 << 18
#: Bytes of text in a file, up to MAX_FILES files; beyond that, files grow.
FILE_BYTES = 64_000_000
MAX_FILES = 100_000
LEVEL = 3
#: Bytes of ids that a reading task hands over at once, one document at least.
READ_BYTES = 4_000_000

# Fixed values of the public seekable format: kinds of skippable frames, mark at the end, flag for checksums.
_INDEX_FRAME, _SEEK_FRAME, _SEEKABLE, _CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_FOOTER, _FOOTER_BYTES = "<IBI", 9
_HEADER, _HEADER_BYTES = "<II", 8

_MANIFEST = "part int, file string, first_id long, last_id long, documents long, tokens long, bytes long"
_DOCUMENTS = "doc_id long, start long, ids binary"


class FrameWriter:
    """Writes documents one after the other to a binary stream; ``close`` adds the list of documents and the seek table."""

    def __init__(self, out, level: int = LEVEL):
        self.out, self.packer = out, zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int, int]] = []
        self.documents: list[tuple[int, bool, int]] = []
        self.tokens = self.bytes = 0

    def _put(self, data: bytes, unpacked: int, check: int) -> None:
        self.out.write(data)
        self.bytes += len(data)
        self.frames.append((len(data), unpacked, check))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        before = len(self.frames)
        for lo in range(0, len(ids), 4 * FRAME_IDS):
            part = ids[lo : lo + 4 * FRAME_IDS]
            self._put(self.packer.compress(part), len(part), xxh64_intdigest(part) & 0xFFFFFFFF)
        self.documents.append((doc_id or 0, doc_id is None, len(self.frames) - before))
        self.tokens += len(ids) // 4

    def close(self) -> None:
        named = np.array(self.documents, dtype=[("id", "<i8"), ("null", "?"), ("frames", "<u4")])
        self._put(struct.pack(_HEADER, _INDEX_FRAME, named.nbytes) + named.tobytes(), 0, xxh64_intdigest(b"") & 0xFFFFFFFF)
        table = np.array(self.frames, dtype="<u4").tobytes()
        last = struct.pack(_HEADER, _SEEK_FRAME, len(table) + _FOOTER_BYTES) + table
        last += struct.pack(_FOOTER, len(self.frames), _CHECKSUMS, _SEEKABLE)
        self.out.write(last)
        self.bytes += len(last)


class FrameReader:
    """Documents of one file by their place in it; ``source`` is a binary file open for random access."""

    def __init__(self, source, size: int):
        self.source = source
        count, flags, mark = struct.unpack(_FOOTER, self._read(size - _FOOTER_BYTES, _FOOTER_BYTES))
        if mark != _SEEKABLE or flags != _CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = np.frombuffer(self._read(size - _FOOTER_BYTES - 12 * count, 12 * count), dtype="<u4").reshape(count, 3)
        self.packed, self.unpacked, self.check = table.astype(np.int64).T
        self.at = np.concatenate([[0], np.cumsum(self.packed)])
        named = self._read(int(self.at[-2]) + _HEADER_BYTES, int(self.packed[-1]) - _HEADER_BYTES)
        named = np.frombuffer(named, dtype=[("id", "<i8"), ("null", "?"), ("frames", "<u4")])
        self.ids, self.null = named["id"], named["null"]
        self.first = np.concatenate([[0], np.cumsum(named["frames"].astype(np.int64))])
        self.start = np.concatenate([[0], np.cumsum(self.unpacked)])[self.first] // 4  # ids before each document
        self.unpacker = zstandard.ZstdDecompressor()

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def __len__(self) -> int:
        return len(self.ids)

    def document(self, k: int) -> bytes:
        """Ids of the k-th document, from its own frames only."""
        lo, hi = int(self.first[k]), int(self.first[k + 1])
        packed = memoryview(self._read(int(self.at[lo]), int(self.at[hi] - self.at[lo])))
        out = []
        for n in range(lo, hi):
            part = packed[self.at[n] - self.at[lo] : self.at[n + 1] - self.at[lo]]
            data = self.unpacker.decompress(part, max_output_size=int(self.unpacked[n]))
            if xxh64_intdigest(data) & 0xFFFFFFFF != self.check[n]:
                raise ValueError(f"frame {n} does not match its checksum")
            out.append(data)
        return b"".join(out)

    def places(self, doc_id: int) -> range:
        """Places of the documents of that id; ids ascend in a file, null ones come first."""
        nulls = int(self.null.sum())
        return range(*(nulls + int(np.searchsorted(self.ids[nulls:], doc_id, side)) for side in ("left", "right")))


def _written(folder: str, tokenizer: str, end: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Writes the rows of a task to one file and yields its row of the manifest; a task without rows writes none."""
    encode, task = encoder(tokenizer), TaskContext.get()
    system, path = fs.FileSystem.from_uri(folder)
    name = f"{task.partitionId():06d}-{task.taskAttemptId()}.zst"
    out = writer = first = last = None
    try:
        for batch in batches:
            for part in slices(batch, "text"):
                if writer is None:
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                    writer = FrameWriter(out)
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text"))):
                    writer.add(doc_id, ids + end)
                    first, last = doc_id if first is None else first, doc_id
        if writer is not None:
            writer.close()
    finally:
        if out is not None:
            out.close()
    if writer is not None:
        row = (task.partitionId(), name, first, last, len(writer.documents), writer.tokens, writer.bytes)
        names = [x.split()[0] for x in _MANIFEST.split(", ")]
        yield pa.RecordBatch.from_pylist([dict(zip(names, row))], schema=_MANIFEST_ARROW)


_MANIFEST_ARROW = pa.schema(
    [("part", pa.int32()), ("file", pa.string()), *[(n, pa.int64()) for n in ("first_id", "last_id", "documents", "tokens", "bytes")]]
)


def write_frames(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Writes the documents' ids to files in ``folder`` and returns the manifest: one row per file, in order of doc_id.

    ``start`` is the number of ids in all files before.
    """
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = min(MAX_FILES, buckets_for(total, FILE_BYTES))
    keys = ["doc_id", "__mark", "__row"]
    dealt = source.withColumn("__mark", F.xxhash64("text")).withColumn("__row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(files, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    write = partial(_written, folder, tokenizer, np.array([end_id], dtype="<u4").tobytes())
    return stored(_with_starts(stored(dealt.mapInArrow(write, _MANIFEST))))


def _with_starts(manifest: DataFrame) -> DataFrame:
    """Adds the ids of all files before: within runs of 1024 files, and of the runs before."""
    run = F.floor(F.col("part") / 1024)
    by_run = manifest.groupBy(run.alias("__run")).agg(F.sum("tokens").alias("__n"))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    shift = by_run.select("__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__run").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        manifest.withColumn("__run", run)
        .withColumn("__upto", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .join(shift, "__run")
        .withColumn("start", F.col("__upto") + F.col("__before"))
        .drop("__run", "__upto", "__before")
    )


def _rows(found: Iterator[tuple[int | None, int, bytes]]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[int | None, int, bytes]] = []
    size = 0

    def batch():
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "start", "ids"])

    for row in found:
        rows.append(row)
        size += len(row[2])
        if size >= READ_BYTES:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def _read_all(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    system, path = fs.FileSystem.from_uri(folder)

    def found():
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                full = f"{path}/{name}"
                with system.open_input_file(full) as source:
                    reader = FrameReader(source, system.get_file_info(full).size)
                    for k in range(len(reader)):
                        yield None if reader.null[k] else int(reader.ids[k]), base + int(reader.start[k]), reader.document(k)

    yield from _rows(found())


def read_frames(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: doc_id, ids of all documents before it, and its own ids."""
    files = manifest.select("file", "start", "part")
    top = files.agg(F.max("part")).first()[0]
    dealt = files.repartitionById(1 if top is None else top + 1, F.col("part"))
    return dealt.select("file", "start").mapInArrow(partial(_read_all, folder), _DOCUMENTS)


def _read_some(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows are sorted by file: each is opened once."""
    system, path = fs.FileSystem.from_uri(folder)

    def found():
        name, source, reader = None, None, None
        try:
            for batch in batches:
                for file, base, doc_id in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "doc_id"))):
                    if file != name:
                        if source is not None:
                            source.close()
                        full, name = f"{path}/{file}", file
                        source = system.open_input_file(full)
                        reader = FrameReader(source, system.get_file_info(full).size)
                    for k in reader.places(doc_id):
                        yield doc_id, base + int(reader.start[k]), reader.document(k)
        finally:
            if source is not None:
                source.close()

    yield from _rows(found())


def _holders(files, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, last, part = opened(files)
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        lo, hi = np.searchsorted(last, ids, "left"), np.searchsorted(first, ids, "right")
        times = np.maximum(hi - lo, 0)
        ends = np.cumsum(times)
        at = np.arange(times.sum()) + np.repeat(lo - ends + times, times)
        yield pa.RecordBatch.from_arrays([pa.array(part[at], pa.int32()), pa.array(np.repeat(ids, times))], names=["part", "doc_id"])


def read_documents(manifest: DataFrame, folder: str, wanted: DataFrame, tasks: int = 64) -> DataFrame:
    """The documents whose doc_id is in ``wanted``; only their frames are read and unpacked.

    The first and last doc_id of each file, at most ``MAX_FILES`` pairs, are broadcast to find the files.
    """
    known = manifest.where("last_id is not null").select("first_id", "last_id", "part").orderBy("part").toPandas()
    files = shared(manifest.sparkSession, tuple(known[c].to_numpy() for c in ("first_id", "last_id", "part")))
    ids = wanted.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    held = ids.mapInArrow(partial(_holders, files), "part int, doc_id long").join(manifest.select("part", "file", "start"), "part")
    dealt = held.repartition(tasks, "file").sortWithinPartitions("file", "doc_id")
    return dealt.select("file", "start", "doc_id").mapInArrow(partial(_read_some, folder), _DOCUMENTS)


def token_rows(found: DataFrame) -> DataFrame:
    """A row per document read: place, length and CRC-32 of its ids."""
    count: Column = (F.length("ids") / 4).cast("long")
    return found.select("doc_id", "start", count.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query("op11_token_frames")
def op11_token_frames(spark, sf_dir):
    folder = scratch_path(spark, "frames")
    manifest = write_frames(table(spark, sf_dir, "documents"), folder)
    return token_rows(read_frames(manifest, folder))
