"""Files of token ids: coded blocks, a table of documents at the end, checksums throughout.

A file holds the ids of whole documents one after another, in blocks of ``idcoder``; a
document may go on in the next block, and each block can be decoded on its own. Behind the
blocks stand the documents' ids and lengths. Files are written in ascending order of
document id over the files' numbers, and each is moved to its name when it is whole, so a
task that runs again replaces nothing by something else.

Null texts count as empty; repeated rows are written as often as they occur; rows without
an id come first. An empty table makes no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plotwise.llm import idcoder, tokens
from plotwise.llm.common import columns, records, ship, slices
from plotwise.session import new_folder, staged

#: Blocks of a file at most.
FILE_BLOCKS = 16
TAIL = struct.Struct("<QQIII4s")  # place and bytes of the table, its crc, documents, blocks, mark
TAIL_MARK = b"IDF1"

MANIFEST = pa.schema([("file", pa.string()), ("part", pa.int64()), ("number", pa.int64()), ("documents", pa.int64()), ("ids", pa.int64())])
DOCUMENT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


class Writer:
    """One file at a time; ``add`` may close it and begin the next."""

    def __init__(self, folder: str, part: int, block_ids: int, lanes: int):
        self.store, self.folder = pafs.FileSystem.from_uri(folder)
        self.part, self.block_ids, self.lanes, self.number = part, block_ids, lanes, 0
        self.done: list[tuple] = []
        self.out = None

    def open(self) -> None:
        self.name = f"{self.folder}/{self.part:06d}-{self.number:05d}.ids"
        self.temporary = f"{self.name}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.temporary)
        self.waiting: list[np.ndarray] = []
        self.held = self.blocks = self.total = 0
        self.doc_ids: list[pa.Array] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc_ids: pa.Array, bounds: np.ndarray, ids: np.ndarray) -> None:
        if self.out is None:
            self.open()
        self.doc_ids.append(doc_ids)
        self.counts.append(np.diff(bounds))
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.block_ids:
            self.flush(self.block_ids)
            if self.blocks >= FILE_BLOCKS:
                self.close()

    def flush(self, least: int) -> None:
        ids = np.concatenate(self.waiting)
        at = 0
        while len(ids) - at >= least and at < len(ids):
            self.out.write(idcoder.encode_block(ids[at:at + self.block_ids], self.lanes))
            at += self.block_ids
            self.blocks += 1
        self.waiting, self.held = [ids[at:]], max(0, len(ids) - at)

    def close(self) -> None:
        if self.out is None:
            return
        if self.held:
            self.flush(1)
        keys = pa.chunked_array(self.doc_ids, pa.int64()).combine_chunks()
        counts = np.concatenate(self.counts).astype("<i8")
        table = zlib.compress(b"".join((np.asarray(keys.is_valid()).astype("u1").tobytes(),
                                        np.asarray(keys.fill_null(0)).astype("<i8").tobytes(), counts.tobytes())))
        at = self.out.tell()
        self.out.write(table)
        self.out.write(TAIL.pack(at, len(table), zlib.crc32(table), len(counts), self.blocks, TAIL_MARK))
        self.out.close()
        self.store.move(self.temporary, self.name)
        self.done.append((self.name, self.part, self.number, len(counts), self.total))
        self.out = None
        self.number += 1


def write_ids(docs: DataFrame, vocabulary: str, end_id: int, folder: str, id_column: str = "doc_id", text_column: str = "text",
              block_ids: int = idcoder.BLOCK_IDS, lanes: int = idcoder.LANES) -> DataFrame:
    """Write the ids of all documents, each with ``end_id`` behind it, into ``folder``; one row per file.

    Texts are dealt by ranges of (id, text, row), so one id that holds a third of all rows
    is spread over many tasks as well.
    """
    spark = ship(docs.sparkSession)
    scheme = "" if "://" in folder or folder.startswith("file:") else "file://"
    pafs_folder = scheme + folder

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(pafs_folder, TaskContext.get().partitionId(), block_ids, lanes)
        encoder = tokens.encoder(vocabulary)  # the worker's next task finds the words that this one met
        for batch in slices(batches):
            bounds, ids = encoder.encode(batch.column("text"))
            ids = np.insert(ids, bounds[1:], end_id)
            writer.add(batch.column("doc_id"), bounds + np.arange(len(bounds)), ids)
        writer.close()
        if writer.done:
            yield pa.RecordBatch.from_pylist([dict(zip(MANIFEST.names, x, strict=True)) for x in writer.done], MANIFEST)

    make_folder(spark, folder)
    rows = columns(docs, doc_id=docs[id_column].cast("long"), text=docs[text_column].cast("string"),
                   row_id=F.monotonically_increasing_id()).withColumn("text_key", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), "text_key", "row_id"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return staged(ordered.mapInArrow(write, "file string, part long, number long, documents long, ids long"), "files")


def make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: id, ids before it in all files, its number of ids and their crc32.

    Only the manifest (a row per file) is ordered as a whole; files are decoded one per task.
    """
    ship(manifest.sparkSession)
    pafs_folder = folder if "://" in folder or folder.startswith("file:") else "file://" + folder

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(pafs_folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with store.open_input_file(name) as file:
                    yield from decode_file(file, start)

    w = W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("ids").over(w), F.lit(0)).alias("start"))
    return (files.repartition(max(1, manifest.count()))
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def blocks_of(file: pa.NativeFile, count: int) -> Iterator[np.ndarray]:
    file.seek(0)
    for _ in range(count):
        head = file.read(idcoder.HEAD.size)
        yield idcoder.decode_block(head + file.read(idcoder.block_size(head) - len(head)))


def documents_of(file: pa.NativeFile) -> tuple[pa.Array, np.ndarray, int]:
    """Ids and lengths of a file's documents, and its number of blocks."""
    file.seek(file.size() - TAIL.size)
    at, size, crc, documents, blocks, mark = TAIL.unpack(file.read(TAIL.size))
    file.seek(at)
    table = file.read(size)
    if mark != TAIL_MARK or zlib.crc32(table) != crc:
        raise ValueError("not a whole file of ids")
    table = zlib.decompress(table)
    valid = np.frombuffer(table, "u1", documents).astype(bool)
    numbers = np.frombuffer(table, "<i8", 2 * documents, documents)
    return pa.array(numbers[:documents], pa.int64(), mask=~valid), numbers[documents:], blocks


def decode_file(file: pa.NativeFile, start: int) -> Iterator[pa.RecordBatch]:
    doc_ids, counts, blocks = documents_of(file)
    ends = np.cumsum(counts)
    done, at, crc = 0, 0, 0  # documents given out, ids seen, checksum of the document that goes on
    for ids in blocks_of(file, blocks):
        raw = memoryview(ids.astype("<u4").tobytes())
        last = int(np.searchsorted(ends, at + len(ids), side="right"))
        sums, place = [], 0
        for end in (ends[done:last] - at).tolist():
            sums.append(zlib.crc32(raw[4 * place:4 * end], crc))
            place, crc = end, 0
        crc = zlib.crc32(raw[4 * place:], crc)
        at += len(ids)
        if last > done:
            yield records({"doc_id": doc_ids.slice(done, last - done), "start": start + ends[done:last] - counts[done:last],
                           "n_tokens": counts[done:last], "ids_crc32": sums}, DOCUMENT)
        done = last
    if done != len(counts):
        raise ValueError("a file ends before its documents do")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int, **options) -> DataFrame:
    """Write all documents into a new folder of the shared one, and read the files back. The folder goes with the staged tables."""
    folder = new_folder(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, vocabulary, end_id, folder, **options), folder)
