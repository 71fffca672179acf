"""Token ids in files of independent zstandard frames with a seek table.

A file holds the ids of its documents one behind the other, in frames of `FRAME_IDS` ids, each a
whole zstandard frame; then a skippable frame with the document index (ids and lengths,
compressed); then the seek table, a skippable frame in the seekable format of zstandard: for each
frame its compressed and decompressed size and the low 32 bits of the XXH64 of its content. A
reader seeks to the end, reads table and index, and decompresses only the frames of the documents
it wants; a frame whose checksum doesn't match is an error. Any zstandard tool reads the ids, as it
passes over skippable frames.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tonearm.llm.blocks import mapped, task_number, written
from tonearm.llm.files import new_file, opened
from tonearm.llm.texts import batch
from tonearm.llm.tokens import encoded, largest_id
from tonearm.session import shared_folder

FRAME_IDS = 1 << 17
FILE_BYTES = 32 << 20
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
NO_ID = -(1 << 63)


def width_for(largest: int) -> str:
    """The kind of number that holds ids up to `largest`: two bytes, or four."""
    return "<u2" if largest < 1 << 16 else "<u4"


class TokenFileWriter:
    """Writes documents to one file, ids in numbers of one kind; an id that doesn't fit is an error."""

    def __init__(self, out, kind: str = "<u2", level: int = 3):
        self.out, self.kind = out, np.dtype(kind)
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.held, self.waiting, self.frames = [], 0, []
        self.doc_ids, self.lengths, self.size = [], [], 0

    def add(self, ids: np.ndarray, doc_ids: list, lengths: np.ndarray) -> None:
        """Appends the ids of some documents; a null document id is kept as such."""
        if len(ids) and int(ids.max()) > np.iinfo(self.kind).max:
            raise ValueError(f"id {int(ids.max())} doesn't fit into {self.kind.itemsize} bytes")
        self.doc_ids.append(np.array([NO_ID if d is None else d for d in doc_ids], "<i8"))
        self.lengths.append(lengths.astype("<i8"))
        self.held.append(ids.astype(self.kind))
        self.waiting += len(ids)
        if self.waiting >= FRAME_IDS:
            joined = np.concatenate(self.held)
            whole = len(joined) // FRAME_IDS * FRAME_IDS
            for at in range(0, whole, FRAME_IDS):
                self._frame(joined[at : at + FRAME_IDS].tobytes())
            self.held, self.waiting = [joined[whole:]], len(joined) - whole

    def _frame(self, raw: bytes) -> None:
        packed = self.compressor.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.size += len(packed)

    def close(self) -> None:
        rest = np.concatenate(self.held) if self.held else np.zeros(0, self.kind)
        if len(rest):
            self._frame(rest.tobytes())
        doc_ids = np.concatenate(self.doc_ids) if self.doc_ids else np.zeros(0, "<i8")
        lengths = np.concatenate(self.lengths) if self.lengths else np.zeros(0, "<i8")
        index = struct.pack("<QH", len(doc_ids), self.kind.itemsize) + self.compressor.compress(doc_ids.tobytes() + lengths.tobytes())
        index = struct.pack("<II", INDEX_MAGIC, len(index)) + index
        self.out.write(index)
        entries = b"".join(struct.pack("<III", *frame) for frame in [*self.frames, (len(index), 0, 0)])
        table = entries + struct.pack("<IBI", len(self.frames) + 1, 0x80, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        self.size += len(index) + len(table) + 8


class TokenFile:
    """Reads any documents of one file."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        count, flags, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != FOOTER_MAGIC or flags != 0x80:
            raise ValueError("no seek table")
        table = np.frombuffer(self._bytes(size - 9 - 12 * count, 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.starts = np.concatenate([[0], np.cumsum(table[:-1, 1])])
        self.checksums = table[:-1, 2]
        index = self._bytes(int(self.places[-2]), int(table[-1, 0]))
        documents, width = struct.unpack("<QH", index[8:18])
        values = np.frombuffer(zstandard.ZstdDecompressor().decompress(index[18:], max_output_size=16 * documents), "<i8")
        self.kind = np.dtype(f"<u{width}")
        self.doc_ids, self.lengths = values[:documents], values[documents:]
        self.bounds = np.concatenate([[0], np.cumsum(self.lengths)])

    def _bytes(self, at: int, count: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(count)

    def _frame(self, number: int) -> bytes:
        packed = self._bytes(int(self.places[number]), int(self.places[number + 1] - self.places[number]))
        size = int(self.starts[number + 1] - self.starts[number])
        raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checksums[number]:
            raise ValueError(f"frame {number} is damaged")
        return raw

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of documents first .. last - 1, from the frames that hold them."""
        begin, end = (int(b) * self.kind.itemsize for b in (self.bounds[first], self.bounds[last]))
        if begin == end:
            return np.zeros(0, self.kind)
        a = int(np.searchsorted(self.starts, begin, side="right")) - 1
        b = int(np.searchsorted(self.starts, end, side="left"))
        raw = b"".join(self._frame(k) for k in range(a, b))
        return np.frombuffer(raw, self.kind)[(begin - int(self.starts[a])) // self.kind.itemsize :][: (end - begin) // self.kind.itemsize]


def write_token_files(texts: DataFrame, folder: str, tokenizer: str, end_id: int, files: int) -> DataFrame:
    """Writes (doc_id, text) in the order of doc_id to about `files` files; returns (number, path, documents, ids) of each."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next((b for b in batches if len(b)), None)
        if first is None:
            return
        number = task_number()
        path, documents, total = f"{folder}/part-{number:06d}.ids.zst", 0, 0

        def rest():
            yield first
            yield from batches

        with new_file(path) as out:
            writer = TokenFileWriter(out, width_for(largest_id(tokenizer, end_id)))
            for rows in rest():
                doc_ids = rows.column("doc_id").to_pylist()
                for begin, last, ids, bounds in encoded(rows.column("text"), tokenizer, end_id):
                    writer.add(ids, doc_ids[begin:last], np.diff(bounds))
                    documents, total = documents + last - begin, total + len(ids)
            writer.close()
        yield batch(
            number=([number], pa.int64()), path=([path], pa.string()), documents=([documents], pa.int64()),
            ids=([total], pa.int64()),
        )

    ordered = texts.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return written(ordered.transform(mapped, write, "number long, path string, documents long, ids long"), "token-files")


def read_token_files(files: DataFrame, documents_per_task: int = 4096, with_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it in all files), n_tokens and ids_crc32.

    A task reads a range of documents and decompresses the frames that hold them.
    """
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("documents") - 1, F.lit(documents_per_task).cast("long")))
    ranges = placed.where("documents > 0").select("path", "documents", "before", first.alias("first"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                with opened(row["path"]) as stream:
                    file = TokenFile(stream)
                    stop = min(row["first"] + documents_per_task, row["documents"])
                    for a in range(row["first"], stop, 512):
                        b = min(a + 512, stop)
                        yield _documents(file, a, b, row["before"], with_ids)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    return ranges.repartition("path", "first").transform(mapped, read, schema)


def _documents(file: TokenFile, a: int, b: int, before: int, with_ids: bool) -> pa.RecordBatch:
    ids = file.ids(a, b).astype("<u4")
    bounds = file.bounds[a : b + 1] - file.bounds[a]
    raw = ids.tobytes()
    view = memoryview(raw)
    each = [view[4 * s : 4 * e] for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    doc_ids = [None if d == NO_ID else d for d in file.doc_ids[a:b].tolist()]
    return batch(
        doc_id=(doc_ids, pa.int64()), start=(file.bounds[a:b] + before, pa.int64()), n_tokens=(np.diff(bounds), pa.int64()),
        ids_crc32=([zlib.crc32(e) for e in each], pa.int64()),
        ids=([bytes(e) if with_ids else None for e in each], pa.binary()),
    )


def token_files(df: DataFrame, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Writes the ids of all texts and reads them back: one row per document.

    Documents are ordered by id, rows of one id by a hash of the text, rows without id first; rows of
    one id share a file. A null text is empty and has the end id alone. An empty table gives no rows.
    """
    texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spark = df.sparkSession
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), texts.count() * 4096 // FILE_BYTES)
    folder = shared_folder(spark, "tokens")
    return read_token_files(write_token_files(texts, folder, tokenizer, end_id, int(files)), with_ids=with_ids)
