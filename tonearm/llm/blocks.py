"""Moving packed arrays between tasks, and tables that cut lineage.

A text table is held as chunks: rows that carry some MB of texts (and other columns) as one
compressed Arrow batch. A task that works on a chunk asks questions about its words or spans
by sending one packed row to each of many hash buckets; the task of a bucket sees the
questions of all chunks, combines them, and sends one packed row back to each chunk. Spark
deals both out by key; the rows are few and large, and what they hold is sorted and combined
with numpy. A chunk asks about each distinct word or span once, so that a hot one adds at
most one entry per chunk to its bucket.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tonearm.llm.texts import batch
from tonearm.session import shared_folder

CHUNK_BYTES = 16 << 20
try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):
    _trim = None
PART = "bucket int, chunk long, body binary"


def _hand_back() -> None:
    """Returns freed memory to the system: workers are kept for later tasks, and an executor's limit holds for all."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """`df.mapInArrow`, with the task's memory handed back at its end."""

    def tidy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _hand_back()

    return df.mapInArrow(tidy, schema)


def written(df: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """The table, written to the shared folder and read from there: its lineage ends here."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the folder of a table that `written` gave and that nothing reads any more."""
    hadoop = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = hadoop.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Tables written in the block leave no shuffle files behind; otherwise these stay until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(a) for a in arrays], "<i8")
    return b"".join([sizes.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def unpack(body, *kinds) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(body, "<i8", len(kinds)), 8 * len(kinds), []
    for size, kind in zip(sizes, kinds):
        out.append(np.frombuffer(body, kind, size, at))
        at += int(size) * np.dtype(kind).itemsize
    return out


def dense(*arrays: np.ndarray) -> bytes:
    """As `pack`, compressed with the bytes of the same weight side by side, so that small numbers take few bytes."""
    sizes = np.array([len(a) for a in arrays], "<i8")
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() for a in arrays]
    return sizes.tobytes() + (pa.compress(b"".join(planes), "zstd", asbytes=True) if sizes.any() else b"")


def loose(body, *kinds) -> list[np.ndarray]:
    """The arrays that `dense` packed."""
    sizes = np.frombuffer(body, "<i8", len(kinds))
    widths = [np.dtype(kind).itemsize for kind in kinds]
    whole, at, out = int(sizes @ np.array(widths)), 0, []
    data = pa.decompress(memoryview(body)[8 * len(kinds) :], whole, "zstd", asbytes=True) if whole else b""
    for size, width, kind in zip(sizes.tolist(), widths, kinds):
        planes = np.frombuffer(data, np.uint8, size * width, at).reshape(width, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size * width
    return out


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(body) -> pa.RecordBatch:
    table = pa.ipc.open_stream(body).read_all().combine_chunks()
    batches = table.to_batches()
    return batches[0] if batches else pa.RecordBatch.from_pylist([], table.schema)


def task_number() -> int:
    return TaskContext.get().partitionId()


def chunked(df: DataFrame, text: str, purpose: str, limit: int = CHUNK_BYTES) -> DataFrame:
    """All rows and columns of `df` as written chunks of about `limit` bytes of text: (chunk, size, body).

    A text longer than the limit is a chunk of its own. Chunk numbers are fixed by writing them.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = task_number() << 32, [], 0

        def closed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            return batch(chunk=([number], pa.int64()), size=([size], pa.int64()), body=([to_bytes(table)], pa.binary()))

        for rows in batches:
            lengths = pc.fill_null(pc.binary_length(rows.column(text)), 0).to_numpy(zero_copy_only=False)
            first = 0
            for i, n in enumerate(lengths.tolist()):
                if size and size + n > limit:
                    if i > first:
                        held.append(rows.slice(first, i - first))
                    yield closed()
                    number, held, size, first = number + 1, [], 0, i
                size += n
            if len(rows) > first:
                held.append(rows.slice(first))
        if held:
            yield closed()

    return written(mapped(df, cut, "chunk long, size long, body binary"), purpose, "uncompressed")


def share_count(chunks: DataFrame) -> int:
    """Shares of about 32 MB of texts."""
    return int(chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // (32 << 20) + 1)


def task_count(chunks: DataFrame) -> int:
    """Tasks for a share of the texts each, or the session's number if that is larger."""
    return max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), share_count(chunks))


def bucket_edges(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins and ends in sorted hashes; buckets are equal ranges of hashes."""
    starts = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)
    inner = np.searchsorted(sorted_hashes, starts)
    return np.concatenate([[0], inner, [len(sorted_hashes)]])


def parts(rows: Iterable[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Packed rows as batches of a few MB."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size > 4 << 20:
            yield _part_batch(held)
            held, size = [], 0
    if held:
        yield _part_batch(held)


def _part_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    bucket, chunk, body = zip(*rows)
    return batch(bucket=(bucket, pa.int32()), chunk=(chunk, pa.int64()), body=(body, pa.binary()))


def runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """Consecutive rows with the same key, each row as a dict of Arrow scalars' values or buffers."""

    def rows():
        for b in batches:
            columns = [b.column(i) for i in range(b.num_columns)]
            large = [pa.types.is_binary(c.type) or pa.types.is_large_binary(c.type) for c in columns]
            for i in range(len(b)):
                yield {
                    name: (c[i].as_buffer() if big else c[i].as_py())
                    for name, c, big in zip(b.schema.names, columns, large)
                }

    source = rows()
    row = next(source, None)
    while row is not None:
        current = row[key]

        def group():
            nonlocal row
            while row is not None and row[key] == current:
                yield row
                row = next(source, None)

        members = group()
        yield current, members
        for _ in members:
            pass


def to_buckets(questions: DataFrame) -> DataFrame:
    return questions.repartition("bucket").sortWithinPartitions("bucket")


def to_chunks(chunks: DataFrame, answers: DataFrame, tasks: int) -> DataFrame:
    """Each chunk behind the answers to its questions: rows (chunk, bucket, body), the chunk's own with the last bucket."""
    own = chunks.select("chunk", F.lit(2**31 - 1).alias("bucket"), "body")
    both = answers.select("chunk", "bucket", "body").unionByName(own)
    return both.repartition(tasks, "chunk").sortWithinPartitions("chunk", "bucket")


IS_CHUNK = 2**31 - 1
