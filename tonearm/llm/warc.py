"""WARC archives: written with revisit records, read by tasks that each scan a range of bytes.

Every record is a gzip member of its own. A reading task looks for the gzip magic from the start
of its range, decodes what it finds far enough to see a WARC version line and a whole header, and
takes the first candidate that holds, with an intact member and another one or the end of the file
behind it. From there it goes from member to member. A task owns the records that start in its
range, and reads on behind the range to finish the last one. No index and no sequential pass over
the file is needed, and each record is read by one task.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tonearm.llm.blocks import mapped, task_number, written
from tonearm.llm.files import new_file, opened
from tonearm.llm.texts import batch
from tonearm.session import shared_folder

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 100
RANGE_BYTES = 8 << 20
STEP = 1 << 16
VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")
#: More than a version line has.
LINE = 64


def record(kind: str, page_id, refers_to, url, digest: str, size: int, payload: bytes, date: str) -> bytes:
    """One WARC record. A revisit carries the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(size)), ("Content-Length", str(len(block))),
    ]
    if url is not None:
        lines.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~")))
    if kind == "revisit":
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises ValueError if it isn't whole."""
    head, line, rest = data.partition(b"\r\n\r\n")
    if not line or not VERSION_LINE.match(head + b"\r\n"):
        raise ValueError("no WARC header")
    fields = {}
    for part in head.decode("utf-8").split("\r\n")[1:]:
        name, _, value = part.partition(":")
        fields[name.strip().lower()] = value.strip()
    size = int(fields["content-length"])
    if len(rest) < size:
        raise ValueError("the record's block is cut")
    return fields, rest[:size]


class Source:
    """Reads a file in steps from any place."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.at, self.held = stream, size, 0, b""

    def bytes_from(self, place: int, count: int) -> bytes:
        """Up to `count` bytes from `place`; what was read last is kept."""
        if not self.at <= place or place + count > self.at + len(self.held):
            self.stream.seek(place)
            self.at, self.held = place, self.stream.read(min(max(count, STEP), self.size - place))
        return self.held[place - self.at : place - self.at + count]

    def header_at(self, place: int) -> bool:
        """Whether a gzip member with a WARC header, of any length, starts there."""
        unpack, line, last, at, part = zlib.decompressobj(31), b"", b"", place, b""
        try:
            while not unpack.eof:
                if not part:
                    if at >= self.size:
                        return False
                    part = self.bytes_from(at, 4096)
                    at += len(part)
                out = unpack.decompress(part, STEP)
                part = unpack.unconsumed_tail
                line += out[: LINE - len(line)]
                if len(line) == LINE and not VERSION_LINE.match(line):
                    return False
                last += out
                if b"\r\n\r\n" in last:
                    return bool(VERSION_LINE.match(line))
                last = last[-3:]
        except zlib.error:
            pass
        return False

    def member_at(self, place: int) -> tuple[bytes, int]:
        """The content of the member that starts there, and the place behind it."""
        unpack, out, at = zlib.decompressobj(31), [], place
        while not unpack.eof:
            part = self.bytes_from(at, STEP)
            if not part:
                raise EOFError(f"the member at {place} is cut")
            out.append(unpack.decompress(part))
            at += len(part)
        return b"".join(out), at - len(unpack.unused_data)

    def first_member(self, start: int, stop: int) -> int | None:
        """The first place from start to stop - 1 where a record starts."""
        at = start
        while at < stop:
            found = self.bytes_from(at, STEP + 2).find(MAGIC)
            if found < 0:
                at += STEP
                continue
            at += found
            if at < stop and self.header_at(at):
                try:
                    _, behind = self.member_at(at)
                    if behind >= self.size or self.bytes_from(behind, 3) == MAGIC:
                        return at
                except (zlib.error, EOFError):
                    pass
            at += 1
        return None


def records(stream, size: int, start: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, header fields, block) of all records that start in start .. stop - 1."""
    source = Source(stream, size)
    at = source.first_member(start, min(stop, size))
    while at is not None and at < min(stop, size):
        data, behind = source.member_at(at)
        yield at, *parse(data)
        at = behind


def with_references(pages: DataFrame) -> DataFrame:
    """Adds payload_digest, refers_to (null for responses) to (page_id, url, payload).

    Of rows with equal payloads of 100 bytes or more, those with the smallest id are responses.
    """
    long = F.length("payload") >= LEAST_REVISIT
    named = pages.withColumn("payload_digest", F.sha2("payload", 256))
    first = named.where(long).groupBy("payload_digest").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    first = first.where("n > 1").drop("n")
    joined = named.join(first, "payload_digest", "left")
    refers = F.when(long & F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least")), F.col("least"))
    return joined.withColumn("refers_to", refers).drop("least")


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Writes one archive per task to `folder`, one record per row; returns (path, bytes, records) of the files."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next((b for b in batches if len(b)), None)
        if first is None:
            return
        path, size, count = f"{folder}/part-{task_number():06d}.warc.gz", 0, 0

        def all_rows():
            yield from first.to_pylist()
            for b in batches:
                yield from b.to_pylist()

        with new_file(path) as out:
            for row in all_rows():
                payload = row["payload"]
                kind = "response" if row["refers_to"] is None else "revisit"
                data = record(
                    kind, row["page_id"], row["refers_to"], row["url"], row["payload_digest"], len(payload), payload, date
                )
                pack = zlib.compressobj(level, wbits=31)
                member = pack.compress(data) + pack.flush()
                out.write(member)
                size, count = size + len(member), count + 1
        yield batch(path=([path], pa.string()), bytes=([size], pa.int64()), records=([count], pa.int64()))

    rows = pages.select("page_id", "url", "payload", "payload_digest", "refers_to")
    return written(rows.transform(mapped, write, "path string, bytes long, records long"), "warc-files")


def _page(field: str | None) -> int | None:
    number = (field or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = False) -> DataFrame:
    """The records of all archives (path, bytes): each task scans ranges of bytes.

    A response whose payload doesn't have the digest of its header is an error.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.where("bytes > 0").select("path", "bytes", starts.alias("start"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                held = []
                with opened(row["path"]) as stream:
                    stop = row["start"] + range_bytes
                    for _, fields, block in records(stream, row["bytes"], row["start"], stop):
                        digest = fields["warc-payload-digest"].removeprefix("sha256:")
                        payload = block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
                        if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{row['path']}: the payload of {fields['warc-record-id']} is damaged")
                        url = fields.get("warc-target-uri")
                        held.append((
                            _page(fields["warc-record-id"]), None if url is None else unquote(url),
                            int(fields["x-payload-length"]), digest, fields["warc-type"], _page(fields.get("warc-refers-to")),
                            payload if with_payload else None,
                        ))
                        if len(held) >= 1000:
                            yield _found(held)
                            held = []
                if held:
                    yield _found(held)

    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "payload binary"
    )
    return ranges.repartition("path", "start").transform(mapped, read, schema)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    page, url, size, digest, kind, refers, payload = zip(*rows)
    return batch(
        page_id=(page, pa.int64()), url=(url, pa.string()), payload_bytes=(size, pa.int64()),
        payload_digest=(digest, pa.string()), record_type=(kind, pa.string()), refers_to=(refers, pa.int64()),
        payload=(payload, pa.binary()),
    )


def archive_round_trip(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", with_payload: bool = False) -> DataFrame:
    """Writes an archive record per row and reads the archives back: one row per page.

    Null html is an empty payload. Repeated rows: the rows with the smallest id of equal payloads are
    responses, the others revisit that id. Fewer or more records than were written are an error. A row without id is a response unless another row with its
    payload has an id. A null url gives a record without one. An empty table gives no rows.
    """
    pages = df.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    )
    files = write_archives(with_references(pages), shared_folder(df.sparkSession, "warc"))
    found = written(read_archives(files, with_payload=with_payload), "warc-found")
    want, got = files.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], found.count()
    if want != got:
        raise ValueError(f"{got} records were read of {want} written")
    return found
