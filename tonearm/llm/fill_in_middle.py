"""Fill-in-middle texts, assembled by a secondary sort.

A text is cut into prefix, middle and suffix; the output holds them in another order, each behind
a mark. Tasks emit the pieces of a text, of at most `PIECE` code points, keyed by document and
output position. `repartitionAndSortWithinPartitions` brings the pieces of a document together in
output order, and they stream through an incremental digest; no task puts a whole output
together. From the stream of the output and its form alone, without the cuts, a scanner finds the
marks and names the place of every piece in the original. The restored pieces are sorted by that
place and stream through a second digest. Their keys have the same partitioner as before, so
this second sort moves nothing between tasks. The sorts spill to disk beyond the worker's memory.

A document's key is a digest of its id and text, of the task that read it and of how many equal
rows that task met before. So copies are dealt out over all tasks, even if a third of all rows are
equal, and a task that is repeated after a loss gives its rows the same keys in any order.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

from pyspark.sql import DataFrame, functions as F

#: Marks in front of the three parts, and the order of the parts in the original.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
#: Percent of texts from which on they stay plain, and of the others that begin with the suffix.
PLAIN_FROM, SUFFIX_FIRST = 90, 20
PIECE = 1 << 16
TASK_BYTES = 32 << 20
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

_MARK = re.compile("<[PSM]>")
#: Code points at the end of a piece that may begin a mark.
_OPEN = 2


def cuts(doc_id: int | None, text: str) -> tuple[str, int, int]:
    """The form of a text and where its prefix and its middle end; a missing id is an empty number."""
    head = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    first, second, third, fourth = (int(head[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    if not n or _MARK.search(text) or third % 100 >= PLAIN_FROM:
        return "plain", n, n
    return ("spm" if fourth % 100 < SUFFIX_FIRST else "psm"), low, high


def pieces(doc_id: int | None, text: str, size: int = PIECE) -> Iterator[tuple[str, tuple | None]]:
    """The pieces of the output in order; the first carries the document's row."""
    form, low, high = cuts(doc_id, text)
    parts = {PREFIX: (0, low), SUFFIX: (high, len(text)), MIDDLE: (low, high)}
    if form == "plain":
        order, row = [("", (0, len(text)))], (doc_id, len(text), form, None, None)
    else:
        marks = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
        order, row = [(mark, parts[mark]) for mark in marks], (doc_id, len(text), form, low, high - low)
    for mark, (start, stop) in order:
        for at in range(start, max(stop, start + 1), size):
            yield (mark if at == start else "") + text[at : min(at + size, stop)], row
            row = None


class Scanner:
    """Finds the place in the original of what follows in an output: (part, offset in it) and text."""

    def __init__(self, form: str):
        self._marked, self._part, self._offset, self._held = form != "plain", 0, 0, ""

    def _take(self, text: str) -> Iterator[tuple[tuple[int, int], str]]:
        if text:
            yield (self._part, self._offset), text
            self._offset += len(text)

    def feed(self, text: str) -> Iterator[tuple[tuple[int, int], str]]:
        if not self._marked:
            yield from self._take(text)
            return
        text, at = self._held + text, 0
        for found in _MARK.finditer(text):
            yield from self._take(text[at : found.start()])
            self._part, self._offset, at = PLACE[found.group()], 0, found.end()
        stop = max(at, len(text) - _OPEN)
        yield from self._take(text[at:stop])
        self._held = text[stop:]

    def close(self) -> Iterator[tuple[tuple[int, int], str]]:
        yield from self._take(self._held)


def _home(key: tuple) -> int:
    """Where the pieces of a document meet: a number from its name, not from a position."""
    return int.from_bytes(key[0][:8], "big")


def _emit(size: int):
    def emit(task: int, rows: Iterable) -> Iterator[tuple[tuple, tuple]]:
        met: Counter = Counter()
        for doc_id, text in rows:
            text = text or ""
            name = hashlib.blake2b(text.encode(), digest_size=16, key=str(doc_id).encode()).digest()
            met[name] += 1
            key = hashlib.blake2b(f"{task}:{met[name]}".encode(), digest_size=16, key=name).digest()
            for at, piece in enumerate(pieces(doc_id, text, size)):
                yield (key, at), piece

    return emit


def _digest_outputs(with_text: bool):
    """Streams each output through its digest and passes its pieces on under their original places."""

    def digest(sorted_pieces: Iterable) -> Iterator[tuple[tuple, tuple]]:
        for key, group in groupby(sorted_pieces, lambda piece: piece[0][0]):
            row = scanner = None
            output, whole = hashlib.sha256(), []
            for _, (text, first) in group:
                if first is not None:
                    row, scanner = first, Scanner(first[2])
                output.update(text.encode())
                if with_text:
                    whole.append(text)
                for place, restored in scanner.feed(text):
                    yield (key, place), (restored, None)
            for place, restored in scanner.close():
                yield (key, place), (restored, None)
            yield (key, (-1, 0)), ("", (*row, output.hexdigest(), "".join(whole) if with_text else None))

    return digest


def _digest_restored(with_text: bool):
    def digest(sorted_pieces: Iterable) -> Iterator[tuple]:
        for _, group in groupby(sorted_pieces, lambda piece: piece[0][0]):
            row, restored = None, hashlib.sha256()
            for _, (text, first) in group:
                row = first or row
                restored.update(text.encode())
            *told, output, whole = row
            yield (*told, output, restored.hexdigest(), *([whole] if with_text else []))

    return digest


def fill_in_middle(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False, piece: int = PIECE
) -> DataFrame:
    """One row per input row: doc_id, n (code points), form, prefix_chars, middle_chars, output_sha256, restored_sha256.

    `with_text` adds `output`, which is then put together in the task. Null is the empty text; an empty
    text is plain with an empty output. A row without id takes the hash of an empty number and keeps
    its null. Repeated rows give equal rows. An empty table gives no rows; other columns are left
    out, whatever their names. A text is as long as its column allows; only its pieces are moved.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spark = rows.sparkSession
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = int(max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES + 1))
    emitted = rows.rdd.mapPartitionsWithIndex(_emit(piece))
    outputs = emitted.repartitionAndSortWithinPartitions(tasks, _home)
    placed = outputs.mapPartitions(_digest_outputs(with_text), preservesPartitioning=True)
    restored = placed.repartitionAndSortWithinPartitions(tasks, _home)
    result = restored.mapPartitions(_digest_restored(with_text))
    return spark.createDataFrame(result, RESULT + (", output string" if with_text else ""), verifySchema=False)
