"""Packing token ids into sequences by the sum-of-squares rule.

Documents come one by one. A document fills whole sequences first; what is left, shorter than a
sequence, is put into the open sequence whose fill level makes the sum of squared counts of open
sequences per level smallest, or opens a new one. The counts stand in an array by level, so that
all levels are weighed at once: moving one sequence from level g to level g + s changes the sum by
2 * (count[g + s] - count[g] + 1), a new one by 2 * count[s] + 1, and a full one leaves the array.

Each task packs its own documents with its own level array and needs no other. When its documents
end, few sequences are open; the emptiest are taken apart, and their ids, cut where needed, fill the
fullest, until one is left. That one is cut into sequences whose lengths are powers of two, which
need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tonearm.llm.blocks import mapped, task_number
from tonearm.llm.texts import batch
from tonearm.llm.tokens import encoded

LENGTH = 2048
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long"
)


class Packer:
    """Packs pieces of documents; a piece is (doc, start, length, ids)."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.count = np.zeros(length + 1, np.int64)
        self.open = [[] for _ in range(length + 1)]  # by level: open sequences, each a list of pieces

    def level_for(self, size: int) -> int:
        """The level to put a piece of this size on; 0 is a new sequence."""
        count, room = self.count, self.length - size
        change = 2 * (count[size:-1] - count[:room] + 1) if room else np.zeros(0, np.int64)
        change = np.append(change, 1 - 2 * count[room])  # the level that it makes full
        change[0] = 2 * count[size] + 1 if room else 0
        change[1:][count[1 : room + 1] == 0] = np.iinfo(np.int64).max
        return int(change.argmin())

    def add(self, doc, ids: np.ndarray) -> Iterator[list[tuple]]:
        """Takes a document; returns the sequences that are full now."""
        whole = len(ids) // self.length * self.length
        for at in range(0, whole, self.length):
            yield [(doc, at, ids[at : at + self.length])]
        rest = ids[whole:]
        if len(rest):
            full = self.place((doc, whole, rest))
            if full:
                yield full

    def place(self, piece: tuple) -> list[tuple] | None:
        level = self.level_for(len(piece[2]))
        sequence = []
        if level:
            sequence = self.open[level].pop()
            self.count[level] -= 1
        sequence.append(piece)
        level += len(piece[2])
        if level == self.length:
            return sequence
        self.open[level].append(sequence)
        self.count[level] += 1
        return None

    def finish(self) -> Iterator[list[tuple]]:
        """The remaining sequences: full ones, and last ones whose lengths are powers of two."""
        left = [sequence for level in self.open for sequence in level]
        while len(left) > 1:
            sequence, pieces = left.pop(), left.pop(0)
            room = self.length - sum(len(p[2]) for p in sequence)
            while pieces and room:
                doc, start, ids = pieces.pop()
                sequence.append((doc, start, ids[:room]))
                if len(ids) > room:
                    pieces.append((doc, start + room, ids[room:]))
                room -= min(room, len(ids))
            if pieces:
                left.insert(0, pieces)
            if room:
                left.append(sequence)
            else:
                yield sequence
        pieces = left[0][::-1] if left else []
        total = sum(len(p[2]) for p in pieces)
        for power in (1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1):
            sequence, room = [], power
            while room:
                doc, start, ids = pieces.pop()
                sequence.append((doc, start, ids[:room]))
                if len(ids) > room:
                    pieces.append((doc, start + room, ids[room:]))
                room -= min(room, len(ids))
            yield sequence


def pack(df: DataFrame, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    sequence_id is unique; sequence_length is the sum of the sequence's pieces, `length` or a power of
    two. A null text is empty and has the end id alone. Repeated rows are packed each, and a null id is
    passed on. An empty table gives no rows. With `with_ids` the ids of the pieces follow as binary,
    unsigned 32-bit numbers.
    """
    texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, number, held = Packer(length), task_number() << 33, []

        def keep(sequence):
            nonlocal number
            offset, total = 0, sum(len(p[2]) for p in sequence)
            for (doc, tokens), start, ids in sequence:
                raw = ids.astype("<u4").tobytes()
                held.append((
                    doc, start, len(ids), zlib.crc32(raw), tokens, number, offset, total, *([raw] if with_ids else []),
                ))
                offset += len(ids)
            number += 1

        for rows in batches:
            docs = rows.column("doc_id").to_pylist()
            for first, last, ids, bounds in encoded(rows.column("text"), tokenizer, end_id):
                for i in range(last - first):
                    own = ids[bounds[i] : bounds[i + 1]].copy()
                    for sequence in packer.add((docs[first + i], len(own)), own):
                        keep(sequence)
                if len(held) > 5000:
                    yield _pieces(held)
                    held = []
        for sequence in packer.finish():
            keep(sequence)
        if held:
            yield _pieces(held)

    return texts.transform(mapped, run, SCHEMA + (", ids binary" if with_ids else ""))


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    columns = {name: (values, pa.int64()) for name, values in zip([*names, "ids"], zip(*rows))}
    if "ids" in columns:
        columns["ids"] = (columns["ids"][0], pa.binary())
    return batch(**columns)
