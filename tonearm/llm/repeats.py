"""Removing byte strings that stand more than once in a text collection.

A string of `SPAN` bytes is repeated if it starts at two places, in one text or in two;
matches do not cross texts, and overlapping places count. The merge of Burrows-Wheeler
transforms decides this, over an alphabet of anchored substrings instead of single bytes:

1. Anchors. The smallest hash of all `GRAM`-byte strings that start in a window of `WINDOW`
   bytes marks an anchor. The window that starts at a place decides the place's anchor, and
   it lies within the `SPAN` bytes from there, so that equal strings have their anchor at
   the same distance. The places that share an anchor are a range [low, high].
2. Transform of a shard. For each anchor, the suffix that starts there is read as two
   symbols: the `AHEAD` bytes that belong to every string of the anchor's range, and the
   bytes up to the end of the last string of the range. The symbol in front of the suffix
   is what lies between `low` and the anchor. A shard (some MB of texts) sorts its suffixes
   by their symbols and lists the symbols in front: its transform.
3. Merge. Buckets hold the slices of all transforms that begin with certain symbols. The
   interleave of the shards starts as one block and is refined by one symbol per round, by
   a stable placement within each block; suffixes are never compared as a whole. The round
   in which a border between two blocks appears tells how many bytes both sides share.
   Blocks of one suffix are settled and leave. In the last round the symbol in front, which
   the transform holds, extends a block to the left.
4. Intervals. A block with two or more suffixes after all rounds is a repeated interval:
   everything from `low` to `high + SPAN` stands elsewhere. A suffix that shares only its
   first symbol lies at the border of a repeat. There each place of its range is compared
   with the places of the same block (of equal suffixes one is enough) by a hash of the
   whole string, again in buckets.

Borders are few (under 3 % of the anchors of the test data), so that nearly all places are
settled by anchors, of which there is one in about 60 bytes. Hashes have 64 bits per symbol;
strings of `SPAN` bytes are compared by 96 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tonearm.llm.blocks import (
    mapped, IS_CHUNK, PART, task_count, bucket_edges, chunked, discard, from_bytes, pack, parts, runs, shuffles_removed,
    to_buckets, to_bytes, to_chunks, unpack, written,
)
from tonearm.llm.texts import ODD, U64, Spans, mix, text_bytes, text_slices
from tonearm.session import shared_folder

SPAN = 200
WINDOW = 120
GRAM = 16
AHEAD = SPAN - WINDOW + 1
SEGMENT = 1 << 18
CHUNK_BYTES = 8 << 20
SLICE_BYTES = 1 << 18

NONE, COVERED, OPEN, PARTNER = range(4)
RESULT = {
    "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(),
}


def anchors(data: np.ndarray, offsets: np.ndarray, spans: Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, anchor) of all ranges of places that share an anchor."""
    lows, highs, found = [], [], []
    n = len(data) - SPAN + 1
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data)) >= SPAN
    for base in range(0, max(n, 0), SEGMENT):
        size = min(SEGMENT, n - base)
        grams = spans.fixed(GRAM, base, base + size + WINDOW - 1)
        late = U64((1 << 22) - 1)
        # The low bits hold the place, so that the last of equal grams is the smallest.
        order = np.full(-(-len(grams) // WINDOW) * WINDOW, U64(2**64 - 1))
        order[: len(grams)] = (grams & ~late) | (late - np.arange(len(grams), dtype=U64))
        table = order.reshape(-1, WINDOW)
        so_far = np.minimum.accumulate(table, axis=1).ravel()
        from_here = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(from_here[:size], so_far[WINDOW - 1 : WINDOW - 1 + size])
        place = np.flatnonzero(room[base : base + size])
        if not len(place):
            continue
        at = (late - (least[place] & late)).astype(np.int64)
        new = np.ones(len(place), bool)
        new[1:] = (at[1:] != at[:-1]) | (place[1:] != place[:-1] + 1)
        begin = np.flatnonzero(new)
        lows.append(place[begin] + base)
        highs.append(place[np.append(begin[1:], len(place)) - 1] + base)
        found.append(at[begin] + base)
    if not lows:
        none = np.zeros(0, np.int64)
        return none, none, none
    return np.concatenate(lows), np.concatenate(highs), np.concatenate(found)


class Shard:
    """The transform of one chunk: its distinct suffixes in order, with the symbol in front of each."""

    def __init__(self, texts: pa.Array):
        pieces = []
        base = 0
        for _, _, data, offsets in text_slices(texts, SLICE_BYTES):
            spans = Spans(data)
            low, high, at = anchors(data, offsets, spans)
            first = spans.hash(at, at + AHEAD)
            second = mix(spans.hash(at + AHEAD, high + SPAN) + (at - high).astype(U64))
            front = mix(spans.hash(low, at) + (at - low).astype(U64))
            pieces.append((low + base, high + base, first, second, front))
            base += len(data)
        columns = [np.concatenate(c) for c in zip(*pieces)] if pieces else [np.zeros(0, t) for t in "llQQQ"]
        low, high, first, second, front = columns
        order = np.lexsort((front, second, first))
        self.low, self.high = low[order], high[order]
        first, second, front = first[order], second[order], front[order]
        new = np.ones(len(order), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (front[1:] != front[:-1])
        self.begin = np.flatnonzero(new)
        self.number = np.cumsum(new) - 1
        self.first, self.second, self.front = first[self.begin], second[self.begin], front[self.begin]
        self.several = np.diff(np.append(self.begin, len(order))) > 1

    def slices(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        edges = bucket_edges(self.first, buckets)
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[bucket], edges[bucket + 1])
            yield bucket, pack(self.first[part], self.second[part], self.front[part], self.several[part])


def merge(first: np.ndarray, second: np.ndarray, front: np.ndarray, several: np.ndarray) -> np.ndarray:
    """Merges the shards' slices, given one behind the other; returns what each suffix turned out to be."""
    status = np.zeros(len(first), np.uint8)
    weight = 1 + several.astype(np.int64)
    interleave, block = np.arange(len(first)), np.zeros(len(first), np.int64)
    outer = block
    for number, symbol in enumerate((first, second, front)):
        now = symbol[interleave]
        place = np.lexsort((now, block))
        interleave, now, block, outer = interleave[place], now[place], block[place], outer[place]
        border = np.ones(len(now), bool)
        border[1:] = (now[1:] != now[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(border) - 1
        if number == 0:
            shared = (np.bincount(block, weights=weight[interleave]) >= 2)[block] if len(block) else border
            interleave, block = interleave[shared], block[shared]
            outer = block
    if not len(block):
        return status
    covered = (np.bincount(block, weights=weight[interleave]) >= 2)[block]
    status[interleave] = np.where(covered, COVERED, OPEN)
    has_open = np.zeros(outer.max() + 1, bool)
    has_open[outer[~covered]] = True
    leads = np.ones(len(block), bool)
    leads[1:] = block[1:] != block[:-1]
    status[interleave[covered & leads & has_open[outer]]] = PARTNER
    return status


def window_keys(spans: Spans, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the ranges, and two hashes of the string that starts at each."""
    counts = high - low + 1
    place = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    middle = place + SPAN // 2
    left, right = spans.hash(place, middle), spans.hash(middle, place + SPAN)
    return place, mix(left * ODD + right), (mix(left + right * ODD) >> U64(32)).astype(np.uint32)


def chunk_keys(texts: pa.Array, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`window_keys` for ranges given by places in all texts of a chunk."""
    order = np.argsort(low, kind="stable")
    low, high, base, out = low[order], high[order], 0, []
    for _, _, data, _ in text_slices(texts, SLICE_BYTES):
        here = slice(*np.searchsorted(low, [base, base + len(data)]))
        if here.stop > here.start:
            place, key, check = window_keys(Spans(data), low[here] - base, high[here] - base)
            out.append((place + base, key, check))
        base += len(data)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.uint32)
    return tuple(np.concatenate(c) for c in zip(*out))


def distinct_keys(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, starts of equal keys in it, and the number of the distinct key of each ordered entry."""
    order = np.lexsort((check, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def united(start: np.ndarray, stop: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals within texts: (text, start, stop) of maximal runs, as places in all texts."""
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none
    order = np.argsort(start, kind="stable")
    start, stop = start[order], stop[order]
    text = np.searchsorted(offsets, start, side="right") - 1
    reach = np.maximum.accumulate(stop)
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] > reach[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    return text[begin], start[begin], reach[np.append(begin[1:], len(start)) - 1]


def finished(rows: pa.RecordBatch, text: str, start: np.ndarray, stop: np.ndarray, with_text: bool) -> pa.Table:
    """The rows with the marked bytes removed."""
    data, offsets = text_bytes(rows.column(text))
    which, start, stop = united(start, stop, offsets)
    removed = np.bincount(which, weights=stop - start, minlength=len(rows)).astype(np.int64)
    spans = np.bincount(which, minlength=len(rows))
    first = np.searchsorted(which, np.arange(len(rows) + 1))
    view, digests, kept = memoryview(np.ascontiguousarray(data)), [], []
    for i in range(len(rows)):
        at, pieces = int(offsets[i]), []
        for k in range(first[i], first[i + 1]):
            pieces.append(view[at : start[k]])
            at = int(stop[k])
        pieces.append(view[at : offsets[i + 1]])
        digest = hashlib.sha256()
        for piece in pieces:
            digest.update(piece)
        digests.append(digest.hexdigest())
        if with_text:
            kept.append(b"".join(pieces).decode("utf-8", "ignore"))
    columns = {name: rows.column(name) for name in rows.schema.names if name != text and name not in RESULT}
    if with_text:
        columns[text] = pa.array(kept, pa.string())
    values = (np.diff(offsets), removed, spans, digests)
    columns |= {name: pa.array(v, kind) for (name, kind), v in zip(RESULT.items(), values)}
    return pa.table(columns)


def _questions(text: str, buckets: int):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for chunk, members in runs(batches, "chunk"):
                for row in members:
                    for bucket, body in Shard(from_bytes(row["body"]).column(text)).slices(buckets):
                        yield bucket, chunk, body

        yield from parts(rows())

    return ask


def _merge_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for bucket, members in runs(batches, "bucket"):
            chunks, slices = [], []
            for row in members:
                chunks.append(row["chunk"])
                slices.append(unpack(row["body"], U64, U64, U64, bool))
            status = merge(*(np.concatenate(c) for c in zip(*slices)))
            ends = np.cumsum([len(s[0]) for s in slices])
            for chunk, piece in zip(chunks, np.split(status, ends[:-1])):
                yield bucket, chunk, piece.tobytes()

    yield from parts(rows())


def _split(text: str, buckets: int, with_text: bool):
    """Settles texts without open places; asks about the others' places."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, members in runs(batches, "chunk"):
            status = []
            for row in members:
                if row["bucket"] != IS_CHUNK:
                    status.append(np.frombuffer(row["body"], np.uint8))
                    continue
                yield from _split_chunk(chunk, from_bytes(row["body"]), status)

    def _split_chunk(chunk, rows, answers):
        texts = rows.column(text)
        shard = Shard(texts)
        status = np.concatenate(answers) if answers else np.zeros(0, np.uint8)
        each = status[shard.number]
        covered = (each == COVERED) | (each == PARTNER)
        start, stop = shard.low[covered], shard.high[covered] + SPAN
        open_ = each == OPEN
        leads = np.zeros(len(each), bool)
        leads[shard.begin] = True
        partner = (each == PARTNER) & leads
        _, offsets = text_bytes(texts)
        # Distinct places of open ranges first, then the partners' own.
        _, key, check = chunk_keys(texts, shard.low[open_ | partner], shard.high[open_ | partner])
        _, asked, asked_check = chunk_keys(texts, shard.low[open_], shard.high[open_])
        order, begin, number = distinct_keys(key, check)
        weight = np.minimum(np.diff(np.append(begin, len(order))), 2).astype(np.uint8)
        key, check = key[order][begin], check[order][begin]
        asked_order, asked_begin, _ = distinct_keys(asked, asked_check)
        wanted = _member(key, check, asked[asked_order][asked_begin], asked_check[asked_order][asked_begin])
        edges = bucket_edges(key, buckets)
        sent = []
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[bucket], edges[bucket + 1])
            sent.append(("asked", bucket, chunk, pack(key[part], check[part], weight[part], wanted[part])))
        waiting = np.zeros(len(rows), bool)
        waiting[np.searchsorted(offsets, shard.low[open_], side="right") - 1] = True
        text_of = np.searchsorted(offsets, start, side="right") - 1
        settled = ~waiting[text_of] if len(text_of) else np.zeros(0, bool)
        calm, late = np.flatnonzero(~waiting), np.flatnonzero(waiting)
        if len(calm):
            move = _moved(offsets, calm)
            done = finished(
                rows.take(pa.array(calm)), text, start[settled] + move[text_of[settled]],
                stop[settled] + move[text_of[settled]], with_text,
            )
            sent.append(("done", IS_CHUNK, chunk, to_bytes(done)))
        if len(late):
            move = _moved(offsets, late)
            open_text = np.searchsorted(offsets, shard.low[open_], side="right") - 1
            body = pack(
                np.frombuffer(to_bytes(pa.Table.from_batches([rows.take(pa.array(late))])), np.uint8),
                start[~settled] + move[text_of[~settled]], stop[~settled] + move[text_of[~settled]],
                shard.low[open_] + move[open_text], shard.high[open_] + move[open_text],
            )
            sent.append(("waiting", IS_CHUNK, chunk, body))
        for kind, bucket, number, body in sent:
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([number], pa.int64()), pa.array([body], pa.binary()), pa.array([kind])],
                ["bucket", "chunk", "body", "kind"],
            )

    return split


def _member(key, check, other, other_check) -> np.ndarray:
    """Which of the distinct sorted (key, check) are among the other ones."""
    both = np.lexsort((np.concatenate([check, other_check]), np.concatenate([key, other])))
    all_key, all_check = np.concatenate([key, other])[both], np.concatenate([check, other_check])[both]
    twin = np.zeros(len(both), bool)
    twin[:-1] = (all_key[1:] == all_key[:-1]) & (all_check[1:] == all_check[:-1])
    out = np.zeros(len(key), bool)
    own = both[twin]
    out[own[own < len(key)]] = True
    return out


def _moved(offsets: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """For each text, how far its places move when only some texts are kept."""
    move = np.zeros(len(offsets) - 1, np.int64)
    sizes = np.diff(offsets)[kept]
    move[kept] = np.cumsum(sizes) - sizes - offsets[:-1][kept]
    return move


def _compare_places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for bucket, members in runs(batches, "bucket"):
            chunks, lists = [], []
            for row in members:
                chunks.append(row["chunk"])
                lists.append(unpack(row["body"], U64, np.uint32, np.uint8, bool))
            key, check, weight, _ = (np.concatenate(c) for c in zip(*lists))
            order, begin, number = distinct_keys(key, check)
            repeated = np.zeros(len(key), bool)
            repeated[order] = (np.add.reduceat(weight[order].astype(np.int64), begin) >= 2)[number]
            at = 0
            for chunk, (own, _, _, wanted) in zip(chunks, lists):
                yield bucket, chunk, repeated[at : at + len(own)][wanted].tobytes()
                at += len(own)

    yield from parts(rows())


def _finish(text: str, with_text: bool):
    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in runs(batches, "chunk"):
            answers = []
            for row in members:
                if row["bucket"] != IS_CHUNK:
                    answers.append(np.frombuffer(row["body"], bool))
                    continue
                body, start, stop, low, high = unpack(row["body"], np.uint8, *[np.int64] * 4)
                rows = from_bytes(pa.py_buffer(body))
                place, key, check = chunk_keys(rows.column(text), low, high)
                order, _, number = distinct_keys(key, check)
                repeated = place[order][np.concatenate(answers)[number]]
                done = finished(
                    rows, text, np.concatenate([start, repeated]), np.concatenate([stop, repeated + SPAN]), with_text
                )
                yield from done.to_batches()

    return finish


def _open_done(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for body in rows.column("body"):
            yield from_bytes(body.as_buffer())


def remove_repeats(df: DataFrame, text: str = "text", with_text: bool = True) -> DataFrame:
    """Every row of `df` without the bytes that repeated strings of 200 bytes cover.

    Adds n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 (of the remaining
    bytes); columns of these names in the input are replaced. With `with_text` the text column
    holds what remains, without bytes of characters that were cut in half; else it is left out.
    Null is the empty text. Repeated rows are copies of each other: all of their bytes that lie
    in a string of 200 bytes go. Texts under 200 bytes stay whole. An empty table gives no rows.
    """
    chunks = chunked(df, text, "repeat-chunks", CHUNK_BYTES)
    path = shared_folder(df.sparkSession, "repeat-parts")
    # The questions go before the chunks are dealt, and both before places are compared: disk holds one step's files.
    with shuffles_removed(df.sparkSession):
        tasks = task_count(chunks)
        buckets = 4 * tasks
        questions = chunks.select("chunk", "body").transform(mapped, _questions(text, buckets), PART)
        merged = written(to_buckets(questions).transform(mapped, _merge_bucket, PART), "repeat-merged")
        split = to_chunks(chunks, merged, tasks).transform(mapped, _split(text, buckets, with_text), PART + ", kind string")
        split.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    discard(chunks)
    discard(merged)
    stored = df.sparkSession.read.schema(split.schema).parquet(path)

    of = {f.name: f for f in df.schema if f.name not in RESULT and (with_text or f.name != text)}
    last = [of.pop(text)] if with_text else []
    kinds = [T.LongType(), T.LongType(), T.LongType(), T.StringType()]
    schema = T.StructType([*of.values(), *last, *(T.StructField(n, k) for n, k in zip(RESULT, kinds))])

    asked = stored.where(F.col("kind") == "asked").select("bucket", "chunk", "body")
    answers = to_buckets(asked).transform(mapped, _compare_places, PART)
    waiting = stored.where(F.col("kind") == "waiting").select("chunk", "body")
    finished_late = to_chunks(waiting, answers, tasks).transform(mapped, _finish(text, with_text), schema)
    done = stored.where(F.col("kind") == "done").select("body").transform(mapped, _open_done, schema)
    return done.unionByName(finished_late)
