"""A hierarchical Pitman-Yor language model, sampled by Gibbs, and the probabilities of texts under it.

Tokens are the words of a text, A-Z in lower case, and one end token. A token is predicted
in the restaurant of its context, the token before it. Three levels share dishes: the
restaurant of the context (the token before, by its 64-bit name: 58 bits of hash and its class), its
parent, the restaurant of the context's class (63 classes of the last two bytes, and the
start of the text), and their common parent, the restaurant without context, whose base is
uniform over the V known tokens and one unknown. A customer is a token in its context; a new
table in a restaurant sends one customer to the parent.

Given the counts c of (restaurant, token) pairs, seating is described by the numbers t of
their tables: all seatings with the same t are equally likely up to a generalised Stirling
number S(c, t). A Gibbs sweep draws every t from its full conditional

    p(t) ~ S(c, t) * prod_{i < t} (strength + discount * (other tables of the restaurant + i)) * parent(token)^t

bottom up, so that tables become the customers of the parent in the same sweep. For pairs of
more than `EXACT` customers, the first `EXACT` are seated that way and the others join in
rounds that double the company, each with the number of new tables drawn for the whole
round. Restaurant totals are those of the sweep before, which lets all pairs be drawn at
once. Discounts follow from the pairs with one and two customers of each level. The
predictive probabilities of the sweeps behind the burn-in are averaged.

How it runs: chunks of texts send their distinct (token, context) pairs with counts to hash
buckets of tokens; a bucket holds all contexts of its tokens and so all levels of them, and notes
for each chunk which of its pairs the chunk has. The totals of a context (customers, tables) are
joined by hash buckets of contexts. Buckets of tokens send these the names of their contexts once;
from then on contexts go by their order in both, and after each sweep only tables are sent and
their sums sent back. What all buckets share besides is a vector of the totals of classes and root.
Then each chunk gets the probabilities of its own pairs back and adds them up per text. Training
counts, vocabulary and totals cover all training texts. Files of a step and of its shuffles are
removed when nothing reads them any more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from tempfile import SpooledTemporaryFile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tonearm.llm.blocks import (
    mapped, IS_CHUNK, PART, task_count, bucket_edges, chunked, dense, discard, from_bytes, loose, pack, parts, runs,
    share_count, shuffles_removed, to_buckets, to_chunks, unpack, written,
)
from tonearm.llm.texts import LOWER, NOT_SPACE, ODD, U64, Spans, batch, mix, sum_by_text, text_of_word, text_slices, words

CLASSES = 64
END = mix(np.array([0xE4D], U64))[0]
EXACT = 64
BURN_IN, SAMPLES = 2, 2
STRENGTH = 1.0
SEED = 20240711
#: Rows of a bucket before those of chunks. For tokens: counts, seatings by sample, customers of contexts by their bucket,
#: their tables by sample and bucket. For contexts: where the buckets of tokens have them, and what these send.
CODES, COUNTS, SEATINGS, CUSTOMERS, SUMS, NAMES = (-(1 << k) for k in range(62, 56, -1))
#: Bytes of a bucket's questions that stay in memory until its pairs are merged; more lie in a file of the task.
SPOOL_BYTES = 32 << 20
SHARED = -1
SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def in_fold(ids: pa.Array, remainder: int, folds: int = 5) -> np.ndarray:
    """Whether crc32 of the id as text, modulo `folds`, is `remainder`; false for null."""
    return np.array([i is not None and zlib.crc32(str(i).encode()) % folds == remainder for i in ids.to_pylist()], bool)


def token_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes and contexts of all texts, and for each text the number of tokens before it."""
    low = LOWER[data]
    start, stop, first = words(low, offsets, NOT_SPACE)
    h = Spans(low).hash(start, stop)
    texts = len(offsets) - 1
    ending = low[stop - 1].astype(U64) * U64(256) + low[np.maximum(stop - 2, start)].astype(U64)
    context = (h & ~U64(CLASSES - 1)) | (U64(1) + mix(ending + U64(1)) % U64(CLASSES - 1))
    at = np.arange(len(h)) + text_of_word(first)
    token = np.full(len(h) + texts, END, U64)
    token[at] = h
    before = np.zeros(len(h) + texts, U64)
    before[at + 1] = context
    return token, before, first + np.arange(texts + 1)


class ChunkPairs:
    """The distinct (token, context) pairs of a chunk, and which pair each of its tokens is."""

    def __init__(self, rows: pa.RecordBatch, text: str, trained: np.ndarray):
        streams, at = [], 0
        bounds = [np.zeros(1, np.int64)]
        for first, last, data, offsets in text_slices(rows.column(text)):
            token, before, places = token_stream(data, offsets)
            streams.append((token, before))
            bounds.append(places[1:] + at)
            at += len(token)
        token, before = (np.concatenate(s) for s in zip(*streams)) if streams else (np.zeros(0, U64), np.zeros(0, U64))
        self.bounds = np.concatenate(bounds)
        by_token = np.argsort(token)
        token = token[by_token]
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        code, contexts = pd.factorize(before, sort=True)
        pair = (np.cumsum(new) - 1) * len(contexts) + code[by_token]
        tokens = token[new]
        del streams, token, before, code
        by_pair = np.argsort(pair)
        pair, order = pair[by_pair], by_token[by_pair]
        del by_token, by_pair
        new[1:] = pair[1:] != pair[:-1]
        number = np.cumsum(new) - 1
        self.pair_of_token = np.empty(len(order), np.int64)
        self.pair_of_token[order] = number
        pair = pair[new]
        self.token, self.context = tokens[pair // len(contexts)], contexts[pair % len(contexts)]
        weight = np.repeat(trained, np.diff(self.bounds))
        self.count = np.bincount(number, weights=weight[order], minlength=len(self.token)).astype(np.uint32)

    def slices(self, buckets: int, counted: bool) -> Iterator[tuple[int, bytes]]:
        """The pairs of each bucket, with training counts for counting or without them for asking."""
        edges = bucket_edges(self.token, buckets)
        none = np.zeros(0, np.uint32)
        for bucket in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[bucket], edges[bucket + 1])
            token, size = _group(self.token[part])
            count = self.count[part] if counted else none
            yield bucket, pack(token, size.astype(np.uint32), self.context[part], count)


def _group(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an ordered array and how often each stands there."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    begin = np.flatnonzero(new)
    return ordered[begin], np.diff(np.append(begin, len(ordered)))


def _steps(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Values that ascend in groups of the given sizes, as distances to the one before in the group."""
    step, begin = np.diff(values, prepend=0), np.cumsum(size) - size
    step[begin] = values[begin]
    return step.astype(np.uint32)


def _from_steps(step: np.ndarray, size: np.ndarray) -> np.ndarray:
    values, begin = np.cumsum(step, dtype=np.int64), np.cumsum(size, dtype=np.int64) - size
    return values - np.repeat(values[begin] - step[begin], size)


def _pairs_of(body) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    token, size, context, count = unpack(body, U64, np.uint32, U64, np.uint32)
    return np.repeat(token, size), context, count


@dataclass(frozen=True)
class Totals:
    """Sums over the whole corpus: of the contexts of one bucket, and what all buckets share, of fixed size."""

    customers: np.ndarray  # per context
    tables: np.ndarray  # per context
    class_customers: np.ndarray
    class_tables: np.ndarray
    root_tables: float
    tokens: float
    vocabulary: float
    ones: np.ndarray  # pairs with one customer, per level
    twos: np.ndarray

    def vector(self) -> np.ndarray:
        rest = [self.root_tables, self.tokens, self.vocabulary]
        return np.concatenate([self.class_customers, self.class_tables, rest, self.ones, self.twos])

    @staticmethod
    def of(customers: np.ndarray, tables: np.ndarray, v: np.ndarray) -> Totals:
        b = 2 * CLASSES
        return Totals(customers, tables, v[:CLASSES], v[CLASSES:b], v[b], v[b + 1], v[b + 2], v[b + 3 : b + 6], v[b + 6 : b + 9])

    @property
    def root_customers(self) -> float:
        return float(self.class_tables.sum())

    @property
    def discounts(self) -> np.ndarray:
        return np.clip(self.ones / np.maximum(self.ones + 2 * self.twos, 1), 0.05, 0.95)


def stirling_logs(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(c, t) for c, t <= EXACT."""
    out = np.full((EXACT + 1, EXACT + 2), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(EXACT + 2)
    for c in range(EXACT):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = out[c] + np.log(np.maximum(c - discount * t, 0))
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay[1:])
    return out[:, : EXACT + 1]


def seat(
    count: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, rng: np.random.Generator
) -> np.ndarray:
    """Draws the number of tables of each pair, given those of the other pairs of its restaurant."""
    tables = np.minimum(count, 1).astype(np.int64)
    logs = stirling_logs(discount)
    size = np.minimum(count, EXACT)
    by_size = np.argsort(size, kind="stable")
    edges = np.searchsorted(size[by_size], np.arange(2, EXACT + 2))
    log_parent = np.log(parent)
    for c in range(2, EXACT + 1):
        for at in range(edges[c - 2], edges[c - 1], 1 << 14):
            rows = by_size[at : min(at + (1 << 14), edges[c - 1])]
            i = np.arange(c)
            weight = np.cumsum(np.log(STRENGTH + discount * (others[rows, None] + i)), axis=1)
            weight += logs[c, 1 : c + 1] + log_parent[rows, None] * (i + 1)
            total = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[rows] = 1 + (total < rng.random(len(rows))[:, None] * total[:, -1:]).sum(axis=1)
    many = np.flatnonzero(count > EXACT)
    seated = np.full(len(many), EXACT, np.int64)
    while len(many):
        company = np.minimum(count[many] - seated, seated)
        new = (STRENGTH + discount * (others[many] + tables[many])) * parent[many]
        old = seated - discount * tables[many]
        tables[many] += rng.binomial(company, new / (new + old))
        seated = seated + company
        left = seated < count[many]
        many, seated = many[left], seated[left]
    return tables


class Tables:
    """All levels of the trained tokens of one bucket: pairs with contexts (by their place in `names`), with classes, and alone.

    What `asked_` names is of all pairs, those without training too. Once contexts go by
    their order, `names` holds their classes only and `token` is empty.
    """

    def __init__(self, body, bucket: int):
        size, step, count, token, self.names = loose(body, np.uint32, np.uint32, np.uint32, U64, U64)
        self.bucket = bucket
        word, trained = np.repeat(np.arange(len(size)), size), count > 0
        known = np.zeros(len(size), bool)
        known[word[trained]] = True
        self.token, self.n_words = token[known[: len(token)]], int(known.sum())
        self.asked_token, self.asked_word, self.asked_known = word, (np.cumsum(known) - 1)[word], known[word]
        self.asked_context = _from_steps(step, size)
        self.word, self.context = self.asked_word[trained], self.asked_context[trained]
        self.count = count[trained].astype(np.int64)
        self.key = self.word * len(self.names) + self.context
        self.class_of_name = (self.names % U64(CLASSES)).astype(np.int64)
        key = self.word * CLASSES + self.class_of_name[self.context]
        self.class_key, self.in_class = np.unique(key, return_inverse=True)
        self.class_word, self.klass = self.class_key // CLASSES, self.class_key % CLASSES
        self.used = np.bincount(self.word, weights=self.count, minlength=self.n_words).astype(np.int64)

    def levels(self, tables: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Customers of the three levels."""
        up = np.bincount(self.in_class, weights=tables[0], minlength=len(self.class_key)).astype(np.int64)
        top = np.bincount(self.class_word, weights=tables[1], minlength=self.n_words).astype(np.int64)
        return self.count, up, top

    def start(self) -> tuple:
        return np.ones(len(self.count), np.int64), np.ones(len(self.class_key), np.int64), np.ones(self.n_words, np.int64)

    def predictive(self, tables: tuple, t: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the tokens alone, in their classes, and in their rooms."""
        d, (count, up, top) = t.discounts, self.levels(tables)
        alone = (top - d[2] * tables[2] + unknown(t, d) * (STRENGTH + t.root_customers)) / (STRENGTH + t.root_customers)
        of_class = (up - d[1] * tables[1]) / (STRENGTH + t.class_customers[self.klass])
        of_class += class_backoff(t, d)[self.klass] * alone[self.class_word]
        of_room = (count - d[0] * tables[0]) / (STRENGTH + t.customers[self.context])
        of_room += room_backoff(t, d)[self.context] * of_class[self.in_class]
        return alone, of_class, of_room

    def sweep(self, tables: tuple, t: Totals, number: int) -> tuple:
        rng = np.random.default_rng([SEED, number, self.bucket])
        d = t.discounts
        alone, of_class, _ = self.predictive(tables, t)
        rooms = seat(self.count, t.tables[self.context] - tables[0], of_class[self.in_class], d[0], rng)
        _, up, _ = self.levels((rooms, tables[1]))
        classes = seat(up, t.class_tables[self.klass] - tables[1], alone[self.class_word], d[1], rng)
        _, _, top = self.levels((rooms, classes))
        base = np.full(len(top), 1 / (t.vocabulary + 1))
        return rooms, classes, seat(top, t.root_tables - tables[2], base, d[2], rng)

    def replay(self, history: list[Totals]) -> list[tuple]:
        """The seatings after each sweep that the given totals lead to, for a bucket whose totals they are."""
        out = [self.start()]
        for number, t in enumerate(history, 1):
            out.append(self.sweep(out[-1], t, number))
        return out[1:]

    def totals(self, tables: tuple) -> Totals:
        levels = self.levels(tables)
        served = np.bincount(self.context, weights=tables[0], minlength=len(self.names))
        return Totals(
            np.bincount(self.context, weights=self.count, minlength=len(self.names)), served,
            np.bincount(self.class_of_name, weights=served, minlength=CLASSES),
            np.bincount(self.klass, weights=tables[1], minlength=CLASSES),
            float(tables[2].sum()), float(self.count.sum()), float(self.n_words),
            np.array([(c == 1).sum() for c in levels], float), np.array([(c == 2).sum() for c in levels], float),
        )


def unknown(t: Totals, d: np.ndarray) -> float:
    """Probability of a token that the root has not served."""
    return (STRENGTH + d[2] * t.root_tables) / (STRENGTH + t.root_customers) / (t.vocabulary + 1)


def class_backoff(t: Totals, d: np.ndarray) -> np.ndarray:
    return (STRENGTH + d[1] * t.class_tables) / (STRENGTH + t.class_customers)


def room_backoff(t: Totals, d: np.ndarray) -> np.ndarray:
    return (STRENGTH + d[0] * t.tables) / (STRENGTH + t.customers)


class Predictor:
    """Averaged probabilities of any (token, context) pairs of one bucket."""

    def __init__(self, tables: Tables, history: list[Totals], seatings: list[tuple] | None = None):
        """`history` holds the totals before the first sweep and after each one, or, with `seatings`, those of the samples."""
        self.tables, self.kept = tables, history[-SAMPLES:]
        seatings = seatings or tables.replay(history[:-1])[-SAMPLES:]
        self.samples = [tables.predictive(s, t) for s, t in zip(seatings, self.kept)]

    def __call__(self, token: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the tokens, and probabilities of the pairs."""
        context = context.astype(U64)
        of = (context % U64(CLASSES)).astype(np.int64)
        return self._at(*_find(self.tables.token, token), *_find(self.tables.names, context), of)

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """The same of all pairs that the bucket was asked about, in their order."""
        t = self.tables
        named = np.ones(len(t.asked_word), bool)
        return self._at(t.asked_word, t.asked_known, t.asked_context, named, t.class_of_name[t.asked_context])

    def _at(
        self, word: np.ndarray, known: np.ndarray, place: np.ndarray, named: np.ndarray, of: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        used = np.zeros(len(word), np.int64)
        mean = np.zeros(len(word))
        used[known] = self.tables.used[word[known]]
        klass, in_class = _find(self.tables.class_key, word * CLASSES + of)
        room, in_room = _find(self.tables.key, word * len(self.tables.names) + place)
        in_class &= known
        in_room &= known & named
        for k, t in enumerate(self.kept):
            d = t.discounts
            alone, of_class, of_room = self.samples[k]
            p = np.full(len(word), unknown(t, d))
            p[known] = alone[word[known]]
            p *= class_backoff(t, d)[of]
            p[in_class] = of_class[klass[in_class]]
            p[named] *= room_backoff(t, d)[place[named]]
            p[in_room] = of_room[room[in_room]]
            mean += p / len(self.kept)
        return used, mean


def _find(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ordered):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return at, ordered[at] == wanted


def _ask(text: str, doc_id: str, buckets: int, fold: int):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for chunk, members in runs(batches, "chunk"):
                for row in members:
                    own = from_bytes(row["body"])
                    pairs = ChunkPairs(own, text, ~in_fold(own.column(doc_id), fold))
                    for bucket, body in pairs.slices(buckets, counted=True):
                        yield bucket, chunk, body

        yield from parts(rows())

    return ask


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket, all pairs of its tokens with their training counts, and the names of their contexts; then for
    each chunk the places of its own pairs among them."""

    def merged(lists):
        token, context, count = (np.concatenate(c) for c in zip(*lists))
        order = np.lexsort((context, token))
        token, context, count = token[order], context[order], count[order].astype(np.int64)
        new = np.ones(len(order), bool)
        new[1:] = (token[1:] != token[:-1]) | (context[1:] != context[:-1])
        begin = np.flatnonzero(new)
        return token[begin], context[begin], np.add.reduceat(count, begin)

    def rows():
        for bucket, members in runs(batches, "bucket"):
            with SpooledTemporaryFile(SPOOL_BYTES) as asked:
                chunks, held = [], []
                for row in members:
                    chunks.append((row["chunk"], len(row["body"])))
                    asked.write(row["body"])
                    held.append(_pairs_of(row["body"]))
                    if len(held) >= 32:
                        held = [merged(held)]
                token, context, count = merged(held)
                names, room = np.unique(context, return_inverse=True)
                own, size = _group(token)
                key = np.repeat(np.arange(len(own)), size) * len(names) + room
                yield bucket, COUNTS, dense(size.astype(np.uint32), _steps(room, size), count.astype(np.uint32), own, names)
                asked.seek(0)
                for chunk, length in chunks:
                    token, context, _ = _pairs_of(asked.read(length))
                    at = np.searchsorted(key, np.searchsorted(own, token) * len(names) + np.searchsorted(names, context))
                    yield bucket, chunk, dense(np.diff(at, prepend=0).astype(np.uint32))

    yield from parts(rows())


def _laid_out(places: int):
    """What `_count` finds, with classes in place of names; the names of the contexts with their customers and first
    tables, for `places` buckets of contexts; and each task's part of what all buckets share."""

    def lay(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            total = np.zeros(2 * CLASSES + 9)
            for bucket, members in runs(_count(batches), "bucket"):
                for row in members:
                    if row["chunk"] != COUNTS:
                        yield bucket, row["chunk"], row["body"].to_pybytes()
                        continue
                    size, step, count, _, names = loose(row["body"], np.uint32, np.uint32, np.uint32, U64, U64)
                    tables = Tables(row["body"], bucket)
                    t = tables.totals(tables.start())
                    total += t.vector()
                    yield bucket, COUNTS, dense(size, step, count, names[:0], names % U64(CLASSES))
                    edges = bucket_edges(names, places)
                    for place in np.flatnonzero(np.diff(edges)).tolist():
                        part = slice(edges[place], edges[place + 1])
                        sums = (a[part].astype(np.uint32) for a in (t.customers, t.tables))
                        yield place, NAMES + bucket, dense(names[part], *sums)
            yield SHARED, 0, total.tobytes()

        yield from parts(rows())

    return lay


class Held:
    """What has come for one bucket of tokens."""

    def __init__(self, bucket: int):
        self.bucket, self.counts, self.seatings, self.customers, self.sums = bucket, None, {}, {}, {}

    def take(self, chunk: int, body) -> None:
        if chunk >= SUMS:
            self.sums.setdefault((chunk - SUMS) >> 32, []).append(*loose(body, np.uint32))
        elif chunk >= CUSTOMERS:
            self.customers[chunk - CUSTOMERS] = loose(body, np.uint32)[0]
        elif chunk >= SEATINGS:
            self.seatings[chunk - SEATINGS] = tuple(a.astype(np.int64) for a in loose(body, np.uint32, np.uint32, np.uint32))
        else:
            self.counts = body

    def tables(self) -> Tables:
        return Tables(self.counts, self.bucket)

    def totals(self, sample: int, shared: np.ndarray) -> Totals:
        customers, tables = (np.concatenate(list(c)).astype(np.float64) for c in (self.customers.values(), self.sums[sample]))
        return Totals.of(customers, tables, shared)


def _draw(shared: np.ndarray, number: int):
    """The seating of each bucket after one more sweep, its tables for the buckets of contexts, and each task's part of
    what all buckets share."""

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            total = np.zeros(2 * CLASSES + 9)
            for bucket, members in runs(batches, "bucket"):
                held = Held(bucket)
                for row in members:
                    held.take(row["chunk"], row["body"])
                tables = held.tables()
                seating = tables.sweep(held.seatings.get(0) or tables.start(), held.totals(0, shared), number)
                t = tables.totals(seating)
                total += t.vector()
                yield bucket, SEATINGS, dense(*(a.astype(np.uint32) for a in seating))
                served, at = t.tables.astype(np.uint32), 0
                for place, own in held.customers.items():
                    yield place, NAMES + bucket, dense(served[at : at + len(own)])
                    at += len(own)
            yield SHARED, 0, total.tobytes()

        yield from parts(rows())

    return draw


def _join_names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket of contexts, which of its contexts each bucket of tokens has, in the order of their names; and
    the customers and first tables of these, for that bucket of tokens."""

    def rows():
        for place, members in runs(batches, "bucket"):
            asked = [(row["chunk"] - NAMES, loose(row["body"], U64, np.uint32, np.uint32)) for row in members]
            buckets, size = np.array([(bucket, len(own[0])) for bucket, own in asked], np.uint32).T
            _, code = np.unique(np.concatenate([own[0] for _, own in asked]), return_inverse=True)
            yield place, CODES, dense(buckets, size, _steps(code, size))
            for first, k in ((CUSTOMERS, 1), (SUMS, 2)):
                yield from _summed(buckets, size, code, np.concatenate([own[k] for _, own in asked]), first + place)

    yield from parts(rows())


def _join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tables of the contexts of each bucket of contexts, for each bucket of tokens that has them."""

    def rows():
        for place, members in runs(batches, "bucket"):
            buckets, size, step = loose(next(members)["body"], np.uint32, np.uint32, np.uint32)
            served = np.concatenate([loose(row["body"], np.uint32)[0] for row in members])
            yield from _summed(buckets, size, _from_steps(step, size), served, SUMS + place)

    yield from parts(rows())


def _summed(
    buckets: np.ndarray, size: np.ndarray, code: np.ndarray, values: np.ndarray, number: int
) -> Iterator[tuple[int, int, bytes]]:
    """The sums of the values of each context, for each bucket of tokens that has it."""
    sums, at = np.bincount(code, weights=values).astype(np.uint32), 0
    for bucket, n in zip(buckets.tolist(), size.tolist()):
        yield bucket, number, dense(sums[code[at : at + n]])
        at += n


def _numbered(rows: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """The rows of buckets with numbers from `first` on, below `last` or `first` alone."""
    number = F.col("chunk")
    return rows.where((F.col("bucket") != SHARED) & (number == first if last is None else (number >= first) & (number < last)))


def _shared(rows: DataFrame) -> np.ndarray:
    """What all buckets share, from the parts of all tasks."""
    found = [np.frombuffer(row.body) for row in rows.where(F.col("bucket") == SHARED).select("body").collect()]
    return np.sum([np.zeros(2 * CLASSES + 9), *found], axis=0)


def _by_bucket(*rows: DataFrame) -> DataFrame:
    both = rows[0]
    for more in rows[1:]:
        both = both.unionByName(more)
    return both.repartition("bucket").sortWithinPartitions("bucket", "chunk")


def _answer(shared: list[np.ndarray]):
    """Counts and log probabilities of the pairs of chunks; what the bucket holds itself comes first."""

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for bucket, members in runs(batches, "bucket"):
                held, found = Held(bucket), None
                for row in members:
                    if row["chunk"] < 0:
                        held.take(row["chunk"], row["body"])
                        continue
                    if found is None:
                        found = asked(held)
                    word, used, p = found
                    at = np.cumsum(loose(row["body"], np.uint32)[0], dtype=np.int64)
                    new = np.diff(word[at], prepend=-1) > 0
                    yield bucket, row["chunk"], dense(used[at[new]], p[at])

        def asked(held):
            tables = held.tables()
            kept = [held.totals(k, v) for k, v in enumerate(shared)]
            used, p = Predictor(tables, kept, [held.seatings[k] for k in range(len(shared))]).asked()
            return tables.asked_token, used.astype(np.uint32), np.log10(p).astype(np.float32)

        yield from parts(rows())

    return answer


def _score(text: str, doc_id: str, fold: int, tokens: float, vocabulary: float):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in runs(batches, "chunk"):
            answers = []
            for row in members:
                if row["bucket"] != IS_CHUNK:
                    answers.append(loose(row["body"], np.uint32, np.float32))
                    continue
                own = from_bytes(row["body"])
                held_out = in_fold(own.column(doc_id), fold)
                pairs = ChunkPairs(own, text, ~held_out)
                used, p = (np.concatenate(c) for c in zip(*answers))
                used = np.repeat(used, _group(pairs.token)[1])[pairs.pair_of_token]
                p = p[pairs.pair_of_token].astype(np.float64)
                base = np.log10((used + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
                n = len(own)
                yield batch(
                    doc_id=own.column(doc_id), held_out=(held_out, pa.bool_()),
                    n_tokens=(np.diff(pairs.bounds), pa.int64()),
                    n_known=(sum_by_text(used > 0, pairs.bounds), pa.int64()),
                    train_tokens=(np.full(n, int(tokens)), pa.int64()),
                    base_score=(sum_by_text(base, pairs.bounds), pa.float64()),
                    score=(sum_by_text(p, pairs.bounds), pa.float64()),
                )

    return score


def score_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", fold: int = 1) -> DataFrame:
    """log10 probabilities of all texts, learned from those whose id is not in the held-out fold.

    One row per input row: doc_id, held_out, n_tokens, n_known (tokens seen in training),
    train_tokens, base_score (add-one-half unigrams) and score (the model). Null text is the
    empty text, which has the end token alone; a null id belongs to training; repeated rows are
    counted each and score alike. Without training texts both scores are those of the uniform
    base. An empty table gives no rows.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chunks = chunked(rows, "text", "lm-chunks")
    tasks = task_count(chunks)
    buckets = 4 * tasks
    own = chunks.select("chunk", "body")
    with shuffles_removed(df.sparkSession):
        counted = own.transform(mapped, _ask("text", "doc_id", buckets, fold), PART)
        answers, shared = _answers(to_buckets(counted), share_count(chunks))
    tokens, vocabulary = shared[2 * CLASSES + 1 : 2 * CLASSES + 3].tolist()
    score = _score("text", "doc_id", fold, tokens, vocabulary)
    return to_chunks(chunks, answers, tasks).transform(mapped, score, SCHEMA)


def _answers(counted: DataFrame, places: int) -> tuple[DataFrame, np.ndarray]:
    """The answers to the questions of chunks, written, and what all buckets share; no other file is left."""
    merged = written(counted.transform(mapped, _laid_out(places), PART), "lm-counts")
    names = written(_by_bucket(_numbered(merged, NAMES, 0)).transform(mapped, _join_names, PART), "lm-names")
    shared = [_shared(merged)]
    held = written(merged.where((F.col("chunk") == COUNTS) | (F.col("chunk") >= 0)).where(F.col("bucket") != SHARED), "lm-pairs")
    discard(merged)
    counts, codes, customers = _numbered(held, COUNTS), _numbered(names, CODES), _numbered(names, CUSTOMERS, SUMS)
    state, sweeps = [_numbered(names, SUMS, NAMES)], []
    for number in range(1, BURN_IN + SAMPLES + 1):
        drawn = written(_by_bucket(counts, customers, *state).transform(mapped, _draw(shared[-1], number), PART), "lm-sweep")
        served = _by_bucket(codes, _numbered(drawn, NAMES, 0))
        totals = written(served.transform(mapped, _join, PART), "lm-totals")
        shared.append(_shared(drawn))
        state = [_numbered(drawn, SEATINGS), totals]
        sweeps.append((drawn, totals))
        if len(sweeps) > SAMPLES:
            for old in sweeps.pop(0):
                discard(old)
    asked = [held, customers]
    for k, (drawn, totals) in enumerate(sweeps):
        for rows, shift in ((_numbered(drawn, SEATINGS), 0), (totals, 32)):
            asked.append(rows.withColumn("chunk", F.col("chunk") + (k << shift)))
    answers = written(_by_bucket(*asked).transform(mapped, _answer(shared[-SAMPLES:]), PART), "lm-answers")
    for old in (held, names, *(rows for sweep in sweeps for rows in sweep)):
        discard(old)
    return answers, shared[-1]
