"""Ranked lexical search by scanning documents with an automaton of all query terms.

No index of the documents is made. The terms of all items form one Aho-Corasick automaton; each
term stands in it between two separators, and the separators of a text are mapped to one, so that
a match is always a whole term. Texts go through the automaton twice. The first scan counts
documents, terms and the documents of each item term, which gives the weights. The second scan
counts the terms of a document again, and from them its scores for all items that share one:
automaton outputs are term numbers, and a term number leads to the items that hold it. A task
keeps the best documents of each item and emits those alone; a last ranking merges the tasks.
All arithmetic of scores is in 64-bit integers.

The automaton and the lists from terms to items are sent to all tasks. They are bounded: items are
dealt into groups that need at most `GROUP_BYTES` in a task, counted before, and each group is searched
by itself with scans of its own. One group holds some 100,000 items of the size of a paragraph.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tonearm.llm.blocks import mapped, written
from tonearm.llm.texts import batch, text_slices, words

TOP = 10
#: Memory of a task for the terms that are searched at a time: an entry for each term of an item, and for each
#: character of a distinct term a node of the automaton.
GROUP_BYTES, ENTRY_BYTES, NODE_BYTES = 256 << 20, 16, 100
#: Cells (document, item) of the scores that a task holds at a time.
CELLS = 1 << 20
#: Bytes of a text that go through the automaton at a time; a cut never parts a term.
SLICE = 1 << 20

#: Bytes of terms, lower-cased; all others are separators. Bytes over 0x7F belong to terms.
_FOLD = bytearray(b" " * 256)
for _byte in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _FOLD[_byte] = _byte
for _byte in range(0x41, 0x5B):
    _FOLD[_byte] = _byte + 32
_FOLD = bytes(_FOLD)
IN_TERM = np.frombuffer(_FOLD, np.uint8) != 0x20


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def automaton(listed: list[bytes]):
    """Finds the numbers of the listed terms in folded text; every byte counts as one character."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, term in enumerate(listed):
        found.add_word(f" {term.decode('latin-1')} ", number)
    if listed:
        found.make_automaton()
    return found


def term_counts(found, text: bytes) -> Counter:
    """How often each term number occurs in a text."""
    counts: Counter = Counter()
    if not len(found):
        return counts
    folded, at = b" " + text.translate(_FOLD) + b" ", 0
    while at < len(folded) - 1:
        stop = len(folded) if len(folded) - at <= SLICE else folded.find(b" ", at + SLICE) + 1
        counts.update(map(itemgetter(1), found.iter(folded[at:stop].decode("latin-1"))))
        at = stop - 1
    return counts


def _scanned(batches: Iterable[pa.RecordBatch], listed: list[bytes], ids: bool):
    """For each document with a term: id, number of all its terms, and the counts of the listed ones."""
    found = automaton(listed)
    for rows in batches:
        for first, _, data, offsets in text_slices(rows.column("text")):
            sizes = np.diff(words(data, offsets, IN_TERM)[2]).tolist()
            for i, n in enumerate(sizes):
                if n:
                    own = rows.column("doc_id")[first + i].as_py() if ids else None
                    yield own, n, term_counts(found, data[offsets[i] : offsets[i + 1]].tobytes())


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct (item_id, term) of all items; rows with the same item_id are one item."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first, last, data, offsets in text_slices(rows.column("text")):
                lists = [sorted(set(terms(data[a:b].tobytes()))) for a, b in zip(offsets[:-1], offsets[1:])]
                yield batch(item_id=rows.column("item_id").slice(first, last - first), terms=(lists, pa.list_(pa.binary())))

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    lists = rows.transform(mapped, split, f"item_id {kind}, terms array<binary>")
    return lists.select("item_id", F.explode("terms").alias("term")).distinct()


def _groups(pairs: DataFrame, limit: int) -> int:
    """Into how many groups items are dealt, by a hash, so that each group needs at most `limit` bytes, or has one item."""
    items, groups = pairs.select("item_id").distinct().count(), 1
    while groups < items:
        held = pairs.groupBy(_group(groups).alias("group"), "term").agg(F.count("*").alias("n"))
        size = F.sum(ENTRY_BYTES * F.col("n") + NODE_BYTES * (F.length("term") + 2))
        if held.groupBy("group").agg(size.alias("size")).where(F.col("size") > limit).isEmpty():
            break
        groups *= 2
    return groups


def _group(groups: int):
    return F.pmod(F.xxhash64("item_id"), F.lit(groups))


def _counted(texts: DataFrame, sent) -> DataFrame:
    """(term, n): documents of each term number; under -1 all documents with terms, under -2 their terms."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = sent.value[0]
        documents = length = 0
        held = np.zeros(len(listed), np.int64)
        for _, n, counts in _scanned(batches, listed, ids=False):
            documents, length = documents + 1, length + n
            held[list(counts)] += 1
        some = np.flatnonzero(held)
        yield batch(
            term=(np.concatenate([some, [-1, -2]]), pa.int64()), n=(np.concatenate([held[some], [documents, length]]), pa.int64())
        )

    each = texts.select("text").transform(mapped, count, "term long, n long")
    return each.groupBy("term").agg(F.sum("n").alias("n"))


class Best:
    """The best documents of each item so far: higher scores first, then smaller ids, ids that are missing last."""

    def __init__(self, items: int, top: int):
        self._top, self._floor = top, np.ones(items, np.int64)
        none = np.zeros(0, np.int64)
        self.item, self.doc, self.known, self.score = none, none, none.astype(bool), none

    def add(self, scores: np.ndarray, docs: np.ndarray, known: np.ndarray) -> None:
        """Scores as a matrix of documents and items; what is below an item's last place is left out at once."""
        row, item = np.nonzero(scores >= self._floor)
        item = np.concatenate([self.item, item])
        doc, known = np.concatenate([self.doc, docs[row]]), np.concatenate([self.known, known[row]])
        score = np.concatenate([self.score, scores[row, item[len(self.item) :]]])
        order = np.lexsort((doc, ~known, -score, item))
        item = item[order]
        begin = np.searchsorted(item, item)
        rank = np.arange(len(item)) - begin
        kept = order[rank < self._top]
        self.item, self.doc, self.known, self.score = item[rank < self._top], doc[kept], known[kept], score[kept]
        last = np.flatnonzero(rank[rank < self._top] == self._top - 1)
        self._floor[self.item[last]] = self.score[last]


def _ranked(texts: DataFrame, sent, weights, documents: int, length: int, top: int) -> DataFrame:
    """The best documents of each item in each task: (item number, doc_id, score)."""

    def rank(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, places, holders = sent.value
        weight, items = weights.value, int(holders.max(initial=-1)) + 1
        best, block = Best(items, top), max(1, CELLS // max(1, items))
        docs, rows, term, gain = [], [], [], []

        def close() -> None:
            scores = np.zeros((len(docs), items), np.int64)
            numbers, values, at = np.array(term, np.int64), np.array(gain, np.int64), np.array(rows, np.int64)
            order = np.argsort(numbers, kind="stable")
            numbers, values, at = numbers[order], values[order], at[order]
            edges = np.flatnonzero(np.diff(numbers, prepend=-1, append=-1))
            for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
                one = numbers[start]
                scores[at[start:stop, None], holders[places[one] : places[one + 1]]] += values[start:stop, None]
            known = np.array([d is not None for d in docs], bool)
            best.add(scores, np.array([d or 0 for d in docs], np.int64), known)
            for held in (docs, rows, term, gain):
                held.clear()

        for own, n, counts in _scanned(batches, listed, ids=True):
            if counts:
                m = 10 + (90 * n * documents) // length
                term += counts
                gain += [weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m)) for t, tf in counts.items()]
                rows += [len(docs)] * len(counts)
                docs.append(own)
                if len(docs) == block:
                    close()
        if docs:
            close()
        doc = pa.array(best.doc, pa.int64(), mask=~best.known)
        yield batch(item=(best.item, pa.int64()), doc_id=doc, score=(best.score, pa.int64()))

    return texts.transform(mapped, rank, "item long, doc_id long, score long")


def _searched(texts: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    """The best documents of the items of one group."""
    spark = texts.sparkSession
    found = pairs.toArrow()
    if not len(found):
        return texts.limit(0).select(F.lit(None).alias("item_id"), F.lit(0).alias("rank"), "doc_id", F.lit(0).cast("long").alias("score"))
    term_of, name_of = found.column("term").combine_chunks().dictionary_encode(), found.column("item_id").combine_chunks()
    names = name_of.dictionary_encode(null_encoding="encode")
    by_term = np.lexsort((names.indices.to_numpy(), term_of.indices.to_numpy()))
    holders = names.indices.to_numpy()[by_term].astype(np.int64)
    listed = term_of.dictionary.to_pylist()
    places = np.searchsorted(term_of.indices.to_numpy()[by_term], np.arange(len(listed) + 1))
    sent = spark.sparkContext.broadcast((listed, places, holders))
    counts = {row.term: row.n for row in _counted(texts, sent).collect()}
    documents, length = counts.get(-1, 0), counts.get(-2, 0)
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(listed))]
    each = _ranked(texts, sent, spark.sparkContext.broadcast(weight), documents, length, top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = spark.createDataFrame(
        pa.table({"item": pa.array(np.arange(len(names.dictionary)), pa.int64()), "item_id": names.dictionary})
    )
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def search(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", top: int = TOP, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """The `top` documents of each item by score: item_id, rank (from 1), doc_id, score.

    Only scores above 0 count, so an item can have fewer rows or none. Equal scores are ranked by
    ascending doc_id, a missing id last. Every row of the documents is a document, repeated
    ones and such with the same id too; rows with the same item_id (or none) are one item with the terms
    of all of them. Null and empty texts have no terms; such documents count nowhere. Empty tables
    give no rows; other columns are left out. Texts are scanned whole. An item's own terms are held
    in memory together, as its text is.
    """
    texts = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pairs = written(item_terms(items, item_id, item_text), "search-terms")
    groups = _groups(pairs, group_bytes)
    found = None
    for group in range(groups):
        part = _searched(texts, pairs.where(_group(groups) == group), top)
        found = part if found is None else found.unionByName(part)
    kind = pairs.schema["item_id"].dataType
    return found.select(F.col("item_id").cast(kind).alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
