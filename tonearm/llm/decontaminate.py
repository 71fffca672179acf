"""Finding benchmark items in texts by winnowing.

A window is a run of `n` = 10 item words, or a whole shorter item. Of the hashes of all runs of
k words, the smallest of every w neighbours is a fingerprint (the last of equal ones), on both
sides; with k + w - 1 = n, every shared run of n words has a fingerprint in common, at the same
place. Shorter items get their own k and w, so that the guarantee holds for them too.

Texts send only fingerprints that a bitmap of fixed size does not rule out; it holds the item
fingerprints, and lets more pass the more items there are, never fewer. The survivors are joined
with the item fingerprints. Each hit is extended to all runs of n words around it, and these are
joined with the items' windows by their words, so that no result rests on a hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tonearm.llm.blocks import mapped, task_number, written
from tonearm.llm.texts import LETTERS, LOWER, ODD, U64, Spans, batch, grams, mix, text_of_word, text_slices, words

N = 10
K = 5
BITMAP_BITS = 22
NO_ITEMS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def shape(n: int) -> tuple[int, int]:
    """(k, w) for windows of n words."""
    k = min(K, n)
    return k, n - k + 1


def fingerprints(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word number) of the fingerprints of all texts for windows of n words."""
    k, w = shape(n)
    g = grams(h, k)
    size = max(0, len(g) - w + 1)
    least, at = g[:size].copy(), np.arange(size)
    for j in range(1, w):
        other = g[j : size + j]
        take = other <= least
        least[take] = other[take]
        at[take] = np.flatnonzero(take) + j
    whole = np.arange(size) + n <= np.repeat(first[1:], np.diff(first))[:size]
    chosen = np.unique(at[whole])
    return mix(g[chosen] + np.array([n], U64) * ODD), chosen


def item_windows(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, n, fingerprints, windows) of every item with words."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for begin, last, data, offsets in text_slices(rows.column("text")):
                low = LOWER[data]
                start, stop, first = words(low, offsets, LETTERS)
                h = Spans(low).hash(start, stop)
                raw, out = low.tobytes(), []
                for i in range(last - begin):
                    own = slice(first[i], first[i + 1])
                    count = own.stop - own.start
                    if not count:
                        continue
                    n = min(N, count)
                    marks, _ = fingerprints(h[own], np.array([0, count]), n)
                    found = [raw[a:b].decode() for a, b in zip(start[own], stop[own])]
                    texts = sorted({" ".join(found[j : j + n]) for j in range(count - n + 1)})
                    out.append((rows.column("item_id")[begin + i].as_py(), n, np.unique(marks).view(np.int64).tolist(), texts))
                if out:
                    ids, sizes, marks, texts = zip(*out)
                    yield batch(
                        item_id=(ids, pa.string()), n=(sizes, pa.int32()), marks=(marks, pa.list_(pa.int64())),
                        windows=(texts, pa.list_(pa.string())),
                    )

    rows = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    return rows.transform(mapped, find, "item_id string, n int, marks array<bigint>, windows array<string>")


def _bitmap(marks: DataFrame) -> np.ndarray:
    """Which of 2^22 hash ranges hold an item fingerprint; collected as at most 65,536 numbers."""
    slot = F.shiftrightunsigned("mark", 64 - BITMAP_BITS)
    found = marks.select((slot / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(mark, {64 - BITMAP_BITS}) % 64 as int))").alias("bit"))
    rows = found.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    packed = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for row in rows:
        packed[row.word] = row.bits
    return np.unpackbits(packed.astype("<i8").view(np.uint8), bitorder="little").view(bool)


def _candidates(bitmap: np.ndarray, sizes: list[int]):
    """One row per text: its number of words, and the words around each fingerprint that may be an item's."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = task_number() << 33
        for rows in batches:
            for begin, last, data, offsets in text_slices(rows.column("text")):
                low = LOWER[data]
                start, stop, first = words(low, offsets, LETTERS)
                h = Spans(low).hash(start, stop)
                text, found = text_of_word(first), [[] for _ in range(last - begin)]
                for n in sizes:
                    mark, at = fingerprints(h, first, n)
                    likely = np.flatnonzero(bitmap[mark >> U64(64 - BITMAP_BITS)])
                    for m, place in zip(mark[likely].view(np.int64).tolist(), at[likely].tolist()):
                        i = text[place]
                        a, b = max(first[i], place - n + shape(n)[0]), min(first[i + 1], place + n)
                        around = [low[start[j] : stop[j]].tobytes().decode() for j in range(a, b)]
                        found[i].append({"mark": m, "n": n, "first": int(a - first[i]), "words": around})
                hits = pa.array(found, pa.list_(pa.struct([
                    ("mark", pa.int64()), ("n", pa.int32()), ("first", pa.int64()), ("words", pa.list_(pa.string())),
                ])))
                own = rows.slice(begin, last - begin)
                yield batch(
                    row=(np.arange(row, row + last - begin), pa.int64()),
                    doc_id=own.column("doc_id"), text_hash=own.column("text_hash"), n_words=(np.diff(first), pa.int64()), hits=hits,
                )
                row += last - begin

    return find


def decontaminate(
    df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", with_hash: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated; `with_hash`
    adds xxhash64 of the text.

    Null and empty texts have no words. Repeated rows are judged alike; repeated items count once by
    their id; an item without id marks words as hit but is not listed. Without items, or without
    texts, nothing is hit. An empty text table gives no rows.
    """
    items = written(item_windows(benchmark, item_id, item_text), "item-windows")
    marks = items.select(F.explode("marks").alias("mark")).distinct()
    windows = items.select("item_id", "n", F.explode("windows").alias("window"))
    sizes = sorted(r.n for r in items.select("n").distinct().collect())
    texts = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash")
    )
    base = written(
        texts.transform(mapped, 
            _candidates(_bitmap(marks), sizes),
            "row long, doc_id long, text_hash long, n_words long, "
            "hits array<struct<mark: bigint, n: int, first: bigint, words: array<string>>>",
        ),
        "item-candidates",
    )
    hits = base.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    hits = hits.join(marks, "mark", "left_semi")
    runs = hits.select(
        "row", "n", "words", "first", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("n"))).alias("i")
    ).select("row", "n", (F.col("first") + F.col("i")).alias("start"), F.expr("array_join(slice(words, i + 1, n), ' ')").alias("window"))
    known = windows.select("n", "window").distinct()
    matched = written(runs.distinct().join(known, ["n", "window"]), "item-matches")

    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = matched.select("row", "start", (F.col("start") + F.col("n")).alias("stop"))
    new = F.col("stop") - F.greatest("start", F.least("stop", F.coalesce(F.max("stop").over(before), F.lit(0))))
    n_hit = spans.select("row", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))

    # Texts with the same windows have the same items: they are listed once for each set of windows.
    sets = matched.groupBy("row").agg(F.array_sort(F.collect_set("window")).alias("windows"))
    sets = sets.select("row", "windows", F.sha2(F.array_join("windows", "\n"), 256).alias("set"))
    kinds = sets.dropDuplicates(["set"]).select("set", F.explode("windows").alias("window"))
    listed = kinds.join(windows.select("window", "item_id"), "window").groupBy("set").agg(
        F.array_sort(F.collect_set("item_id")).alias("items")
    )
    listed = listed.select(
        "set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    )
    found = n_hit.join(sets.select("row", "set").join(listed, "set"), "row")
    return base.select("row", "doc_id", "text_hash", "n_words").join(found, "row", "left").select(
        "doc_id", *(["text_hash"] if with_hash else []), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.lit(NO_ITEMS)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
