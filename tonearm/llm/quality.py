"""Quality rules as a short-circuit cascade.

Each rule measures something of a text and rejects it beyond a limit. The verdict is that of
all rules together, so their order is free: it is chosen on a sample, where every rule is
timed and its rejections are counted on all rows; rules with the most rejections per second
come first. A text that a rule rejects is not measured by the rules behind it.

Rules work on many texts at once, as byte arrays; survivors are gathered before the next rule.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tonearm.llm.blocks import mapped
from tonearm.llm.texts import (
    NOT_SPACE, ODD, U64, Spans, batch, grams, mix, sum_by_text, text_of_word, text_slices, whole_grams, words,
)

#: Rows on which costs and rejections are measured; they decide the order only, never a verdict.
SAMPLE_ROWS = 2000
WINDOW = 8

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = UPPER.copy()
LETTER[97:123] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
CHARACTER = np.ones(256, bool)
CHARACTER[0x80:0xC0] = False


class Texts:
    """Some texts as bytes; words and hashes are found when they are first needed."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self._words = self._hashes = None

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def words(self):
        if self._words is None:
            self._words = words(self.data, self.offsets, NOT_SPACE)
        return self._words

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            start, stop, _ = self.words
            self._hashes = Spans(self.data).hash(start, stop)
        return self._hashes

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.words[2])

    def bytes_in(self, table: np.ndarray) -> np.ndarray:
        """Bytes of each text that the table marks."""
        return sum_by_text(table[self.data], self.offsets)

    def take(self, keep: np.ndarray) -> Texts:
        if keep.all():
            return self
        sizes = np.diff(self.offsets)
        return Texts(self.data[np.repeat(keep, sizes)], np.concatenate([[0], np.cumsum(sizes[keep])]))


def word_chars(t: Texts) -> np.ndarray:
    start, stop, first = t.words
    before = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(CHARACTER[t.data], out=before[1:])
    return sum_by_text(before[stop] - before[start], first)


def lines(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that equal an earlier line, per text."""
    filled = np.flatnonzero(np.diff(t.offsets))
    ends = np.flatnonzero(t.data == 10)
    begin = np.union1d(t.offsets[:-1][filled], ends + 1)
    begin = begin[begin < len(t.data)]
    # A line that begins where a text begins ends the one before without a line break.
    stop = np.append(begin[1:], len(t.data))
    stop = stop - (t.data[stop - 1] == 10) if len(begin) else stop
    text = np.searchsorted(t.offsets, begin, side="right") - 1
    start, _, _ = t.words
    with_word = np.searchsorted(start, stop) > np.searchsorted(start, begin)
    begin, stop, text = begin[with_word], stop[with_word], text[with_word]
    key = mix(Spans(t.data).hash(begin, stop) + text.astype(U64) * ODD)
    code, distinct = pd.factorize(key)
    first = np.full(len(distinct), len(key))
    np.minimum.at(first, code, np.arange(len(key)))
    again = first[code] < np.arange(len(key)) if len(key) else np.zeros(0, bool)
    n = len(t)
    return np.bincount(text, minlength=n), np.bincount(text, weights=again, minlength=n).astype(np.int64)


def repeated_words(t: Texts) -> np.ndarray:
    """Words that lie in a window of 8 words that stands twice or more in its text."""
    _, _, first = t.words
    whole = whole_grams(first, WINDOW)
    at = np.flatnonzero(whole)
    key = mix(grams(t.hashes, WINDOW)[at] + text_of_word(first)[at].astype(U64) * ODD)
    code, distinct = pd.factorize(key)
    twice = at[(np.bincount(code, minlength=len(distinct)) >= 2)[code]] if len(at) else at
    change = np.zeros(first[-1] + 1, np.int64)
    change[twice] += 1
    np.add.at(change, twice + WINDOW, -1)
    return sum_by_text(np.cumsum(change)[:-1] > 0, first)


def distinct_words(t: Texts) -> np.ndarray:
    text = text_of_word(t.words[2])
    code, distinct = pd.factorize(mix(t.hashes + text.astype(U64) * ODD))
    owner = np.zeros(len(distinct), np.int64)
    owner[code] = text
    return np.bincount(owner, minlength=len(t))


@dataclass(frozen=True)
class Rule:
    """Rejects texts; `rejects` gives one boolean per text."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


def _share(part, whole):
    return part / np.maximum(whole, 1)


RULES = (
    Rule("symbols", lambda t: _share(t.bytes_in(SYMBOLS), t.n_words) > 0.2),
    Rule("capitals", lambda t: _share(t.bytes_in(UPPER), t.bytes_in(LETTER)) > 0.5),
    Rule("exclamations", lambda t: _share(sum_by_text(t.data == 33, t.offsets), t.n_words) > 0.3),
    Rule("digits", lambda t: _share(t.bytes_in(DIGIT), t.bytes_in(CHARACTER)) > 0.3),
    Rule("repeated_lines", lambda t: _share(*lines(t)[::-1]) > 0.4),
    Rule("few_different_words", lambda t: _share(distinct_words(t), t.n_words) < 0.25),
    Rule("word_length", lambda t: ~np.isin(np.digitize(_share(word_chars(t), t.n_words), [2.0, 20.0]), [1])),
)
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, rejected_by string"
)


def measure(df: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, int]]:
    """(rule, seconds, rejections) on a sample of about `sample_rows` rows, chosen by a hash of the id."""
    step = max(1, df.count() // sample_rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for _, _, data, offsets in text_slices(rows.column("text")):
                spent, rejected = [], []
                for rule in RULES:
                    begin = time.perf_counter()
                    rejected.append(int(rule.rejects(Texts(data, offsets)).sum()))
                    spent.append(time.perf_counter() - begin)
                yield batch(
                    rule=([r.name for r in RULES], pa.string()), seconds=(spent, pa.float64()),
                    rejected=(rejected, pa.int64()),
                )

    sample = df.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    sums = sample.transform(mapped, run, "rule string, seconds double, rejected long").groupBy("rule")
    return [tuple(r) for r in sums.agg(F.sum("seconds"), F.sum("rejected")).collect()]


def cascade_order(measured: list[tuple[str, float, int]]) -> tuple[Rule, ...]:
    """The rules by rejections per second, the most effective first."""
    gain = {name: rejected / max(seconds, 1e-9) for name, seconds, rejected in measured}
    return tuple(sorted(RULES, key=lambda r: -gain.get(r.name, 0.0)))


def quality(df: DataFrame, doc_id: str = "doc_id", text: str = "text", order: tuple[Rule, ...] | None = None) -> DataFrame:
    """One row per input row with the base counts, `base_failed`, `kept` and the rule that rejected the text.

    A null or empty text has no words and fails; a null id is passed on; repeated rows are judged
    alike. `rejected_by` names the first rule that rejected the text, in an order that depends on
    timings; null for kept texts. An empty table gives no rows.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rules = order or cascade_order(measure(rows))
    names = [rule.name for rule in rules]

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered = sorted(RULES, key=lambda r: names.index(r.name))
        for rows in batches:
            for first, last, data, offsets in text_slices(rows.column("text")):
                t = Texts(data, offsets)
                n, repeat = t.n_words, repeated_words(t)
                failed = (n < 20) | (100 * repeat > 30 * n)
                by = np.full(len(t), None, object)
                by[failed] = "base"
                kept, rest = ~failed, t.take(~failed)
                for rule in ordered:
                    if not len(rest):
                        break
                    bad = rule.rejects(rest)
                    at = np.flatnonzero(kept)[bad]
                    by[at], kept[at] = rule.name, False
                    rest = rest.take(~bad)
                yield batch(
                    doc_id=rows.column("doc_id").slice(first, last - first), n_words=(n, pa.int64()),
                    word_chars=(word_chars(t), pa.int64()), n_symbols=(t.bytes_in(SYMBOLS), pa.int64()),
                    n_dup_lines=(lines(t)[1], pa.int64()), n_repeat_words=(repeat, pa.int64()),
                    base_failed=(failed, pa.bool_()), kept=(kept, pa.bool_()), rejected_by=(by, pa.string()),
                )

    return rows.transform(mapped, judge, SCHEMA)
