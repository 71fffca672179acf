"""Toxicity by weak supervision.

1. Lexicons. On a bounded sample of labelled rows, words and word beginnings that stand mostly
   in toxic texts are found. Copies share their weight, so that a feature needs several
   independent texts.
2. Voters. The lexicon is dealt into many small lists; each list votes if a text holds one of
   its entries, and so do counts of entries and patterns of style. Voters err and repeat one
   another.
3. Label model. Over all texts outside the held-out fold, labelled or not, the means and
   covariances of the votes are counted. Voters that are independent given the class have a
   covariance that is a product of one number per voter; that product is fitted, pairs that
   exceed it are set aside as correlated, and the fit is repeated. The numbers give each
   voter's accuracy for either class. A posterior adds up the voters' evidence, divided for
   correlated voters by their company.
4. Classifier. A logistic regression over words and word beginnings is trained on the
   posteriors of a bounded sample of these texts, and scores every text.

Bounds (`SAMPLE_ROWS` labelled rows of each class, as many rows of either posterior,
`LEXICON` and `FEATURES` entries) concern the fit alone; vote statistics and scores cover all
texts. Labels are taken from rows outside the held-out fold only and are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tonearm.llm.blocks import (
    PART, bucket_edges, mapped, pack, parts, runs, task_number, to_buckets, unpack, written,
)
from tonearm.llm.near_duplicates import minhashes, shingles
from tonearm.llm.texts import LETTERS, LOWER, ODD, U64, Spans, batch, mix, sum_by_text, text_of_word, text_slices, words

SAMPLE_ROWS = 20_000
LEXICON, FEATURES = 4096, 8192
BEGINNINGS = (4, 5, 6)
FOLDS, HELD_OUT = 5, 0
BUCKETS = 64
#: Texts (copies count as one) that a feature must stand in.
SUPPORT = 3.5
TESTED = 9
#: Voters of the lexicon: lists of whole words and of beginnings of each length.
LISTS = (6, 3, 2, 2)
N_LISTS = sum(LISTS)
PATTERNS = ("two entries", "entries in 1 % of the words", "capitals", "exclamations", "repeated marks", "long words", "no entry")
N_VOTERS = N_LISTS + len(PATTERNS)
CORRELATED = 0.1
#: Minhashes of a key by which rows of a sample count as copies: two collections of the near duplicates' two.
COPY_HASHES = 4


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, modulo 5, is 0; false for null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


class Features:
    """Hashed words and word beginnings of some texts: for each kind, values and the text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = LOWER[data]
        start, stop, self.first = words(low, offsets, LETTERS)
        spans, text = Spans(low), text_of_word(self.first)
        self.kinds = [(spans.hash(start, stop), text)]
        for size in BEGINNINGS:
            longer = np.flatnonzero(stop - start > size)
            value = mix(spans.hash(start[longer], start[longer] + size) + U64(size))
            self.kinds.append((value, text[longer]))

    def found(self, lookup: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, entry, strength) of the entries that stand in each text, in the order of texts.

        Strength is log2(1 + occurrences), half of that for beginnings, so that a whole word that is
        known takes most of the weight from its beginning, which other words may share.
        """
        size, out = max(len(lookup.entries), 1), []
        for kind, (value, text) in enumerate(self.kinds):
            place, entry = lookup(value)
            pair, count = np.unique(text[place] * size + entry, return_counts=True)
            out.append((*np.divmod(pair, size), np.log2(1 + count) * (0.5 if kind else 1.0)))
        text, entry, strength = (np.concatenate(c) for c in zip(*out))
        order = np.argsort(text, kind="stable")
        return text[order], entry[order], strength[order]


class Lookup:
    """Finds the entries of a sorted list of hashes among many; a table of first bits rules most out."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.table = np.zeros(1 << 20, bool)
        self.table[entries >> U64(44)] = True

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in values, numbers of the entries there)."""
        place = np.flatnonzero(self.table[values >> U64(44)])
        if not len(place):
            return place, place
        at = np.minimum(np.searchsorted(self.entries, values[place]), len(self.entries) - 1)
        hit = self.entries[at] == values[place]
        return place[hit], at[hit]


# --- Association of features with a class ---------------------------------------------------


def with_copy_weight(sample: DataFrame) -> DataFrame:
    """Adds `weight`: 1 divided by the size of the largest group of sample rows that share a key of `COPY_HASHES` minhashes
    with the row: rows of similarity 0.8 share one in 19 of 20 cases, those of 0.3 in 1 of 20."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = task_number() << 33
        for rows in batches:
            for first, last, data, offsets in text_slices(rows.column("text")):
                values, bounds = shingles(data, offsets)
                pairs = minhashes(values, bounds)
                table = mix(pairs[:, ::2] * ODD + pairs[:, 1::2]).view(np.int64)
                ends = np.concatenate([[0], np.cumsum((np.diff(bounds) > 0) * table.shape[1])])
                own, n = rows.slice(first, last - first), last - first
                yield batch(
                    row=(np.arange(row, row + n), pa.int64()), text=own.column("text"), target=own.column("target"),
                    kin=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(table.ravel(), pa.int64())),
                )
                row += n

    signed = sample.select("text", "target").transform(
        mapped, sign, "row long, text string, target double, kin array<bigint>"
    )
    signed = written(signed, "toxic-sample")
    each = signed.select("row", F.posexplode("kin").alias("i", "kin"))
    groups = each.groupBy("i", "kin").agg(F.count("*").alias("n")).where("n > 1")
    largest = each.join(groups, ["i", "kin"]).groupBy("row").agg(F.max("n").alias("n"))
    weight = (1 / F.coalesce("n", F.lit(1))).alias("weight")
    return signed.join(F.broadcast(largest), "row", "left").select("text", "target", weight)


def associated(sample: DataFrame, limit: int, purity: float) -> tuple[np.ndarray, np.ndarray]:
    """The `limit` features of the sample (text, target, weight) that point most clearly to the class, sorted, and their kind.

    At least `purity` of a feature's texts are toxic, and its log likelihood ratio against chance
    exceeds the logarithm of the number of features that stand in `SUPPORT` texts: with so many words,
    some rare ones stand in toxic texts only by chance, and this expects one of them to be taken.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of():
            for rows in batches:
                target = rows.column("target").to_numpy(zero_copy_only=False)
                weight = rows.column("weight").to_numpy(zero_copy_only=False)
                for first, _, data, offsets in text_slices(rows.column("text")):
                    for kind, (value, text) in enumerate(Features(data, offsets).kinds):
                        code, keys = pd.factorize(mix(value + text.astype(U64) * ODD))
                        seen = np.zeros(len(keys), np.int64)
                        seen[code] = np.arange(len(code))
                        value, text = value[seen], text[seen] + first
                        code, keys = pd.factorize(value)
                        yes = np.bincount(code, weights=(weight * target)[text], minlength=len(keys))
                        no = np.bincount(code, weights=(weight * (1 - target))[text], minlength=len(keys))
                        order = np.argsort(keys)
                        keys, yes, no = keys[order], yes[order], no[order]
                        edges = bucket_edges(keys, BUCKETS)
                        for b in np.flatnonzero(np.diff(edges)).tolist():
                            part = slice(edges[b], edges[b + 1])
                            yield b * 4 + kind, 0, pack(keys[part], yes[part], no[part])

        yield from parts(rows_of())

    sizes = sample.agg(F.sum(F.col("weight") * F.col("target")), F.sum(F.col("weight") * (1 - F.col("target")))).first()
    n_yes, n_no = (float(s or 0.0) for s in sizes)

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, members in runs(batches, "bucket"):
            lists = [unpack(row["body"], U64, np.float64, np.float64) for row in members]
            code, keys = pd.factorize(np.concatenate([own[0] for own in lists]))
            yes = np.bincount(code, weights=np.concatenate([own[1] for own in lists]))
            no = np.bincount(code, weights=np.concatenate([own[2] for own in lists]))
            total, chance = np.maximum(yes + no, 1e-9), (n_yes + 0.5) / (n_yes + n_no + 1)
            part = np.clip(yes / total, 1e-9, 1 - 1e-9)
            evidence = total * (part * np.log(part / chance) + (1 - part) * np.log((1 - part) / (1 - chance)))
            good = np.flatnonzero((yes >= purity * total) & (part > chance) & (total >= SUPPORT))
            tested = float((total >= SUPPORT).sum())
            yield batch(
                feature=(np.append(keys[good].view(np.int64), 0), pa.int64()),
                kind=([bucket % 4] * len(good) + [TESTED], pa.int32()), score=(np.append(evidence[good], tested), pa.float64()),
            )

    counted = to_buckets(sample.transform(mapped, count, PART))
    chosen = written(counted.transform(mapped, choose, "feature long, kind int, score double"), "toxic-features")
    tested = chosen.where(F.col("kind") == TESTED).agg(F.coalesce(F.sum("score"), F.lit(0.0))).first()[0]
    clear = chosen.where((F.col("kind") != TESTED) & (F.col("score") >= float(np.log(tested + 1))))
    rows = clear.orderBy(F.desc("score"), "feature").limit(limit).collect()
    found = sorted((r.feature % (1 << 64), r.kind) for r in rows)
    return np.array([f for f, _ in found], U64), np.array([k for _, k in found], np.int64)


# --- Voters and label model -----------------------------------------------------------------


@dataclass(frozen=True)
class Voters:
    entries: np.ndarray
    voter: np.ndarray  # the list of each entry

    @staticmethod
    def of(entries: np.ndarray, kind: np.ndarray) -> Voters:
        begin = np.cumsum((0, *LISTS))[:-1]
        deal = (mix(entries) % np.array(LISTS, U64)[kind]).astype(np.int64)
        return Voters(entries, begin[kind] + deal)

    def votes(self, data: np.ndarray, offsets: np.ndarray, lookup: Lookup) -> np.ndarray:
        """Votes (texts x voters): 1 for toxic, 0 for none."""
        f, n = Features(data, offsets), len(offsets) - 1
        out = np.zeros((n, N_VOTERS), np.int8)
        entries = np.zeros(n, np.int64)
        for kind, (value, text) in enumerate(f.kinds):
            place, entry = lookup(value)
            out[text[place], self.voter[entry]] = 1
            entries = np.maximum(entries, np.bincount(text[place], minlength=n))
        n_words, size = np.diff(f.first), np.maximum(np.diff(offsets), 1)
        capital = sum_by_text((data >= 65) & (data <= 90), offsets)
        letter = sum_by_text(((data | 32) >= 97) & ((data | 32) <= 122), offsets)
        same = np.zeros(len(data), bool)
        same[1:] = (data[1:] == data[:-1]) & (data[1:] > 32) & ~LETTERS[LOWER[data[1:]]]
        style = (
            entries >= 2,
            entries * 100 >= np.maximum(n_words, 1),
            capital * 10 > 3 * letter,
            sum_by_text(data == 33, offsets) * 20 > n_words,
            sum_by_text(same, offsets) * 50 > size,
            size > 12 * np.maximum(n_words, 1),
            entries == 0,
        )
        for k, vote in enumerate(style):
            out[:, N_LISTS + k] = vote
        return out


@dataclass(frozen=True)
class LabelModel:
    """Accuracies of the voters given either class, and what correlated voters count for."""

    prior: float
    if_toxic: np.ndarray
    if_clean: np.ndarray
    share: np.ndarray
    correlated: np.ndarray

    @staticmethod
    def fit(n: float, sums: np.ndarray, products: np.ndarray, prior: float) -> LabelModel:
        mean = sums / max(n, 1)
        cov = products / max(n, 1) - np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        m = len(mean)
        used = ~np.eye(m, dtype=bool)
        live = scale > 1e-5
        used &= live[:, None] & live[None, :]
        corr = cov / np.outer(scale, scale)
        v = np.where(live, 0.5, 0.0)
        for _ in range(6):
            for _ in range(100):
                v = (corr * used) @ v / np.maximum((used * v**2).sum(axis=1), 1e-9)
                v = np.clip(v, -0.999, 0.999)
            residual = corr - np.outer(v, v)
            excess = (residual > CORRELATED) & live[:, None] & live[None, :] & ~np.eye(m, dtype=bool)
            # Each voter keeps at least three partners: those that exceed the product least.
            order = np.argsort(np.where(live[None, :] & ~np.eye(m, dtype=bool), residual, np.inf), axis=1)[:, :3]
            keep = np.zeros((m, m), bool)
            np.put_along_axis(keep, order, True, axis=1)
            used = ~np.eye(m, dtype=bool) & live[:, None] & live[None, :] & (~excess | keep | keep.T)
        if v.sum() < 0:
            v = -v
        spread = v * scale / np.sqrt(prior * (1 - prior))
        if_clean = np.clip(mean - prior * spread, 1e-4, 1 - 1e-4)
        if_toxic = np.clip(mean + (1 - prior) * spread, 1e-4, 1 - 1e-4)
        residual = np.clip(corr - np.outer(v, v), 0, 1) * live[:, None] * live[None, :]
        np.fill_diagonal(residual, 0)
        partial = residual / np.maximum(1 - np.outer(v, v), 1e-3)
        return LabelModel(prior, if_toxic, if_clean, 1 / (1 + np.clip(partial, 0, 1).sum(axis=1)), residual > CORRELATED)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """By Bayes' rule: that a voter does not vote counts by the rates of not voting."""
        cast = np.log(self.if_toxic / self.if_clean) * self.share
        silent = np.log((1 - self.if_toxic) / (1 - self.if_clean)) * self.share
        logit = np.log(self.prior / (1 - self.prior)) + votes @ cast + (1 - votes) @ silent
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _bits(votes: np.ndarray) -> np.ndarray:
    return votes.astype(np.int64) @ (1 << np.arange(N_VOTERS))


def _of_bits(bits: np.ndarray) -> np.ndarray:
    return ((bits[:, None] >> np.arange(N_VOTERS)) & 1).astype(np.float64)


def vote_table(texts: DataFrame, voters: Voters) -> DataFrame:
    """(doc_id, votes) of all rows, the votes as bits of one number."""

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(voters.entries)
        for rows in batches:
            for first, last, data, offsets in text_slices(rows.column("text")):
                bits = _bits(voters.votes(data, offsets, lookup))
                yield batch(doc_id=rows.column("doc_id").slice(first, last - first), votes=(bits, pa.int64()))

    return texts.transform(mapped, vote, "doc_id long, votes long")


def fit_label_model(votes: DataFrame, prior: float) -> LabelModel:
    """Counts votes and pairs of votes over the whole table; what is collected has one row per pair of voters."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((N_VOTERS, N_VOTERS)), 0
        for rows in batches:
            each = _of_bits(rows.column("votes").to_numpy())
            total += each.T @ each
            n += len(each)
        j, k = np.divmod(np.arange(N_VOTERS**2), N_VOTERS)
        yield batch(j=(j, pa.int32()), k=(k, pa.int32()), both=(total.ravel(), pa.float64()), n=(np.full(len(j), n), pa.int64()))

    rows = votes.transform(mapped, count, "j int, k int, both double, n long").groupBy("j", "k")
    products, n = np.zeros((N_VOTERS, N_VOTERS)), 0
    for row in rows.agg(F.sum("both").alias("both"), F.sum("n").alias("n")).collect():
        products[row.j, row.k], n = row.both, row.n
    return LabelModel.fit(n, np.diag(products).copy(), products, prior)


# --- Classifier -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Classifier:
    entries: np.ndarray
    weight: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray, lookup: Lookup) -> np.ndarray:
        text, entry, strength = Features(data, offsets).found(lookup)
        logit = self.bias + np.bincount(text, weights=self.weight[entry] * strength, minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_logistic(
    row: np.ndarray, entry: np.ndarray, strength: np.ndarray, target: np.ndarray, weight: np.ndarray, size: int,
    penalty: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse features with soft targets, by accelerated gradient steps."""
    n = len(target)
    total = weight.sum()
    w, bias = np.zeros(size), float(np.log((weight @ target + 1) / (weight @ (1 - target) + 1)))
    ahead, ahead_bias, t = w.copy(), bias, 1.0
    reach = np.bincount(row, weights=strength**2, minlength=n) + 1.0
    step = 4.0 / max((weight * reach).sum() / max(total, 1e-9), 1.0)
    for _ in range(1500):
        logit = ahead_bias + np.bincount(row, weights=ahead[entry] * strength, minlength=n)
        error = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) / max(total, 1e-9)
        gradient = np.bincount(entry, weights=error[row] * strength, minlength=size) + penalty * ahead
        new, new_bias = ahead - step * gradient, ahead_bias - step * error.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum = (t - 1) / t_next
        ahead, ahead_bias = new + momentum * (new - w), new_bias + momentum * (new_bias - bias)
        w, bias, t = new, new_bias, t_next
    return w, float(bias)


def _sparse(sample: DataFrame, entries: np.ndarray) -> tuple[np.ndarray, ...]:
    """The sample's chosen features, collected: at most 2 * SAMPLE_ROWS rows."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(entries)
        for rows in batches:
            for first, last, data, offsets in text_slices(rows.column("text")):
                text, entry, strength = Features(data, offsets).found(lookup)
                ends = pa.array(np.searchsorted(text, np.arange(last - first + 1)), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(entry, pa.int32()))
                strengths = pa.ListArray.from_arrays(ends, pa.array(strength, pa.float64()))
                own = rows.slice(first, last - first)
                yield batch(entries=lists, strengths=strengths, target=own.column("target"), weight=own.column("weight"))

    schema = "entries array<int>, strengths array<double>, target double, weight double"
    found = sample.transform(mapped, find, schema).toArrow().combine_chunks()
    lists, strengths = (found.column(c).combine_chunks() for c in ("entries", "strengths"))
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    values = lists.flatten().to_numpy(), strengths.flatten().to_numpy()
    return row, *values, found.column("target").to_numpy(), found.column("weight").to_numpy()


def sample_rows(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row (doc_id, text, target) for each chosen id that has a text row: of several, that with the smallest text.

    `chosen` has at most 2 * SAMPLE_ROWS ids, so that this bounds the rows, however often an id stands in `texts`.
    """
    counted = texts.select("doc_id").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "target").agg(F.count("*").alias("n"))
    counted = written(counted, "toxic-chosen")
    repeated = counted.where("n > 1").drop("n")
    rows = texts.join(F.broadcast(counted.where("n = 1").drop("n")), "doc_id").select("doc_id", "text", "target")
    if repeated.isEmpty():
        return rows
    several = texts.join(F.broadcast(repeated), "doc_id").groupBy("doc_id", "target").agg(F.min("text").alias("text"))
    return rows.unionByName(several)


def _lowest(df: DataFrame, rows: int) -> DataFrame:
    """The rows with the lowest hashes of their id: the same ones in every run."""
    return df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


@dataclass(frozen=True)
class Training:
    voters: Voters
    labels: LabelModel
    classifier: Classifier


def train(documents: DataFrame, labels: DataFrame) -> Training:
    """Learns from (doc_id, text) and (doc_id, toxic), outside the held-out fold of both."""
    texts = documents.where(~held_out(F.col("doc_id"))).select("doc_id", "text")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("double")).alias("target"))
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    prior = min(max((toxic + 0.5) / (n + 10), 0.001), 0.5)

    chosen = _lowest(known.where("target > 0"), SAMPLE_ROWS).unionByName(_lowest(known.where("target = 0"), SAMPLE_ROWS))
    sample = with_copy_weight(sample_rows(texts, chosen))
    entries, kind = associated(sample, LEXICON, purity=0.9)
    voters = Voters.of(entries, kind)

    votes = written(vote_table(texts, voters), "toxic-votes")
    model = fit_label_model(votes, prior)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            p = model.posterior(_of_bits(rows.column("votes").to_numpy()))
            yield batch(doc_id=rows.column("doc_id"), target=(p, pa.float64()))

    judged = votes.transform(mapped, judge, "doc_id long, target double").where("doc_id is not null")
    judged = judged.groupBy("doc_id").agg(F.max("target").alias("target"))
    high, low = judged.where("target >= 0.5"), judged.where("target < 0.5")
    sizes = judged.agg(
        F.coalesce(F.sum((F.col("target") >= 0.5).cast("long")), F.lit(0)),
        F.coalesce(F.sum((F.col("target") < 0.5).cast("long")), F.lit(0)),
    ).first()
    chosen = _lowest(high, SAMPLE_ROWS).unionByName(_lowest(low, SAMPLE_ROWS))
    sample = with_copy_weight(sample_rows(texts, chosen))
    entries, _ = associated(sample, FEATURES, purity=0.6)
    row, entry, strength, target, weight = _sparse(sample, entries)
    # Both sides weigh what they weigh among all texts.
    for side, size in zip((target >= 0.5, target < 0.5), sizes):
        weight = np.where(side, weight * size / max(weight[side].sum(), 1e-9), weight) if side.any() else weight
    w, bias = fit_logistic(row, entry, strength, target, weight, len(entries))
    return Training(voters, model, Classifier(entries, w, bias))


def score_toxicity(df: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """All rows and columns with `score` (0 to 1) and `predicted` (1 from 0.5); columns of these names are replaced."""
    kept = [c for c in df.columns if c not in ("score", "predicted")]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(classifier.entries)
        for rows in batches:
            for first, last, data, offsets in text_slices(rows.column(text)):
                p = classifier.scores(data, offsets, lookup)
                own = rows.slice(first, last - first)
                columns = [*own.columns, pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(kept).schema)
    return df.select(kept).transform(mapped, score, f"{schema}, score double, predicted int")


def toxicity(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted.

    Null and empty texts score what the classifier gives a text without features. Repeated rows
    score alike; if an id has several labels, any toxic one counts; rows without id or label teach
    nothing, and a row without id is scored as not held out. Without toxic labels everything scores
    low. An empty table gives no rows. Of an id that stands in many rows, one teaches the lexicon and the classifier.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    classifier = train(rows, labels.select(F.col("doc_id").cast("long"), "toxic")).classifier
    scored = score_toxicity(rows, classifier)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
