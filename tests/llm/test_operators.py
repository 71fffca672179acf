"""The operators against brute force, round trips and held-out rows."""

import gzip
import hashlib
import io
import json
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard

import __spark_entry__ as entry
from tonearm.llm import toxicity as toxicity_module
from tonearm.llm import blocks, html_text, language_model, near_duplicates, packing, quality, repeats, token_files, tokens, warc
from tonearm.llm.decontaminate import decontaminate
from tonearm.llm.files import opened
from tonearm.llm.registry import llm_queries, tokenizer_file
from tonearm.llm.toxicity import toxicity

FOLDER = "/root/testdata/sf0.001"


def random_texts(seed, n, letters="abcdefgh é", longest=900):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(letters), rng.integers(0, longest))) for _ in range(n)]


def variants(seed, bases, n):
    """Copies, quotes, near copies, runs and other texts made of some bases."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(n):
        base, kind = bases[rng.integers(len(bases))], rng.integers(0, 5)
        if kind == 0:
            out.append(base)
        elif kind == 1:
            at = rng.integers(0, len(base) + 1)
            out.append("<" + base[at : at + rng.integers(150, 500)] + ">")
        elif kind == 2:
            text = list(base)
            for _ in range(rng.integers(1, 6)):
                if text:
                    text[rng.integers(len(text))] = "Z"
            out.append("".join(text))
        elif kind == 3:
            out.append(str(rng.choice(["", "x", "a" * int(rng.integers(150, 700)), "ab" * int(rng.integers(50, 400))])))
        else:
            out.append(random_texts(rng.integers(1 << 30), 1)[0])
    return out


def test_repeats_against_brute_force(spark, make):
    texts = variants(1, random_texts(2, 8, longest=2000), 60) + [None]
    count = Counter(b[i : i + 200] for t in texts for b in [(t or "").encode()] for i in range(len(b) - 199))
    want = {}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        want[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"))
    out = repeats.remove_repeats(make(enumerate(texts)).repartition(5)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text) for r in out} == want


def test_repeats_leave_only_what_is_read_later(spark, make, tmp_path, monkeypatch):
    """Chunks and the shuffles of settled steps are gone before places are compared; the rows stay right."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(str(d.getPath())) for d in manager.localDirs()]

    def shuffled():
        return {f.name for d in folders for f in d.rglob("shuffle_*.data")}

    for module in (blocks, repeats):
        monkeypatch.setattr(module, "shared_folder", lambda _, purpose: f"{tmp_path}/{purpose}")
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, there = spark.conf.get(setting), shuffled()
    passage = "".join(np.random.default_rng(11).choice(list("abcdefgh"), 300))
    texts = [f"{i} " + passage if i % 2 else f"only {i}" for i in range(20)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.write.parquet(f"{tmp_path}/rows")
    out = repeats.remove_repeats(spark.read.parquet(f"{tmp_path}/rows"))
    assert {d.name for d in tmp_path.iterdir()} == {"rows", "repeat-parts"}
    until = time.time() + 20
    while shuffled() - there and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - there and spark.conf.get(setting) == before
    # the passage, the blank and the digit in front
    assert sorted((r.doc_id, r.n_removed) for r in out.collect()) == [(i, 302 * (i % 2)) for i in range(20)]


def test_transforms_merge_without_order_of_shards():
    rng = np.random.default_rng(5)
    first, second, front = (rng.integers(0, 4, 60).astype(np.uint64) for _ in range(3))
    several = rng.random(60) < 0.1
    status = repeats.merge(first, second, front, several)
    order = rng.permutation(60)
    again = repeats.merge(first[order], second[order], front[order], several[order])
    # which of equal suffixes stands for them is free
    assert (np.minimum(status, 1)[order] == np.minimum(again, 1)).all() and ((status == 2)[order] == (again == 2)).all()


def test_language_model_counts_and_normalisation(spark, make):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["the", "The", "of", "cat", "dog", "é"], rng.integers(0, 30))) + f" only{i}" * (i % 3 == 0) for i in range(200)]
    out = {r.doc_id: r for r in language_model.score_texts(make(enumerate(texts)).repartition(3)).collect()}
    split = [re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) + [None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(200)]
    count = Counter(w for words, h in zip(split, held) if not h for w in words)
    n, v = sum(count.values()), len(count)
    for i, words in enumerate(split):
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        r = out[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(words), n)
        assert r.n_known == sum(count[w] > 0 for w in words) and abs(r.base_score - base) < 1e-9
    rows = make(enumerate(texts)).select("doc_id", "text").toArrow().combine_chunks().to_batches()[0]
    pairs = language_model.ChunkPairs(rows, "text", ~np.array(held))
    (_, body), = pairs.slices(1, counted=True)
    counts = next(iter(language_model._count(language_model.parts(iter([(0, 0, body)]))))).to_pylist()[0]["body"]
    table, history = language_model.Tables(counts, 0), []
    for _ in range(5):
        history.append(table.totals(table.replay(history)[-1] if history else table.start()))
    predict = language_model.Predictor(table, history)
    for context in (0, int(pairs.context[3]), 12345):
        known = predict(table.token, np.full(len(table.token), context))[1].sum()
        assert abs(known + predict(np.array([1], np.uint64), np.array([context]))[1][0] - 1) < 1e-9


def test_contexts_are_exact_words():
    """Each word is a context of its own, also where many words end alike."""
    text = " ".join(f"w{k}ing" for k in range(20_000)).encode()
    _, before, _ = language_model.token_stream(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert len(np.unique(before)) == 20_001 and len(np.unique(before[1:] % np.uint64(language_model.CLASSES))) == 1


def test_context_totals_cover_all_buckets(spark, make):
    """After a word that was always followed by the same word, that word is likely in every bucket, others aren't."""
    rng = np.random.default_rng(37)
    pairs = [(f"a{k}ing", f"b{k}") for k in range(3000)]
    texts = [" ".join(" ".join(pairs[j]) for j in rng.integers(0, 3000, 400)) for _ in range(200)]
    out = language_model.score_texts(make(enumerate(texts)).repartition(3)).where("held_out").selectExpr("sum(score) / sum(n_tokens)").first()
    assert out[0] > -2.2  # half of the tokens are known from the word before, the others are one of 3,000


def test_dense_arrays_come_back():
    rng = np.random.default_rng(41)
    arrays = (rng.integers(0, 1 << 63, 50).astype(np.uint64), np.zeros(0, np.uint32), rng.integers(0, 9, 3000).astype(np.uint32), rng.random(7).astype(np.float32))
    body = blocks.dense(*arrays)
    assert len(body) < 50 * 8 + 3000 + 7 * 4 + 100  # small numbers take less than a byte
    for own in (body, pa.py_buffer(body)):
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, blocks.loose(own, *(a.dtype for a in arrays)), strict=True))
    assert [len(a) for a in blocks.loose(blocks.dense(arrays[1], arrays[1]), np.uint32, np.uint32)] == [0, 0]


def test_language_model_removes_files_that_nothing_reads(spark, make, tmp_path, monkeypatch):
    """Sweeps send no names again, and what is left at any time stays small against the texts."""
    rng = np.random.default_rng(43)
    words = np.array([f"w{k}" for k in range(20_000)])
    texts = [" ".join(rng.choice(words, 2000)) for _ in range(200)]
    used, write = [], language_model.written

    def stored():
        return {f.relative_to(tmp_path).parts[0]: f.stat().st_size for f in tmp_path.rglob("*.parquet")}

    def observed(df, *purpose):
        out = write(df, *purpose)
        used.append(sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")))
        return out

    monkeypatch.setattr(blocks, "shared_folder", lambda _, purpose: f"{tmp_path}/{purpose}-{len(used)}")
    monkeypatch.setattr(language_model, "written", observed)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    out = language_model.score_texts(make(enumerate(texts)).repartition(3))
    assert {name.rpartition("-")[0] for name in stored()} == {"lm-chunks", "lm-answers"}
    assert max(used[3:]) < 2.5 * sum(map(len, texts)), used
    assert spark.conf.get(setting) == before and out.count() == 200


def test_language_model_questions_beyond_memory(monkeypatch):
    """A bucket finds the same pairs and places, also where its questions lie in a file."""
    texts = pa.RecordBatch.from_pydict({"text": ["a b a b c", "b a", None]})
    body = next(language_model.ChunkPairs(texts, "text", np.array([True, False, True])).slices(1, counted=True))[1]
    questions = [(0, chunk, body) for chunk in range(40)]
    found = [b.to_pylist() for b in language_model._count(blocks.parts(iter(questions)))]
    monkeypatch.setattr(language_model, "SPOOL_BYTES", 1)
    assert [b.to_pylist() for b in language_model._count(blocks.parts(iter(questions)))] == found
    (counts, *places), = found
    assert language_model.Tables(counts["body"], 0).used.sum() == 40 * 7 and [r["chunk"] for r in places] == list(range(40))
    pairs = len(language_model.Tables(counts["body"], 0).asked_word)
    assert all((np.cumsum(blocks.loose(r["body"], np.uint32)[0]) == np.arange(pairs)).all() for r in places)


def test_stirling_numbers():
    logs = language_model.stirling_logs(0.5)
    assert np.allclose(np.exp(logs[3, 1:4]), [0.75, 1.5, 1.0])  # (1-d)(2-d), 3(1-d), 1


def test_language_model_beats_unigrams_on_held_out_texts(spark):
    out = llm_queries()["op4_language_model"](spark, FOLDER).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert out[0] > out[1]


def brute_components(texts):
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        sets.append({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [len(s) for s in sets], [find(i) for i in range(len(sets))]


def test_near_duplicates_against_brute_force(spark, make, monkeypatch):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = ["", None, "a", "A", "a b", "a  b", "b a"]
    for _ in range(12):
        base = list(rng.choice(vocabulary, rng.integers(3, 150)))
        for _ in range(rng.integers(1, 14)):
            copy = list(base)
            for _ in range(rng.integers(0, 5)):
                copy[rng.integers(len(copy))] = str(rng.choice(vocabulary))
            texts.append(" ".join(copy))
    # one large group of many components, and a chain: each text is like the next, but not like the last
    for _ in range(60):
        copy = list(vocabulary[:40])
        for _ in range(rng.integers(0, 4)):
            copy[rng.integers(len(copy))] = str(rng.choice(vocabulary))
        texts.append(" ".join(copy))
    texts += [" ".join(f"z{k}" for k in range(2 * i, 2 * i + 60)) for i in range(40)]
    sizes, roots = brute_components(texts)
    for block in (near_duplicates.BLOCK_SHINGLES, 400):  # whole clusters, and clusters in blocks
        monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", block)
        out = sorted(near_duplicates.near_duplicates(make(enumerate(texts))).collect())
        assert [(r.n_shingles, r.component_id) for r in out] == list(zip(sizes, roots))
        assert [r.kept for r in out] == [r.doc_id == r.component_id for r in out]


def test_decontamination_against_brute_force(spark, make):
    rng = np.random.default_rng(11)
    vocabulary = ["a", "b", "c1", "é", "dd", "Z"]
    items = [" ".join(rng.choice(vocabulary, rng.integers(0, 16))) for _ in range(40)] + ["a b a b a b a b a b a b"]
    texts = [" , ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(60)]
    texts += [items[k] + " - " + texts[k] for k in range(30)] + items[:5]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in enumerate(items):
        w = word.findall(t.lower())
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate(make(enumerate(texts)), benchmark).collect()}
    for i, t in enumerate(texts):
        w, hit, found = word.findall(t.lower()), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(found), digest, bool(hit))


def test_quality_counts_against_brute_force(spark, make):
    rng = np.random.default_rng(13)
    vocabulary = ["the", "of", "é", "x|y", "###", "A!", "12", "wörd"]
    texts = ["", None, "\n\n", "a\na", "b\n a\nb\n"]
    for _ in range(200):
        some = vocabulary[: rng.integers(1, 9)]
        texts.append("".join(rng.choice(some) + rng.choice([" ", "\n", "  ", "\t"], p=[0.7, 0.2, 0.05, 0.05]) for _ in range(rng.integers(1, 60))))
    got = {r.doc_id: r for r in quality.quality(make(enumerate(texts))).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [line for line in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        twice, covered = Counter(windows), set()
        for k, x in enumerate(windows):
            if twice[x] > 1:
                covered |= set(range(k, k + 8))
        r = got[i]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert r.kept == (r.rejected_by is None) and not (r.base_failed and r.kept)


def test_verdict_does_not_depend_on_the_order(spark):
    documents = spark.read.parquet(FOLDER + "/documents.parquet")
    one = quality.quality(documents, order=quality.RULES).drop("rejected_by")
    other = quality.quality(documents, order=quality.RULES[::-1]).drop("rejected_by")
    assert one.exceptAll(other).isEmpty()
    order = quality.cascade_order([("digits", 1.0, 5), ("capitals", 0.5, 5), ("symbols", 0.1, 0)])
    assert [r.name for r in order[:2]] == ["capitals", "digits"]


def test_labelled_quality(spark):
    kept = llm_queries()["op5_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality is not null")
    wrong = kept.join(labels, "doc_id").where("n_words >= 20").where("kept <> (quality = 1)")
    assert wrong.count() == 0


def test_archive_against_sql_and_in_any_ranges(spark, folder):
    rows = [(i, None if i % 7 == 0 else f"http://h.example/{i}?é\n", ("<p>" + "x" * (i % 40) * 5 + "</p>") if i % 5 else None) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc.archive_round_trip(pages.repartition(3), with_payload=True).collect()
    first = {}
    for i, _, h in rows:
        first.setdefault((h or "").encode(), i)
    for r in out:
        payload = (rows[r.page_id][2] or "").encode()
        least = first[payload] if len(payload) >= 100 else r.page_id
        assert (r.payload_bytes, r.payload_digest, r.url) == (len(payload), hashlib.sha256(payload).hexdigest(), rows[r.page_id][1])
        assert (r.record_type, r.refers_to) == (("response", None) if least == r.page_id else ("revisit", least))
        assert r.payload == (payload if r.record_type == "response" else None)
    files = warc.write_archives(warc.with_references(pages.selectExpr("page_id", "url", "cast(coalesce(html, '') as binary) payload").coalesce(1)), folder)
    row = files.first()
    for step in (97, 1000, 1 << 20):
        found = []
        with opened(row.path) as stream:
            for start in range(0, row.bytes, step):
                found += [place for place, _, _ in warc.records(stream, row.bytes, start, start + step)]
        assert len(found) == len(set(found)) == 300


def test_false_magic_is_no_record():
    payload = warc.MAGIC * 50 + b"WARC/1.1\r\n\r\n"
    data = warc.record("response", 1, None, None, hashlib.sha256(payload).hexdigest(), len(payload), payload, "2024-01-01T00:00:00Z")
    stored = zlib.compressobj(0, wbits=31)
    member = stored.compress(data) + stored.flush()
    archive = member + gzip.compress(data)
    places = [p for start in range(0, len(archive), 50) for p, _, _ in warc.records(io.BytesIO(archive), len(archive), start, start + 50)]
    assert places == [0, len(member)]


def test_long_headers_are_found():
    url = "http://h.example/" + "".join(map(str, range(400_000)))
    data = warc.record("response", 1, None, url, hashlib.sha256(b"x").hexdigest(), 1, b"x", "2024-01-01T00:00:00Z")
    archive = gzip.compress(data) * 2
    found = [fields["warc-target-uri"] for _, fields, _ in warc.records(io.BytesIO(archive), len(archive), 0, len(archive))]
    assert found == [url, url] and len(url) > 1 << 20
    assert len(list(warc.records(io.BytesIO(archive), len(archive), 1, len(archive)))) == 1


def test_lost_records_are_an_error(spark, monkeypatch):
    read = warc.read_archives
    monkeypatch.setattr(warc, "read_archives", lambda files, **named: read(files, **named).where("page_id <> 3"))
    pages = spark.createDataFrame([(i, None, f"<p>{i}</p>") for i in range(5)], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="4 records were read of 5 written"):
        warc.archive_round_trip(pages)


def test_pieces_are_encoded_as_whole_texts():
    from tokenizers import Tokenizer

    rng = np.random.default_rng(17)
    parts = ["a", "the", " ", "  ", "\n", "\n\n", "\t", " ", " ", "é", "1", "!", "'s", " x", "中文", "\x85", "\x1c", "😀", "\r\n", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(1500)] + ["", None]
    plain = Tokenizer.from_file(tokenizer_file())
    import pyarrow as pa

    for first, last, ids, bounds in tokens.encoded(pa.array(texts), tokenizer_file(), 2):
        for i in range(first, last):
            want = plain.encode(texts[i] or "", add_special_tokens=False).ids + [2]
            assert ids[bounds[i - first] : bounds[i - first + 1]].tolist() == want


def test_token_files_give_back_what_the_tokenizer_gives(spark, make):
    from tokenizers import Tokenizer

    texts = random_texts(19, 120, "abc de\n", 4000)
    plain, start = Tokenizer.from_file(tokenizer_file()), 0
    out = token_files.token_files(make(enumerate(texts)).repartition(4), tokenizer_file(), with_ids=True).orderBy("doc_id").collect()
    for r, t in zip(out, texts):
        want = np.array(plain.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (start, len(want) // 4, zlib.crc32(want), want)
        start += r.n_tokens


def test_reader_decompresses_only_what_it_needs_and_finds_damage():
    sink = io.BytesIO()
    writer = token_files.TokenFileWriter(sink)
    lengths = np.array([5, 200_000, 1, 300_000, 7])
    ids = np.arange(lengths.sum()) % 50_000
    writer.add(ids, [1, 2, None, 4, 5], lengths)
    writer.close()
    raw = sink.getvalue()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == ids.astype("<u2").tobytes()
    file = token_files.TokenFile(Sized(raw))
    read, frame = [], file._frame
    file._frame = lambda k: read.append(k) or frame(k)
    assert file.ids(4, 5).tolist() == ids[-7:].tolist() and len(read) == 1
    assert file.ids(0, 5).tolist() == ids.tolist() and file.doc_ids[2] == token_files.NO_ID
    damaged = bytearray(raw)
    damaged[100] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.TokenFile(Sized(bytes(damaged))).ids(0, 1)


class Sized(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_sum_of_squares_choice():
    packer = packing.Packer(8)
    rng = np.random.default_rng(23)
    for size in rng.integers(1, 8, 400).tolist():
        count, best = packer.count.copy(), []
        for level in range(0, 8 - size + 1):
            if level and not count[level]:
                continue
            after = count.copy()
            if level:
                after[level] -= 1
            if level + size < 8:
                after[level + size] += 1
            best.append(int((after[1:8] ** 2).sum()))
        level = packer.level_for(size)
        after = count.copy()
        if level:
            after[level] -= 1
        if level + size < 8:
            after[level + size] += 1
        assert int((after[1:8] ** 2).sum()) == min(best)
        packer.place((0, 0, np.zeros(size, np.uint32)))


def test_packing_covers_every_id_once_without_padding(spark, make):
    from tokenizers import Tokenizer

    texts = random_texts(29, 200, "abc de\n", 6000)
    plain = Tokenizer.from_file(tokenizer_file())
    want = [np.array(plain.encode(t, add_special_tokens=False).ids + [1], "<u4") for t in texts]
    out = packing.pack(make(enumerate(texts)).repartition(3), tokenizer_file()).orderBy("sequence_id", "offset").collect()
    seen, ends = [0] * len(texts), Counter()
    for r in sorted(out, key=lambda r: (r.doc_id, r.start)):
        assert r.start == seen[r.doc_id] and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())
        seen[r.doc_id] += r.length
    assert seen == [len(w) for w in want]
    for r in out:
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert all(n <= 2048 and n & (n - 1) == 0 or n == 2048 for n in ends.values())
    assert sum(n < 2048 for n in ends.values()) <= 3 * 11


def test_toxic_words_are_found_from_few_labels(spark, make):
    rng = np.random.default_rng(31)
    clean, bad = [f"{a}{b}" for a in "bcdfghjk" for b in ("an", "or", "il", "ut")], ["vilest", "vilebo", "grotty", "muckey"]
    rows, labels = [], []
    for i in range(1500):
        words = list(rng.choice(clean, rng.integers(5, 40)))
        toxic = i % 9 == 0
        if toxic:
            for _ in range(rng.integers(2, 5)):
                words.insert(rng.integers(len(words)), str(rng.choice(bad)))
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, int(toxic)))
    got = toxicity(make(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert all(r.predicted == (r.doc_id % 9 == 0) and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_labels_of_held_out_rows_are_not_used(spark, make):
    rows = [(i, f"word{i % 11} other text here" + (" awful" if i % 4 == 0 else "")) for i in range(400)]
    labels = [(i, int(i % 4 == 0)) for i in range(400)]
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    one, other = (
        sorted((r.doc_id, r.score) for r in toxicity(make(rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect())
        for x in (labels, turned)
    )
    assert one == other


PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body><div id="cookie-notice">We use cookies</div><header><h1>Site</h1></header>
<div class="box7">Read our weekly letter</div><main><article class="post"><header><h1>Hello &amp; w&ouml;rld {0}</h1></header><p>One <b>two</b><br>three {0}
<a href="x>y">four</a>.<p>Five {1}<ul><li>a<li>b</ul><!-- no --><aside>side</aside><script>var t="</p>";</script>
<section id="comments"><p>nice</p></section></article></main><form><input>f</form><footer>x</footer>"""
WANT = "Hello & wörld {0}\n\nOne two three {0} four.\n\nFive {1}\n\na\n\nb"


def test_label_model_finds_known_rates():
    """Rates of voters fitted on a sample drawn with known ones, two of them copying a third; posteriors by Bayes' rule."""
    rng = np.random.default_rng(11)
    n, prior = 200_000, 0.2
    m = toxicity_module.N_VOTERS
    truth = rng.random(n) < prior
    if_toxic, if_clean = rng.uniform(0.4, 0.8, m), rng.uniform(0.02, 0.2, m)
    votes = (rng.random((n, m)) < np.where(truth[:, None], if_toxic, if_clean)).astype(float)
    for k in (1, 2):
        same = rng.random(n) < 0.6
        votes[same, k] = votes[same, 0]
        if_toxic[k], if_clean[k] = (0.6 * r[0] + 0.4 * r[k] for r in (if_toxic, if_clean))
    model = toxicity_module.LabelModel.fit(n, votes.sum(axis=0), votes.T @ votes, prior)
    assert np.abs(model.if_toxic - if_toxic).max() < 0.03 and np.abs(model.if_clean - if_clean).max() < 0.02
    pairs = {(j, k) for j, k in zip(*np.nonzero(model.correlated))}
    assert pairs == {(j, k) for j in range(3) for k in range(3) if j != k}
    assert model.share[:3].max() < model.share[3:].min()
    some = votes[:50]
    rates = list(zip(model.share, model.if_toxic, model.if_clean))
    odds = [
        math.log(prior / (1 - prior)) + sum(s * (math.log(a / b) if v else math.log((1 - a) / (1 - b))) for v, (s, a, b) in zip(row, rates))
        for row in some
    ]
    assert model.posterior(some) == pytest.approx([1 / (1 + math.exp(-min(max(o, -30), 30))) for o in odds])
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.97


def test_an_id_in_many_rows_teaches_once(spark):
    texts = spark.createDataFrame([(1, "b")] * 5 + [(1, "a"), (2, "c"), (3, None), (4, None), (4, "d"), (5, "e")], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, 0.0), (4, 1.0), (9, 1.0)], "doc_id long, target double")
    got = sorted(tuple(r) for r in toxicity_module.sample_rows(texts, chosen).select("doc_id", "text", "target").collect())
    assert got == [(1, "a", 1.0), (2, "c", 0.0), (3, None, 0.0), (4, "d", 1.0)]


def test_main_text_of_a_marked_article():
    assert html_text.main_text(PAGE.format(1, 2)) == WANT.format(1, 2)
    assert html_text.main_text("") == "" and html_text.main_text("plain  text &lt;") == "plain text <"
    assert html_text.main_text("<p>a<p>b</div></p>c <script>x") == "a\n\nb\n\nc"


def test_templates_are_found_by_site(spark):
    """Without an article element: a box with the same text on all pages of a site goes, texts that many pages share stay."""
    page = '<body><div class="box7">Read our weekly letter</div><div class="t"><p>Page {0}, {1}</p><p>{2}</p></div></body>'
    rows = [(i, f"https://a.example/{i}", page.format(i, i * 7, "a shared line" if i % 2 else f"own {i}")) for i in range(40)]
    rows += [(100 + i, f"//b.example:80/{i}", page.format("same", 0, "copy")) for i in range(20)]
    rows += [(200, None, page.format("alone", 1, "x"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for i in range(40):
        assert got[i] == f"Page {i}, {i * 7}\n\n" + ("a shared line" if i % 2 else f"own {i}")
    assert "copy" in got[100] and "alone" in got[200]


def test_names_only_lower_the_importance(spark):
    article = '<article class="post category-legal tag-advertising"><div class="entry-header"><h1>A title</h1></div><p>Some long text</p></article>'
    assert html_text.main_text(f'<div class="layout has-sidebar">{article}</div>') == "A title\n\nSome long text"
    assert html_text.main_text('<div id="legal"><p>The whole of this page</p></div><div class="ad">Buy</div>') == "The whole of this page"
    teaser = '<div class="body"><p>A body that is much longer than the card</p></div><article>Card</article>'
    assert html_text.main_text(teaser) == "A body that is much longer than the card\n\nCard"
    page = '<body><div class="t"><p>A text of its own {0} that holds most</p></div><div class="{1}"><p>{2}</p></div></body>'
    rows = [(i, f"https://a.example/{i}", page.format(i, "related", f"said {i}")) for i in range(20)]
    rows += [(100 + i, f"https://b.example/{i}", page.format(i, "related", f"said {i % 2}")) for i in range(20)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(20):
        assert got[i] == f"A text of its own {i} that holds most\n\nsaid {i}"
        assert got[100 + i] == f"A text of its own {i} that holds most"


def test_comments_and_sidebars_go_at_any_length():
    long = "a long text of someone else " * 40
    post = "<p>" + "The post of the page. " * 10 + "</p>"
    want = ("The post of the page. " * 10).strip()
    for outer in ("<main>{}</main>", "<article>{}</article>", "<body>{}</body>"):
        for other in ('<section class="comments"><p>{}</p></section>', '<div id="disqus">{}</div>', '<ol class="commentlist"><li>{}</li></ol>',
                      '<div class="sidebar"><p>{}</p></div>', '<div role="complementary">{}</div>'):
            assert html_text.main_text(outer.format(post + other.format(long))) == want
            assert html_text.main_text(outer.format(other.format(long) + post)) == want
    assert html_text.main_text(f'<h1>Title</h1><div class="sidebar">{post}</div>') == f"Title\n\n{want}"
    assert html_text.main_text(f'<article class="comment">{post}</article>') == want
    assert html_text.main_text('<div class="comments">Only comments</div>') == ""


def test_comments_that_differ_go_on_every_host(spark):
    page = '<body><div class="t"><p>A text of its own {0}</p></div><div class="discussion"><p>said {0} at some length, longer than the text</p></div></body>'
    rows = [(i, f"https://a.example/{i}", page.format(i)) for i in range(12)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"A text of its own {i}" for i in range(12)}


HOSTILE = (
    '<a b=">"', '<a title="x>', "<a <![CDATA[", "<a ", "<div>", '<div class="ad">', "<", "<!--x", "<p><b>", "<li><b>", "</x>",
    "<a \"'>", "<a<", "<ul><li>", "<![CDATA[>", "&#x", "<table><tr><td>",
)


@pytest.mark.parametrize("unit", HOSTILE)
def test_malformed_pages_take_time_in_proportion(unit):
    """Four times the length takes about four times as long: sixteen times would be the square."""
    def seconds(size: int) -> float:
        source, best = unit * (size // len(unit)) + "<p>The end", float("inf")
        for _ in range(2):
            begin = time.perf_counter()
            html_text.main_text(source)
            best = min(best, time.perf_counter() - begin)
        return best

    assert seconds(1 << 19) < 9 * seconds(1 << 17) + 0.2


def test_ends_of_malformed_tags():
    assert html_text.main_text('<p title="a>b">one</p><p title="a>two</p>') == "one\n\ntwo"
    assert html_text.main_text("<p>a <![CDATA[b < c]]> d</p><![CDATA[<b>e</b> f") == "a b < c d\n\ne f"
    assert html_text.main_text("<p>1 < 2 and <b no end") == "1 < 2 and <b no end"
    assert html_text.main_text("<p>x</p><!-- never closed <p>y</p>") == "x"
    assert html_text.main_text("<title>t</title><textarea>u</textarea><script>if (a < b) '</p>'</script><p>v") == "v"


def test_importance_equals_entropy_of_a_small_site(spark):
    """Text and shape of every node against entropies counted in plain Python, and the branches that go."""
    rng = random.Random(3)
    pages = []
    for i in range(40):
        items = "".join(f"<li>{rng.choice('ab')}</li>" for _ in range(rng.randint(1, 3)))
        extra = "<em><q>x</q></em>" if i % 3 == 0 else ""
        pages.append(f'<body><div class="top">Site {i % 2}<ul>{items}</ul></div><div class="t"><p>Own {i}</p>{extra}</div><p>All rights</p></body>')
    texts, shapes, links = {}, {}, {}
    for source in pages:
        blocks, nodes = html_text.page_blocks(source)
        own, children = {}, {}
        for n in nodes:
            if n.up is not None and not n.noise:
                children.setdefault(n.name, set()).update(n.children)
                links[n.name] = (n.up.name, n.depth)
        for b in blocks:
            if b.node.up is not None and not b.noise:
                own.setdefault(b.node.name, set()).add(b.text)
        for name, found in own.items():
            texts.setdefault(name, []).extend(found)
        for name, found in children.items():
            if found:
                shapes.setdefault(name, []).append("|".join(sorted(found)))
    want = {}
    for name in links:
        said, shape = texts.get(name, []), shapes.get(name, [])
        pages_of = len(shape) or len(said)
        if not pages_of:
            continue
        m = math.log(max(pages_of, 2))
        text = 1 - sum(math.log(c) for c in Counter(said).values()) / len(set(said)) / m if said else None
        entropy = -sum(c / len(shape) * math.log(c / len(shape)) for c in Counter(shape).values()) / m if shape else None
        want[name] = (pages_of, text, entropy)
    rows = [(i, "https://a.example/", p, "a.example") for i, p in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    schema = "host string, copy long, nodes array<struct<node: bigint, parent: bigint, depth: int, named: boolean, leaf: boolean, value: bigint>>"
    values = frame.select("host", "html").mapInArrow(html_text._node_values, schema)
    got = html_text._importance(html_text._counted(values, ["host"]), ["host"]).collect()
    assert {r.node for r in got} == set(want)
    for r in got:
        pages_of, text, entropy = want[r.node]
        assert r.pages == pages_of and (r.parent, r.depth) == links[r.node]
        assert (r.text is None) == (text is None) and (r.shape is None) == (entropy is None)
        assert text is None or r.text == pytest.approx(text)
        assert entropy is None or r.shape == pytest.approx(entropy, abs=1e-9)
    found = html_text.extract(frame.drop("host")).orderBy("page_id").collect()
    assert all(r.text.startswith(f"Own {r.page_id}") and "Site" not in r.text and "rights" not in r.text for r in found)


def test_texts_of_all_hosts(spark):
    """An article copied to many hosts stays, branches that hosts with few pages share go, and hosts with enough pages judge alone."""
    story = '<body><div class="story"><h2>A title</h2><p>One paragraph</p></div></body>'
    rows = [(i, f"https://copy{i}.example/", story) for i in range(30)]
    side = '<body><div class="side">Follow us<p>Here</p></div><div class="t"><p>Own {0}</p></div></body>'
    rows += [(100 + i, f"https://few{i // 2}.example/{i}", side.format(i)) for i in range(24)]
    mood = '<body><div class="u"><p>Own {0}</p><p class="m">Mood {1}</p></div></body>'
    rows += [(200 + i, f"https://many.example/{i}", mood.format(i, i % 2)) for i in range(10)]
    rows += [(300 + i, f"https://one{i}.example/", mood.format(300 + i, i % 2)) for i in range(60)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {got[i] for i in range(30)} == {"A title\n\nOne paragraph"}
    assert [got[100 + i] for i in range(24)] == [f"Own {i}" for i in range(24)]
    assert [got[200 + i] for i in range(10)] == [f"Own {i}\n\nMood {i % 2}" for i in range(10)]
    assert [got[300 + i] for i in range(60)] == [f"Own {300 + i}" for i in range(60)]


def test_queries_are_registered_and_guarded():
    queries = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in queries) == 1
    assert "pipeline" in queries and set(entry.oracle_sql()) >= {"op6_warc"}


def test_archive_query_equals_sql(spark):
    sql = entry.oracle_sql()["op6_warc"].replace("FROM pages", f"FROM '{FOLDER}/pages.parquet'")
    want = sorted(duckdb.sql(sql).fetchall())
    got = llm_queries()["op6_warc"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in got) == want


def test_pipeline_runs(spark):
    out = entry.queries()["pipeline"](spark, FOLDER)
    rows = out.collect()
    assert rows and sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert json.dumps(out.columns[:7]) == json.dumps(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def test_collections_for_a_similarity():
    assert near_duplicates.collections_for(near_duplicates.PERCENT) == near_duplicates.COLLECTIONS
    assert near_duplicates.collections_for(80) == 15


def test_first_shingles_meet_where_sets_overlap():
    rng = np.random.default_rng(9)
    for _ in range(2000):
        union = rng.choice(1 << 40, rng.integers(1, 60), replace=False).astype(np.uint64)
        common = np.sort(rng.choice(union, rng.integers(0, len(union) + 1), replace=False))
        percent = int(rng.choice([50, 80, 85, 100]))
        a = np.sort(union[: rng.integers(1, len(union) + 1)])
        b = np.sort(union[rng.integers(0, len(union)) // 4 :])
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= percent * (len(a) + len(b) - shared):
            assert len(np.intersect1d(*(near_duplicates.first_shingles(s, common, percent) for s in (a, b))))


def test_texts_that_share_a_passage_are_not_compared_pair_by_pair(spark, make, monkeypatch):
    """Two thirds of each text are one passage: nearly all are candidates of each other, and few are linked."""
    dealt = []
    inner = near_duplicates._rest_and_all

    def counted(members):
        out = inner(members)
        dealt.append(out.count())
        return out

    monkeypatch.setattr(near_duplicates, "_rest_and_all", counted)
    monkeypatch.setattr(near_duplicates, "BLOCK_SHINGLES", 4000)
    passage = [f"p{k}" for k in range(60)]
    texts = [" ".join(passage + [f"t{i}x{k}" for k in range(30)]) for i in range(300)]
    texts += [" ".join(passage + [f"t{i}x{k}" for k in range(29)] + ["other"]) for i in range(0, 300, 10)]
    out = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(make(enumerate(texts))).collect()}
    assert out == {i: i if i < 300 else 10 * (i - 300) for i in range(330)}
    assert dealt and dealt[0] <= 60  # the linked ones alone


def test_components_of_paths_stars_and_copies(spark):
    from tonearm.llm.components import connected_components

    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(200)] + [(500, k) for k in range(501, 800)] + [(k, k) for k in range(900, 903)]
    edges += [(int(a), int(b)) for a, b in rng.integers(1000, 1400, (250, 2))]
    edges += edges[:50]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    frame = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = {r.node: r.root for r in connected_components(frame, "test").collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}
    assert connected_components(frame.where("false"), "test").count() == 0


def test_ids_that_need_four_bytes(spark, make):
    assert (token_files.width_for(65_535), token_files.width_for(65_536)) == ("<u2", "<u4")
    texts = ["one two", "", "three"]
    out = token_files.token_files(make(enumerate(texts)), tokenizer_file(), end_id=70_000, with_ids=True).collect()
    ends = [np.frombuffer(r.ids, "<u4")[-1] for r in out]
    assert ends == [70_000] * 3
    with pytest.raises(ValueError):
        token_files.TokenFileWriter(io.BytesIO(), "<u2").add(np.array([65_536]), [1], np.array([1]))


def test_files_of_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, plain = tokens.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.in_pieces and tokens.Encoder(tokenizer_file()).in_pieces
    texts = ["A  b\n\nC's é", "", "x y\nz", "ÀÉ 12"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    ids, bounds = encoder.encode(data, offsets, 7)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [
        plain.encode(t, add_special_tokens=False).ids + [7] for t in texts
    ]
