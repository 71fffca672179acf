"""Personal data, fill-in-middle and lexical search against brute force."""

import hashlib
import math
import random
import re
import signal

import pytest
from pyspark.sql import functions as F

from tonearm.llm import fill_in_middle as fim, lexical_search, personal_data as pii
from tonearm.llm.registry import table

FOLDER = "/root/testdata/sf0.001"

PIECES = [
    "a", "b@c", "@", ".", "x.y", "-", "+", "_", "%", "1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", ".5", "0001.2.3.4", " ",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "5500000000000004", "12", "+1 (743) 555-3824", "+", "(0)", "\n", "é", "@é.x", "me@ex.org",
    "you@sub.ex-a.co.uk", "000", "378282246310005", "６", "😀", "+49 30", "123456", "--", "..",
]


def base_spans(text):
    """The four base patterns as they are written down, with matches dropped and no retries."""
    def luhn(d):
        total = 0
        for k, c in enumerate(reversed(d)):
            v = int(c) * (1 + k % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    }
    found = [(m.start(), k, m.end()) for k, (kind, (rx, ok)) in enumerate(rules.items()) for m in re.finditer(rx, text) if ok(m[0])]
    return [(list(rules)[k], a, b) for a, k, b in sorted(found)]


def base_row(text):
    spans = base_spans(text or "")
    counts = [sum(s[0] == kind for s in spans) for kind in pii.BASE]
    return (*counts, hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest())


def test_base_spans_against_the_patterns(spark, make):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(4000)] + [None, ""]
    rows = pii.listed_spans(pii.find_personal_data(make(enumerate(texts)).repartition(3))).collect()
    for r in rows:
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == base_row(texts[r.doc_id]), texts[r.doc_id]
        base = ["%s:%d:%d" % s for s in base_spans(texts[r.doc_id] or "")]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE] == base
    assert len(rows) == len(texts)


def test_base_spans_of_the_documents(spark):
    docs = table(spark, FOLDER, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.listed_spans(pii.find_personal_data(docs)).collect()
    assert rows and all((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == base_row(texts[r.doc_id]) for r in rows)


IBAN = "DE89 3704 0044 0532 0130 00"


@pytest.mark.parametrize("text, kinds", [
    (f"Send it to {IBAN} Bank today", [("iban", 11, 38)]),
    ("GB82WEST12345698765432", [("iban", 0, 22)]),
    ("DE89 3704 0044 0532 0130 01", []),
    ("xDE89370400440532013000", []),
    ("my ssn is 123-45-6789 now", [("ssn", 10, 21)]),
    ("number 123-45-6789 of the list", []),
    ("ssn 000-45-6789 and 923-45-6789", []),
    ("call (743) 555-3824 or write", [("local_phone", 5, 19)]),
    ("the sum (743) 555-3824 is wrong", []),
    ("phone +1 (743) 555-3824", [("phone", 6, 23)]),
    ("host 2001:db8::ff00:42:8329 is up", [("ipv6", 5, 27)]),
    ("at 12:30:45 and a::b and 1:2:3:4:5:6:7:8:9", []),
    ("card 4111 1111 1111 1111", [("card", 5, 24)]),
    ("\U0001f600 me@ex.org", [("email", 2, 11)]),
])
def test_checksums_and_words(text, kinds):
    assert [s[:3] for s in pii.find_spans(text)] == kinds


def test_words_nearby_change_scores():
    near = pii.find_spans("pay by card 4111 1111 1111 1111")[0][3]
    plain = pii.find_spans("the value 4111 1111 1111 1111")[0][3]
    against = pii.find_spans("serial of the part 4111 1111 1111 1111")[0][3]
    far = pii.find_spans("pay by card" + " word" * 20 + " 4111 1111 1111 1111")[0][3]
    assert near > plain > against >= pii.THRESHOLD and far == plain


def test_redacted_texts(spark, make):
    text = f"write me@ex.org, call +1 (743) 555-3824, pay {IBAN}."
    rows = make([(1, text), (2, None), (3, ""), (4, "clean"), (1, text)])
    out = sorted((r.doc_id, r.redacted) for r in pii.find_personal_data(rows, with_text=True).collect() if r.doc_id != 2)
    assert out == [(1, "write [EMAIL], call [PHONE], pay [IBAN].")] * 2 + [(3, ""), (4, "clean")]
    assert [r.redacted for r in pii.find_personal_data(rows.where("doc_id = 2"), with_text=True).collect()] == [None]


@pytest.mark.parametrize("unit", ["a", "1", "1.", "1 ", "@", "@a", "a@a", "+1", "+1(", "a.", "AA11", "1:", "f:", "1-", "1.2.3.4", "DE89 3704 ", ". 1"])
def test_hostile_texts_take_linear_time(unit):
    """A search in quadratic time would take many times the seconds that the alarm allows."""
    signal.signal(signal.SIGALRM, lambda *_: pytest.fail("too slow"))
    signal.alarm(8)
    try:
        pii.find_spans(unit * (400_000 // len(unit)))
    finally:
        signal.alarm(0)


def fim_expected(doc_id, text):
    text = text or ""
    head = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(head[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(text)
    low, high = min(h[0] % (n + 1), h[1] % (n + 1)), max(h[0] % (n + 1), h[1] % (n + 1))
    p, m, s = "<P>" + text[:low], "<M>" + text[low:high], "<S>" + text[high:]
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", low, high - low, s + p + m
    return n, "psm", low, high - low, p + s + m


@pytest.mark.parametrize("piece", [1, 2, 3, 7, fim.PIECE])
def test_fill_in_middle_round_trip(spark, make, piece):
    rng = random.Random(piece)
    letters = ["<", ">", "P", "S", "M", "<P", "S>", "é", "\U0001f600", "word ", "\n", "<M>" if piece == 7 else "x"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(300)] + [None, "", "<S>", "<<P", "a" * 300]
    rows = fim.fill_in_middle(make(enumerate(texts)).repartition(4), with_text=True, piece=piece).collect()
    assert len(rows) == len(texts) and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == fim_expected(r.doc_id, text)
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_scanner_restores_from_output_and_form_alone():
    rng = random.Random(1)
    for k in range(500):
        text = "".join(rng.choices(["<", ">", "P", "S", "M", "é", "x"], k=rng.randint(1, 12)))
        _, form, _, _, output = fim_expected(k, text)
        scanner, found, at = fim.Scanner(form), [], 0
        while at < len(output):
            step = rng.randint(1, 4)
            found += scanner.feed(output[at : at + step])
            at += step
        found += scanner.close()
        assert "".join(part for _, part in sorted(found)) == text


def test_fill_in_middle_of_repeated_rows_and_one_long_text(spark, make):
    """A third of the rows are equal, ids repeat with other texts, and one text has many pieces."""
    long = "wörd " * 400_000
    rows = [(5, "the same text")] * 100 + [(5, "another text"), (None, "no id"), (7, long)] + [(k, f"text {k}") for k in range(100, 300)]
    out = fim.fill_in_middle(make(rows).repartition(6), piece=1000).collect()
    assert len(out) == len(rows) and len({tuple(r) for r in out if r.doc_id == 5}) == 2
    assert [(r.n, r.restored_sha256) for r in out if r.doc_id == 7] == [(2_000_000, hashlib.sha256(long.encode()).hexdigest())]
    assert [r.n for r in out if r.doc_id is None] == [5]
    keys = [key for key, _ in fim._emit(1000)(0, rows[:100])]
    assert len({key[0] for key in keys}) == 100  # copies are dealt out
    assert set(keys) == {key for key, _ in fim._emit(1000)(0, reversed(rows[:100]))}


def test_the_second_sort_moves_nothing(spark, make):
    out = fim.fill_in_middle(make([(k, f"text {k}") for k in range(50)]))
    lineage = out.rdd._jrdd.toDebugString()
    assert lineage.count("ShuffledRDD") == 1


def search_expected(docs, items, top=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, split(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    big_n, big_l = len(held), sum(len(t) for _, t in held)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(split(t))
    df = {t: sum(t in set(own) for _, own in held) for t in set().union(*wanted.values())}
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, own in held:
            m = 100 - 90 + (90 * len(own) * big_n) // big_l
            score = 0
            for t in terms:
                tf = own.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


WORDS = ["the", "The", "of", "é", "É", "a1", "b-c", "don't", "naïve", "x", "über", "ÜBER", "\U0001f600", "rare", "a b", "zz"]


def corpus(seed, n):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choices(WORDS + [f"w{rng.randint(0, 30)}"], k=rng.randint(0, 30)))) for k in range(n)]
    return rows + [(3, rows[5][1]), (None, rows[6][1]), (900, None), (901, ""), (902, " .,- ")] + [(1000 + k, rows[7][1]) for k in range(40)]


@pytest.mark.parametrize("group_bytes", [lexical_search.GROUP_BYTES, 15_000])
def test_search_against_brute_force(spark, make, monkeypatch, group_bytes):
    monkeypatch.setattr(lexical_search, "CELLS", 64)
    docs = corpus(1, 200)
    items = [(k, " ".join((t or "").split()[:12])) for k, t in corpus(2, 25)] + [(50, "not there at all"), (51, None), (None, "rare über"), (None, "w1")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = lexical_search.search(make(docs).repartition(5), bench, group_bytes=group_bytes)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in out.collect()), key=str) == search_expected(docs, items)


def test_search_cuts_long_texts_between_terms(spark, make, monkeypatch):
    monkeypatch.setattr(lexical_search, "SLICE", 50)
    docs = [(1, "rare word " * 3000), (2, "x" * 5000 + " rare"), (3, "rare" * 900), (4, "rare")]
    items = [(1, "rare word"), (2, "x" * 5000)]
    out = lexical_search.search(make(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in out.collect()), key=str) == search_expected(docs, items)


def test_empty_sides_and_text_ids(spark, make):
    bench = spark.createDataFrame([("i", "rare")], "item_id string, text string")
    docs = make([(1, "rare"), (2, "other")])
    assert lexical_search.search(docs.where("false"), bench).count() == 0
    assert lexical_search.search(docs, bench.where("false")).collect() == []
    assert lexical_search.search(docs, spark.createDataFrame([("i", "--")], "item_id string, text string")).count() == 0
    assert [tuple(r)[:3] for r in lexical_search.search(docs, bench).collect()] == [("i", 1, 1)]


def test_long_clashing_and_missing(spark, make):
    clash = {c: F.lit(1) for c in ("item", "term", "rank", "score", "found", "form", "n", "item_id", "terms", "redacted")}
    docs = make([(1, "word " * 100_000 + "me@ex.org"), (None, None), (2, ""), (1, "word")]).withColumns(clash)
    assert pii.find_personal_data(docs).count() == 4 and fim.fill_in_middle(docs).count() == 4
    bench = spark.createDataFrame([(1, "word")], "item_id long, text string").withColumns({"doc_id": F.lit(1), "score": F.lit(1)})
    assert [(r.rank, r.doc_id) for r in lexical_search.search(docs, bench).collect()] == [(1, 1), (2, 1)]
    for empty in (pii.find_personal_data(docs.where("false")), fim.fill_in_middle(docs.where("false"))):
        assert empty.count() == 0
