"""Every operator and stage on empty tables, missing values, repeated rows and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tonearm.llm.decontaminate import decontaminate
from tonearm.llm.html_text import extract
from tonearm.llm.language_model import score_texts
from tonearm.llm.near_duplicates import near_duplicates
from tonearm.llm.packing import pack
from tonearm.llm.quality import quality
from tonearm.llm.registry import tokenizer_file
from tonearm.llm.repeats import remove_repeats
from tonearm.llm.token_files import token_files
from tonearm.llm.toxicity import toxicity
from tonearm.llm.warc import archive_round_trip

LONG = "word " * 30_000 + "end " + "é" * 500
ROWS = [
    (1, "one two three four five"), (1, "one two three four five"), (2, None), (3, ""), (4, "  \n\t "), (None, "a text without id"),
    (5, LONG), (None, None), (6, "ONE two three four five"), (7, "x"),
]


@pytest.fixture(scope="module")
def documents(make):
    clash = {c: F.lit(1) for c in ("score", "chunk", "bucket", "body", "node", "row", "kept", "n_words", "root", "hits", "weight", "kind", "label")}
    return make(ROWS).withColumns(clash)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 1), (3, None, 0), (None, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "two three"), (2, None), (3, ""), (None, "four"), (1, "two three")], "item_id long, text string")


def pages_of(documents):
    return documents.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"), "score", "chunk")


def operators(labels, benchmark):
    return {
        "toxicity": lambda d: toxicity(d, labels), "decontaminate": lambda d: decontaminate(d, benchmark),
        "repeats": remove_repeats, "language_model": score_texts, "quality": quality,
        "warc": lambda d: archive_round_trip(pages_of(d)), "near": near_duplicates,
        "tokens": lambda d: token_files(d, tokenizer_file()), "pack": lambda d: pack(d, tokenizer_file()),
        "html": lambda d: extract(pages_of(d)),
    }


NAMES = sorted(operators(None, None))


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(name, documents, labels, benchmark):
    assert operators(labels, benchmark)[name](documents.where("false")).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_missing_values_and_repeated_rows(name, documents, labels, benchmark):
    out = operators(labels, benchmark)[name](documents).collect()
    if name == "pack":
        whole = [r for r in out if r.start == 0]
        assert len(whole) == len(ROWS) and sum(r.length for r in out) == sum(r.doc_tokens for r in whole)
        return
    assert len(out) == len(ROWS)
    ids = sorted((r[0] if name in ("html", "warc") else r.doc_id) or 0 for r in out)
    assert ids == sorted(i or 0 for i, _ in ROWS)
    same = [r for r in out if (r[0] if name in ("html", "warc") else r.doc_id) == 1]
    if name != "tokens":
        assert len(same) == 2 and same[0] == same[1]


def test_empty_labels_and_benchmark(documents, labels, benchmark):
    assert {r.predicted for r in toxicity(documents, labels.where("false")).collect()} == {0}
    assert {r.contaminated for r in decontaminate(documents, benchmark.where("false")).collect()} == {False}


def test_defined_results(documents, labels, benchmark):
    near = {(r.doc_id, r.n_shingles): r for r in near_duplicates(documents).collect()}
    assert near[(6, 3)].component_id == 1 and not near[(6, 3)].kept and near[(1, 3)].kept
    assert near[(2, 0)].component_id == 2 and near[(None, 0)].component_id is None and near[(None, 0)].kept
    found = {r.doc_id: r for r in decontaminate(documents, benchmark).collect()}
    assert (found[1].n_hit, found[1].n_items) == (3, 1) and not found[7].contaminated
    cut = {r.doc_id: r for r in remove_repeats(documents).collect()}
    assert (cut[3].n_bytes, cut[3].text, cut[2].text) == (0, "", "") and cut[5].n_removed >= 149_000
    lm = {r.doc_id: r for r in score_texts(documents).collect()}
    assert lm[3].n_tokens == 1 and lm[3].score < 0
    assert {r.kept for r in quality(documents).where("doc_id in (2, 3, 4, 7)").collect()} == {False}
    files = token_files(documents, tokenizer_file(), with_ids=True).orderBy("start").collect()
    assert files[0].doc_id is None and [r.start for r in files] == [sum(x.n_tokens for x in files[:k]) for k in range(len(files))]
    assert {len(r.ids) for r in files if r.doc_id in (2, 3)} == {4}


@pytest.mark.parametrize("number", range(5))
def test_stages(number, spark, documents, labels, benchmark, tmp_path):
    folder = f"file://{tmp_path}"
    labels.write.parquet(folder + "/labels.parquet")
    benchmark.write.parquet(folder + "/benchmark.parquet")
    name, stage = corpus_pipeline.STAGES[number]
    assert stage(spark, documents.where("false"), folder).count() == 0
    out = stage(spark, documents, folder)
    if name != "packing":
        assert out.columns == list(corpus_pipeline.COLUMNS)
    counts = {"toxicity": 10, "near_duplicates": 8, "suffix_repeats": 10, "decontamination": 7}
    if name in counts:
        assert out.count() == counts[name]


def test_stages_decide_by_row(spark, make, benchmark, tmp_path):
    """Two texts with one id, and near copies without an id."""
    folder = f"file://{tmp_path}"
    benchmark.write.parquet(folder + "/benchmark.parquet")
    copy = "p q r s t u v w x y z"
    docs = make([(0, copy), (1, copy), (1, "another text that is clean"), (2, "two three"), (2, "nothing here"), (None, copy)])
    stages = dict(corpus_pipeline.STAGES)
    rows = stages["near_duplicates"](spark, docs, folder).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [
        (0, copy), (1, "another text that is clean"), (2, "nothing here"), (2, "two three")
    ]
    rows = stages["decontamination"](spark, docs, folder).collect()
    assert sorted((r.doc_id or 0, r.text) for r in rows if r.doc_id == 2) == [(2, "nothing here")] and len(rows) == 5


def test_near_duplicates_of_the_pipeline(spark, make, tmp_path):
    """Five words and 80 %: a text with 20 % appended is a near duplicate, one with scattered changes is not."""
    base = [f"w{k}" for k in range(400)]
    longer = base + [f"more{k}" for k in range(80)]
    changed = [f"v{k}" for k in range(1000)]
    scattered = [f"x{k}" if k % 39 == 5 else w for k, w in enumerate(changed)]
    docs = make([(k, " ".join(t)) for k, t in enumerate((base, longer, changed, scattered))])
    rows = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, f"file://{tmp_path}").collect()
    assert sorted(r.doc_id for r in rows) == [0, 2, 3]
    assert [r.kept for r in sorted(near_duplicates(docs).collect())] == [True, True, True, False]
