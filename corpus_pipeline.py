"""From raw documents to training sequences: five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as
the docs of the next one. All but the last return the columns of `documents`. Decisions hold for
rows by id and text, also for rows without an id and for texts that share an id. SQL can't express
the stages, so there is no oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tonearm.llm.blocks import written
from tonearm.llm.decontaminate import decontaminate
from tonearm.llm.near_duplicates import near_duplicates
from tonearm.llm.packing import pack
from tonearm.llm.registry import table, tokenizer_file
from tonearm.llm.repeats import remove_repeats
from tonearm.llm.toxicity import score_toxicity, train

#: Words of a shingle, and the similarity in percent, from which on texts are near duplicates in the pipeline.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> list[str]:
    return [c for c in COLUMNS if c in docs.columns]


def _without(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """The rows whose (id, text) is not among the lost (doc_id, text_hash); adds `_hash`."""
    lost = lost.select(F.col("doc_id").alias("_lost"), F.col("text_hash").alias("_lost_hash"))
    rows = docs.select(_columns(docs)).withColumn("_hash", F.xxhash64("text"))
    return rows.join(lost, F.col("doc_id").eqNullSafe(F.col("_lost")) & (F.col("_hash") == F.col("_lost_hash")), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier calls toxic go."""
    learned = train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score_toxicity(docs.select(_columns(docs)), learned.classifier)
    return scored.where("predicted = 0").select(_columns(docs))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays, and of repeated rows one."""
    judged = near_duplicates(docs, with_hash=True, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT)
    rest = _without(docs, judged.where(~F.col("kept")))
    return rest.dropDuplicates(["doc_id", "_hash"]).select(_columns(docs))


def remove_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose all bytes of repeated spans; a document that loses everything stays with an empty text."""
    rest = remove_repeats(docs.select(_columns(docs)))
    return rest.withColumn("n_chars", F.length("text").cast("long")).select(_columns(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"), with_hash=True)
    return _without(docs, judged.where("contaminated")).select(_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("suffix_repeats", remove_repeated_spans),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
