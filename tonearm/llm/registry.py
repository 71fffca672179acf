"""The operators as named queries over the given tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tonearm.llm.decontaminate import decontaminate
from tonearm.llm.fill_in_middle import fill_in_middle
from tonearm.llm.html_text import extract
from tonearm.llm.language_model import score_texts
from tonearm.llm.lexical_search import search
from tonearm.llm.near_duplicates import near_duplicates
from tonearm.llm.packing import pack
from tonearm.llm.personal_data import find_personal_data, listed_spans
from tonearm.llm.quality import quality
from tonearm.llm.repeats import RESULT as REPEAT_COLUMNS, remove_repeats
from tonearm.llm.token_files import token_files
from tonearm.llm.toxicity import toxicity
from tonearm.llm.warc import archive_round_trip

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file() -> str:
    """The tokenizer of the queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(texts, with_text=False).select("doc_id", *REPEAT_COLUMNS)


def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents")).drop("rejected_by")


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = archive_round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(table(spark, folder, "documents"), tokenizer_file()).drop("ids")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_file())


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return listed_spans(find_personal_data(table(spark, folder, "documents")))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle(table(spark, folder, "documents"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def llm_queries() -> dict[str, Query]:
    queries = (
        op1_toxicity, op2_decontamination, op3_suffix_repeats, op4_language_model, op5_quality, op6_warc,
        op7_near_duplicates, op8_token_files, op9_packing, op10_main_text, op11_personal_data,
        op12_fill_in_middle, op13_lexical_search,
    )
    return {query.__name__: query for query in queries}


def llm_oracles() -> dict[str, str]:
    from tonearm.llm.oracles import ORACLES

    return ORACLES
