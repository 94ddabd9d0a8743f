"""The corpus pipeline: stages over whole documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hexmart.llm import minhash, mixing, packing, quality, recompression
from hexmart.llm.frames import table
from hexmart.session import materialize

ORACLE_SQL = None  # a trained classifier and its decisions have no SQL form; tests/llm/test_pipeline.py holds the stages against brute force

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
REPEAT_WORDS = 50


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near-duplicates stays; rows of one id and a null id stay as they are."""
    gone = minhash.near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT).where("not kept").select("doc_id").distinct()
    return docs.join(materialize(gone, "near-duplicates"), "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word sequences of REPEAT_WORDS or more that occur anywhere else are cut from every text; every document stays."""
    return recompression.remove_repeats(docs, REPEAT_WORDS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, 0 to 3 times."""
    return mixing.take_mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each stretch of each document goes; copies that the mix made never share a sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", mix),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
