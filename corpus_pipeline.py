"""A corpus from raw documents to packed training sequences, one operator a stage.

Every stage takes the documents the one before kept, written as Parquet and read again, and returns the documents it
keeps with all their columns; the last returns the pieces of packed sequences.

1. language ID: documents that speak no learned language (NULL, without a letter, or hardly a letter in known words) go;
2. near duplicates: of each group of similar documents (five words, 0.8) the one with the least id stays;
3. substring dedup: runs of 25 words or more that an earlier document has are cut out of the text;
4. decontamination: documents that hold a benchmark item go;
5. packing: what is left becomes sequences of at most 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import decontaminate, language, neardup, packing, substrings
from parcelwise.llm.neardup import Work


#: Share of letters that must be known to the predicted language.
LEAST_KNOWN = 0.2


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id isn't among ``ids``, and those without an id, as no operator could name them.

    The ids are written first: Spark knows their size then, and sends a short list to the tasks instead of shuffling
    all texts.
    """
    listed = Work(docs.sparkSession).keep(ids.select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct())
    return docs.join(listed, docs["doc_id"] == listed["_id"], "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that speak a language, learned from all labelled ones. Of a text that goes less than ``LEAST_KNOWN`` of
    the letters lie in words or grams of the predicted language; short clean texts have as great a share as long ones."""
    model = language.fit(docs, F.lit(True))
    found = language.predict(docs, model, evidence=True)
    return _without(docs, found.where((F.col("lang_pred") == language.UNKNOWN) | (F.col("known") < LEAST_KNOWN)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group."""
    return _without(docs, neardup.near_duplicates(docs, words=5, similarity=0.8).where("NOT kept"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out; every document stays, and ``n_chars`` follows the text."""
    cut = substrings.remove_spans(docs, substrings.repeated_spans(docs))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.find_items(docs, items))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, their ids as a checksum."""
    return packing.pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: SQL can express neither the learned language model nor the edit matching; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    work = Work(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
