"""A corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helioflow.llm import decontam, langid, line_dedup, packing, simhash
from helioflow.llm.common import read, stored
from helioflow.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and texts without letters."""
    return langid.known_language(docs, langid.fit(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes near-duplicate lines; no document goes."""
    return line_dedup.dedup_lines(docs)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    return simhash.without_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a test item."""
    return decontam.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; a row for each piece."""
    return packing.pack_sequences(docs, tokenizer_path())


STAGES = [("language ID", language), ("line dedup", lines), ("near-dedup", near_dups), ("decontamination", benchmark), ("packing", pack)]

#: SQL can't express SimHash over XXH64, MinHash lines, or packing: tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
