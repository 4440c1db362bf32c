"""Corpus pipeline: documents go through the training-data operators, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept
and returns a DataFrame that is written and read again before the next stage.
All but the last return the columns of ``documents``; the last returns the
packed pieces.  A stage on an empty table returns an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import exact_dedup as _exact
from quarry.llm import packing as _packing
from quarry.llm import quality as _quality
from quarry.llm import simhash as _simhash
from quarry.llm import substring_dedup as _spans
from quarry.llm.common import documents, frozen
from quarry.llm.queries import END_ID, SEQUENCE, SIMHASH_BITS, SIMHASH_WORDS, WORD_BPE
from quarry.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on all labelled ones, predicts to be label 1."""
    return _quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return _exact.exact_dedup(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near fingerprints the document with the smallest id stays."""
    return _simhash.near_dedup(docs, SIMHASH_WORDS, SIMHASH_BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the sentences that repeat an earlier run; n_chars follows the text."""
    return _spans.deduplicated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents in sequences: ids as little-endian unsigned 32-bit integers, and their CRC-32."""
    rows = _packing.pack(docs, WORD_BPE, END_ID, SEQUENCE)
    return rows.select(F.col("id").alias("doc_id"), "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("simhash_near_dedup", simhash_near_dedup), ("substring_dedup", substring_dedup), ("packing", packing)]

#: The classifier is fitted and the packing is iterative: not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
