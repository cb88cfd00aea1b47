"""The corpus pipeline: five stages from documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents; each works on all that its predecessor kept.
Rows null in any column, repeated rows, empty tables and extra columns are
handled as the operators' docstrings say.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hexaccess.llm import lines, mixing, pieces, quality, simhash  # noqa: E402
from hexaccess.llm.common import read_table, stage_table  # noqa: E402


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of documents that are not held out, accepts."""
    return quality.accept(docs, read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats, or nearly, go; documents left without a line go with them."""
    return lines.deduplicated(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that of the smallest doc_id."""
    return simhash.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with their SentencePiece ids."""
    import public_tokenizers
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("source mix", mix_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: No SQL: a fitted classifier, XXH64 fingerprints and merge encodings are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's rows are a written table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
