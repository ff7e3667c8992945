"""A pipeline over the documents: filter, dedup, mix and pack.

Each stage works on all that the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import line_dedup, mixing, near_dedup, packing, quality
from starloom.llm.common import ready, scratch, table
from starloom.llm.tokens import tokenizer_path


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ready(spark)
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated three-line windows stay where they come first. All documents stay,
    without text if every line has gone."""
    ready(spark)
    return line_dedup.cleaned_documents(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, likeness 0.8."""
    ready(spark)
    return near_dedup.kept_documents(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each whole; those without words go."""
    ready(spark)
    return mixing.mixed_documents(docs, weights=(5, 2, 1), budget=1.5, max_epochs=2.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of 4096 tokens."""
    ready(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("quality_filter", filter_quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trees, sketches and tokenizers are not SQL; tests/llm has a plain version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table to packed pieces."""
    store = scratch(ready(spark))
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.keep(stage(spark, docs, sf_dir), name)
    return docs
