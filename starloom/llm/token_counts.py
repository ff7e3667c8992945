"""Token counts: an exact histogram of encoded document lengths.

Documents are encoded once and only their lengths leave the task. The histogram has a row per
distinct length, so its size follows the longest document and not the collection. Suffix sums
over it answer totals, quantiles and truncated totals for every context limit.

Null or empty text has the end ids only. Null ids, repeated rows and further columns make no
difference: every row counts once. An empty table has an empty histogram.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.tokens import batched, encoded_documents

_LENGTHS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
BLOCK = 1024


def encoded_lengths(docs: DataFrame, tokenizer: str, end_ids: int = 1) -> DataFrame:
    """(doc_id, n_tokens) of each row; ``end_ids`` are added to every document."""

    def lengths(batches):
        found = ((doc, len(ids) // 4 + end_ids) for doc, ids in
                 encoded_documents(batches, tokenizer))
        yield from batched(found, _LENGTHS)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lengths, "doc_id long, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs), one row for each length that occurs."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def with_suffix_sums(counts: DataFrame) -> DataFrame:
    """Add to each length L:

    docs_at_least, tokens_at_least   documents of L tokens or more, and their tokens
    truncated_tokens                 tokens left if every document is cut after L
    share_at_most                    share of documents with at most L tokens

    Sums run within blocks of lengths, and over one row per block.
    """
    block = F.floor(F.col("n_tokens") / BLOCK)
    stored = counts.withColumns({"_block": block, "_tokens": F.col("n_tokens") * F.col("n_docs")})
    behind = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored.groupBy("_block").agg(
        F.sum("n_docs").alias("_docs"), F.sum("_tokens").alias("_all"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_docs").over(behind), F.lit(0)).alias("_docs_behind"),
        F.coalesce(F.sum("_all").over(behind), F.lit(0)).alias("_tokens_behind"),
        F.sum("_docs").over(everything).alias("_total_docs"),
        F.sum("_all").over(everything).alias("_total_tokens"),
    )
    within = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc())
    at_least = F.sum("n_docs").over(within) + F.col("_docs_behind")
    tokens = F.sum("_tokens").over(within) + F.col("_tokens_behind")
    return (
        stored.join(blocks, "_block")
        .withColumns({"docs_at_least": at_least, "tokens_at_least": tokens})
        .select(
            "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
            (F.col("_total_tokens") - F.col("tokens_at_least")
             + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
            ((F.col("_total_docs") - F.col("docs_at_least") + F.col("n_docs"))
             / F.col("_total_docs")).alias("share_at_most"),
        )
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_longer, total_tokens, truncated_tokens) for any context limits, from the
    rows of ``with_suffix_sums``. Documents of exactly the limit are not longer."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(x,) for x in limits], "limit long")
    longer = F.col("n_tokens") > F.col("limit")
    tokens = F.col("n_tokens") * F.col("n_docs")
    return (
        sums.join(F.broadcast(asked))  # the given limits, against the histogram
        .groupBy("limit")
        .agg(
            F.sum(F.when(longer, F.col("n_docs")).otherwise(0)).alias("docs_longer"),
            F.sum(tokens).alias("total_tokens"),
            F.sum(F.least("n_tokens", "limit") * F.col("n_docs")).alias("truncated_tokens"),
        )
    )


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """(n_tokens): the smallest length that at least ``share`` of the documents don't exceed."""
    return sums.where(F.col("share_at_most") >= share).agg(F.min("n_tokens").alias("n_tokens"))
