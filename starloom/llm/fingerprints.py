"""Document fingerprints: threshold-scaled sketches of word shingles.

A text's words (lower case, cut at white space) give overlapping shingles of five words, or one
of all words if there are fewer. Of their 64-bit hashes the sketch keeps every one below
a fixed fraction of the range. Whether a hash is kept depends on nothing else, so sketches merge
by union, and the share of a small text contained in a far larger one can be estimated. A text
none of whose hashes lies below the threshold keeps its smallest, so that only texts without
words have an empty sketch. Two empty sketches have likeness 1, an empty and another one 0.

Null text is an empty text. A null doc_id is ordered last. doc_id should tell documents apart;
rows that repeat one are ordered by text. An empty table gives no rows. DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import SPACES, scratch
from starloom.operators.numbering import with_row_ids

WORDS = 5
FRACTION = 4
#: Documents of consecutive ids that are ordered in one window, at most.
BUCKET = 64


def sketch(text: Column, words: int = WORDS, fraction: int = FRACTION) -> Column:
    """Kept hashes of a text, ascending: array of long."""
    parts = F.filter(F.split(F.lower(text), f"[{SPACES}]+"), lambda w: w != "")
    limit = -(1 << 63) + (1 << 64) // fraction

    def hashes(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(found) - (words - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(found, i, words)))

    # A one-element array around the words names them once in the expression.
    all_hashes = F.flatten(F.transform(F.array(parts), lambda p: F.when(
        F.size(p) > 0, hashes(p)).otherwise(F.array().cast("array<bigint>"))))
    ordered = F.array_distinct(F.array_sort(all_hashes))
    return F.filter(ordered, lambda h, i: (h < F.lit(limit)) | (i == 0))


def as_text(kept: Column) -> Column:
    """The sketch as a string: 16 hexadecimal digits for each hash, ascending."""
    return F.array_join(
        F.transform(kept, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def merged(kept: Column) -> Column:
    """Aggregate: the sketch of all rows' texts together."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(kept))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two texts from their sketches."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second one has."""
    return F.when(F.size(a) == 0, F.when(F.size(b) == 0, 1.0).otherwise(0.0)).otherwise(
        F.size(F.array_intersect(a, b)) / F.size(a))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and its sketch, and next_text and next_sketch of the document that follows
    in ascending doc_id order; the first follows the last.

    Documents are ordered within buckets of consecutive ids. The last one of a bucket gets
    the first one of the next bucket by a join. Texts are shuffled once, by bucket.
    """
    store = scratch(docs.sparkSession)
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    base = docs.select("doc_id", place.alias("_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.floor(place / BUCKET).alias("_bucket"))
    firsts = base.groupBy("_bucket").agg(F.min("_id").alias("_id"))
    numbered = store.keep(with_row_ids(firsts, [F.col("_bucket")], "_n", store), "buckets")
    n = numbered.count()
    follows = numbered.select("_bucket", (F.col("_n") % F.lit(max(n, 1)) + 1).alias("_n")).join(
        numbered.select("_id", "_n"), "_n").drop("_n")
    heads = base.select("_id", "text").join(numbered.select("_id"), "_id", "left_semi")
    heads = heads.groupBy("_id").agg(F.min("text").alias("_head"))
    heads = follows.join(heads, "_id").select(
        "_bucket", "_head", sketch(F.col("_head")).alias("_head_sketch"), F.lit(True).alias("_h"))
    order = Window.partitionBy("_bucket").orderBy("_id", "text")
    rows = base.withColumn("sketch", sketch(F.col("text")))
    rows = rows.withColumns({
        "_next": F.lead("text").over(order), "_next_sketch": F.lead("sketch").over(order)})
    last = F.col("_next").isNull()
    rows = rows.join(heads, (rows["_bucket"] == heads["_bucket"]) & last, "left")
    return rows.select(
        "doc_id", "text", "sketch", F.coalesce("_next", "_head").alias("next_text"),
        F.coalesce("_next_sketch", "_head_sketch").alias("next_sketch"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, sketch, fingerprint) of every whole text."""
    return docs.select("doc_id", sketch(F.coalesce("text", F.lit(""))).alias("sketch")
                       ).withColumn("fingerprint", as_text(F.col("sketch")))
