"""Mixing sources to target weights by capped water-filling.

All sources share a budget by weight. No target exceeds ``max_epochs`` times its source's size:
what a clamped source can't take is shared among the others by weight, until none is above.
Each source is then repeated whole as often as its target allows. The words that are still
missing come from a seeded order of its documents, from the first on. The last document is
taken whole or not at all, whichever brings the source nearer to its target; so a source misses it
by half a document at most, unless the cap forbids that document.

Sums along the seeded order run within buckets of the order, then over the buckets of a block and
over blocks, so no source, however large, is gathered or sorted in one task.

Null text has size 0, a null source is a source of its own and comes last, a null doc_id sorts
like an empty text. Rows that repeat a doc_id count each, and their texts are drawn apart; equal
rows are interchangeable. An empty table gives no rows. Columns of the input can have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import WORD, scratch

SEED = "mix-1"
#: Rows of a source that a bucket of its seeded order holds on average, at most.
BUCKET_ROWS = 2000
#: Hexadecimal digits by which the buckets of a block differ.
BLOCK_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], budget: float,
                   max_epochs: float) -> DataFrame:
    """Water-filling over one row per source.

    ``sizes`` has source and source_size; sources in code point order, null last, take the
    weights in turn. Adds weight and target. Sources are ordered by the level at which they
    reach their cap; a source is clamped if its cap lies below its share of what the sources
    before it leave. The windows run over sources, not documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy(F.col("_cap") / F.col("weight"), "_turn")
    capped = sizes.withColumns({
        "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1),
        "_turn": F.row_number().over(order),
        "_cap": F.col("source_size") * float(max_epochs),
        "_budget": F.sum("source_size").over(everything) * float(budget),
    })
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = capped.withColumns({
        "_level": (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(rest),
        "_order": F.row_number().over(by_level),
    })
    free = F.col("_cap") > F.col("weight") * F.col("_level")
    first_free = F.min(F.when(free, F.col("_order"))).over(everything)
    level = levels.withColumn("_first", first_free).withColumn(
        "_final", F.max(F.when(F.col("_order") == F.col("_first"), F.col("_level")))
        .over(everything))
    target = F.when(F.col("_final").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("weight") * F.col("_final")))
    return level.select("source", "source_size", "weight", target.alias("target"))


def _source_key() -> Column:
    """The source as a key that joins: never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def mixture(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), budget: float = 1.5,
            max_epochs: float = 2.0, seed: str = SEED, whole_rows: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, taken per document: the words the mix takes
    of it, repeats counted. ``whole_rows`` adds the input row as the struct ``row``."""
    store = scratch(docs.sparkSession)
    draw = F.md5(F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if whole_rows else []
    sized = store.keep(docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), draw.alias("_draw"),
        _source_key().alias("_key"), *row), "sized")
    rows = sized.count()
    digits = 1
    while 16 ** digits * BUCKET_ROWS < rows:
        digits += 1
    bucket = F.substring("_draw", 1, digits)
    sums = store.keep(sized.groupBy("_key", bucket.alias("_bucket")).agg(
        F.first("source", ignorenulls=True).alias("source"),
        F.sum("size").alias("_size")), "bucket_sizes")
    sources = sums.groupBy("_key").agg(F.first("source", ignorenulls=True).alias("source"),
                                       F.sum("_size").alias("source_size"))
    targets = source_targets(sources.select("source", "source_size"), weights, budget,
                             max_epochs).withColumn("_key", _source_key()).drop("source")
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("_whole", whole.cast("long")).withColumn(
        "_extra", F.round("target").cast("long") - F.col("_whole") * F.col("source_size"))
    before = (Window.unboundedPreceding, -1)
    block = F.substring("_bucket", 1, max(1, digits - BLOCK_DIGITS))
    inside = Window.partitionBy("_key", "_block").orderBy("_bucket").rowsBetween(*before)
    blocks = sums.groupBy("_key", block.alias("_block")).agg(F.sum("_size").alias("_all"))
    above = Window.partitionBy("_key").orderBy("_block").rowsBetween(*before)
    blocks = blocks.select("_key", "_block",
                           F.coalesce(F.sum("_all").over(above), F.lit(0)).alias("_earlier"))
    # Stored, so that Spark knows its size and broadcasts it only while that is small.
    starts = store.keep(sums.select("_key", "_bucket", "_size", block.alias("_block")).withColumn(
        "_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0))).join(
        blocks, ["_key", "_block"]).join(targets, "_key").select(
        "_key", "_bucket", "source_size", "target", "_whole", "_extra",
        (F.col("_inside") + F.col("_earlier")).alias("_start")), "bucket_starts")
    within = Window.partitionBy("_key", "_bucket").orderBy("_draw", "doc_id", "size")
    placed = sized.withColumn("_bucket", bucket).withColumn(
        "_within", F.coalesce(F.sum("size").over(within.rowsBetween(*before)), F.lit(0)))
    placed = placed.join(starts, ["_key", "_bucket"])
    ahead = F.col("_start") + F.col("_within")
    extra = F.col("_extra") - ahead
    # Not above the cap either, if that is no whole number of epochs.
    fits = (F.col("_whole") * F.col("source_size") + ahead + F.col("size")
            <= F.col("source_size") * float(max_epochs))
    last = F.when((extra >= F.col("size")) | ((2 * extra >= F.col("size")) & fits),
                  F.col("size")).otherwise(0)
    taken = F.col("_whole") * F.col("size") + last
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         taken.cast("long").alias("taken"), *(["row"] if whole_rows else []))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each whole, as often as taken; a document without words
    is left out."""
    mix = mixture(docs, whole_rows=True, **options).where("taken > 0")
    copies = F.floor(F.col("taken") / F.col("size")).cast("int")
    mix = mix.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return mix.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
