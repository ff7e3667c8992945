"""Keys of loaded sales, looked up without reading facts.

Every fact load stores, beside its facts, the order and product id of each sale it loaded, in
buckets of the order id, and a Bloom filter over these keys. A filter has 2**level blocks of
one bitmap; a key has all its bits in one block. A batch is joined with the blocks of its keys,
which leaves the loads and buckets that may hold some of them, and only their keys are read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A sale by its own key, whichever product version it was loaded with.
SALE_KEY = ("order_id", "product_id")

KEYS_SCHEMA = "order_id string, product_id string, load_run long, bucket int"
FILTER_SCHEMA = ("block long, bitmap binary, low string, high string, load_run long, "
                 "level int")

BUCKETS = 64
#: Bits of a bitmap, fixed by Spark's bitmap functions.
BLOCK_BITS = 32_768
#: About one key in 200 passes a filter that does not hold it.
BITS_PER_KEY = 12
PROBES = 4


def bucket() -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), "order_id"), F.lit(BUCKETS)).cast("int")


def level(keys: int) -> int:
    """Blocks for a number of keys, as a power of two."""
    return max(0, math.ceil(math.log2(max(1, keys) * BITS_PER_KEY / BLOCK_BITS)))


def _block(of_level: int) -> Column:
    return F.xxhash64(F.lit("block"), *SALE_KEY).bitwiseAND(F.lit((1 << of_level) - 1))


def _spots() -> list[Column]:
    """Places of a key's bits in its block."""
    return [F.pmod(F.xxhash64(F.lit(f"spot{i}"), *SALE_KEY), F.lit(BLOCK_BITS)).cast("long")
            for i in range(PROBES)]


def with_key(sales: DataFrame) -> DataFrame:
    """Keys of sales; a sale without a key has none."""
    keyed = reduce(Column.__and__, [F.col(name).isNotNull() for name in SALE_KEY])
    return sales.select(*SALE_KEY).where(keyed)


def keys_of(sales: DataFrame) -> DataFrame:
    """Distinct keys of sales."""
    return with_key(sales).distinct()


def write_keys(keys: DataFrame, path: str) -> None:
    """Store distinct keys in buckets; each bucket lies in few files, however large."""
    (keys.select(*SALE_KEY, bucket().alias("bucket")).hint("rebalance", F.col("bucket"))
     .write.partitionBy("bucket").parquet(path))


def write_filter(keys: DataFrame, count: int, path: str) -> None:
    """Store the filter over ``count`` distinct keys, a row per block."""
    size = level(count)
    spots = keys.select("order_id", _block(size).alias("block"),
                        F.explode(F.array(*_spots())).alias("spot"))
    blocks = spots.groupBy("block").agg(
        F.bitmap_construct_agg("spot").alias("bitmap"), F.min("order_id").alias("low"),
        F.max("order_id").alias("high"))
    blocks.withColumn("level", F.lit(size)).write.partitionBy("level").parquet(path)


def has_bit(spot: Column) -> Column:
    """Whether ``bitmap`` has a bit; bit 0 is the lowest of the first byte."""
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(spot / 8).cast("int") + 1, F.lit(1))),
                  16, 10).cast("int")
    return F.getbit(byte, (spot % 8).cast("int")) == 1


def may_hold(keys: DataFrame, filters: DataFrame, levels: list[int]) -> DataFrame:
    """(load_run, bucket) of the stored keys that may hold some of ``keys``.

    ``levels`` are those of the filters: a key meets one block of each, so this is a join on
    equal blocks. Loads whose order ids lie elsewhere drop out before any bit is read.
    """
    blocks = F.array(*[F.struct(F.lit(n).alias("level"), _block(n).alias("block"))
                       for n in sorted(levels)])
    # Where a large filter makes keys travel, they do so without bucket and spots.
    wanted = keys.select(*SALE_KEY, F.explode(blocks).alias("_at")).select("*", "_at.*").drop("_at")
    inside = F.col("order_id").between(F.col("low"), F.col("high"))
    bits = reduce(Column.__and__, [has_bit(spot) for spot in _spots()])
    return wanted.join(filters, ["level", "block"]).where(inside & bits).select(
        "load_run", bucket().alias("bucket")).distinct()


def selected(places: list[tuple[int, int]]) -> Column:
    """Condition on ``load_run`` and ``bucket`` for a list of them; it prunes partitions."""
    by_run: dict[int, list[int]] = {}
    for run, number in sorted(places):
        by_run.setdefault(run, []).append(number)
    return reduce(Column.__or__, [
        (F.col("load_run") == run) & F.col("bucket").isin(numbers)
        for run, numbers in by_run.items()
    ])


def found(stored: DataFrame, keys: DataFrame) -> DataFrame:
    """Distinct ``keys`` that the selected stored keys hold."""
    return stored.select(*SALE_KEY).join(keys, list(SALE_KEY), "left_semi").distinct()
