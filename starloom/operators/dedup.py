"""Keep-latest removal of duplicate sales.

A valid row goes when a later row, valid or not, has the same order and product. Rows
with a missing key match nothing. Invalid rows always stay, as the quarantine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import Scratch

KEY = ("order_id", "product_id")


def latest_by_key(staged: DataFrame, key: tuple[str, ...], order: str = "staging_id",
                  scratch: Scratch | None = None) -> DataFrame:
    """Rows without a row of the same key and a larger ``order``; a row that misses part of its
    key matches nothing and stays.

    A hash aggregate over key and order finds the keys that occur more than once, reduced
    map-side, so a hot key is one row per map task. The rows themselves are not aggregated:
    they meet the last place of repeated keys in an anti join, whose small side AQE broadcasts
    when it can, and whose large side it splits where a key is hot. With ``scratch`` the repeated
    keys are stored first: Spark then knows their size before it plans the join, and shuffles
    the rows only if many keys repeat.
    """
    repeated = (
        staged.groupBy(*key)
        .agg(F.max(order).alias("_last"), F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .select(*[F.col(name).alias(f"_of_{name}") for name in key], "_last")
    )
    if scratch is not None:
        repeated = scratch.keep(repeated, "repeated")
    same = reduce(Column.__and__, [F.col(name) == F.col(f"_of_{name}") for name in key])
    return staged.join(repeated, same & (F.col(order) < F.col("_last")), "left_anti")


def _valid() -> Column:
    return F.col("processed_flag") & F.col("error_message").isNull()


def latest_valid_sales(staged: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Valid sales that survive: what the fact load reads. Those without a key match nothing
    and all survive; the fact load rejects them with a reason."""
    return latest_by_key(staged, KEY, scratch=scratch).where(_valid())


def latest_carried(carried: DataFrame, staged: DataFrame) -> DataFrame:
    """Those ``carried`` sales of earlier loads that no ``staged`` row of a new load replaces. They
    are valid and differ in their keys, or have none and all stay. New rows have the higher
    numbers, so any with the same key is later, valid or not."""
    return carried.join(staged.select(*KEY), list(KEY), "left_anti")


def dedup_sales(staged: DataFrame) -> DataFrame:
    """All staged rows that survive, quarantine and keyless rows included."""
    return staged.where(~_valid()).unionByName(latest_valid_sales(staged))
