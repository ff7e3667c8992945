"""Row numbers and ranks over a whole frame without a single-task window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import Scratch

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row below
_BLOCK_BITS = 10  # slices are summed up in blocks of 1024


def _slice_starts(stored: DataFrame, slices: tuple[str, ...], spot: str, scratch: Scratch
                  ) -> DataFrame:
    """Per slice its first place and the rows before it, as a small stored table.

    Offsets are added up in two levels: over the slices of a block, one task per block, and
    over the blocks. A block is a file, or 1024 slices in a row.
    """
    block = F.col(slices[0]) if len(slices) > 1 else F.shiftright(slices[0], _BLOCK_BITS)
    counted = stored.groupBy(*slices).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(spot).alias("_first")
    ).withColumn("_block", block)

    def before(rows: str, window) -> Column:
        above = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(rows).over(above), F.lit(0))

    blocks = counted.groupBy("_block").agg(F.sum("_rows").alias("_all")).select(
        "_block", before("_all", Window.orderBy("_block")).alias("_earlier"))
    inside = before("_rows", Window.partitionBy("_block").orderBy(*slices))
    return scratch.keep(
        counted.withColumn("_inside", inside).join(blocks, "_block")
        .select(*slices, "_first", (F.col("_inside") + F.col("_earlier")).alias("_before")),
        "starts")


def slice_rows(df: DataFrame, order: list[Column], key: list[Column] | None = None,
               settle: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Range-partition and sort by ``order``; add the slice and the place within it.

    A hot value of the first column is split as long as later columns tell rows apart.
    With ``key``, the first columns of the order, rows that agree in them stay in one slice instead,
    and ``settle`` may join or drop rows there, as long as it keeps their order.
    The two columns are only stable once the frame is stored.
    """
    spot = F.monotonically_increasing_id()
    sorted_rows = df.repartitionByRange(*(key or order)).sortWithinPartitions(*order)
    return (
        settle(sorted_rows)
        .withColumn("_spot", spot)
        .withColumn("_slice", F.shiftright("_spot", _POSITION_BITS))
        .withColumn("_place", F.col("_spot") - F.shiftleft("_slice", _POSITION_BITS))
        .drop("_spot")
    )


def number_stored(stored: DataFrame, out: str, scratch: Scratch, start: int = 0,
                  slices: tuple[str, ...] = ("_slice",), spot: str = "_place") -> DataFrame:
    """Dense numbers start+1.. for a stored frame whose rows count up within slices.

    The slice starts hold one row per shuffle partition or input split. They are stored and
    carry no hint, so Spark knows their size: it broadcasts them up to its threshold, and the
    rows then stay where they are; beyond, it joins on the slice, which is bounded in size.
    """
    starts = _slice_starts(stored, slices, spot, scratch)
    return (
        stored.join(starts, list(slices))
        .withColumn(out, F.col("_before") + F.col(spot) - F.col("_first") + F.lit(start + 1))
        .drop(*slices, spot, "_first", "_before")
    )


def with_row_ids(df: DataFrame, order: list[Column], out: str, scratch: Scratch,
                 start: int = 0) -> DataFrame:
    """Add dense numbers in the order of ``order``, which has to tell all rows apart."""
    stored = scratch.keep(slice_rows(df, order), f"numbered_{out}")
    return number_stored(stored, out, scratch, start)


def spread_ranks(stored: DataFrame, ranks: dict[str, str], scratch: Scratch, tie_key: str
                 ) -> DataFrame:
    """Add ``RANK() OVER (ORDER BY value DESC)`` columns, as {output: value column}, to a stored
    frame. Rows are numbered slice by slice, and the rank of a value is the smallest number
    among its ties: no task sorts all rows."""
    result = stored
    for out, value in ranks.items():
        numbered = with_row_ids(
            stored.select(tie_key, value), [F.col(value).desc_nulls_last(), F.col(tie_key)],
            "_number", scratch,
        )
        ranked = numbered.groupBy(F.col(value).alias("_value")).agg(F.min("_number").alias(out))
        result = result.join(ranked, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")
    return result
