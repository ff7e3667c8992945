"""Versioned dimensions (slowly changing, type 2)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.functions.columns import product_margin
from starloom.operators.dedup import latest_by_key
from starloom.operators.numbering import with_row_ids
from starloom.operators.quality import valid_rows, with_segment
from starloom.session import Scratch


@dataclass(frozen=True)
class Dimension:
    """How a dimension is versioned: ``derived`` follows the tracked columns, ``frozen``
    keeps the value a version was opened with."""

    schema: T.StructType
    surrogate: str
    natural: str
    tracked: tuple[str, ...]
    derived: tuple[str, ...]
    frozen: tuple[str, ...]

    @property
    def attributes(self) -> list[str]:
        taken = {*self.tracked, *self.derived, *self.frozen}
        return [name for name in self.schema.fieldNames() if name in taken]


CUSTOMER = Dimension(S.DIM_CUSTOMER, "customer_key", "customer_id", S.CUSTOMER_TRACKED,
                     ("customer_segment",), ("registration_date",))
PRODUCT = Dimension(S.DIM_PRODUCT, "product_key", "product_id", S.PRODUCT_TRACKED,
                    ("profit_margin",), ())


def customer_rows(staged: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    """Valid staged customers with their segment."""
    return with_segment(valid_rows(staged), rules)


def product_rows(staged: DataFrame) -> DataFrame:
    """Valid staged products with their margin."""
    return valid_rows(staged).withColumn(
        "profit_margin", product_margin(F.col("cost_price"), F.col("msrp"))
    )


def distinct_rows(rows: DataFrame, dimension: Dimension) -> DataFrame:
    """Distinct attribute rows, the input of a dimension load."""
    return rows.select(dimension.natural, *dimension.attributes).dropDuplicates()


def newest_rows(rows: DataFrame, dimension: Dimension) -> DataFrame:
    """The last row of each key, with the attributes of the dimension."""
    return latest_by_key(
        rows.where(F.col(dimension.natural).isNotNull())
        .select(dimension.natural, "staging_id", *dimension.attributes),
        (dimension.natural,),
    )


def first_versions(rows: DataFrame, dimension: Dimension, as_of: dt.date, scratch: Scratch
                   ) -> DataFrame:
    """The dimension that a first batch makes."""
    natural = dimension.natural
    opened = newest_rows(rows, dimension).select(
        natural, *dimension.attributes, F.lit(as_of).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"),
    )
    return with_row_ids(opened, [F.col(natural)], dimension.surrogate, scratch).select(
        *dimension.schema.fieldNames())


def scd2_changes(current: DataFrame, rows: DataFrame, dimension: Dimension, as_of: dt.date,
                 last_key: int, scratch: Scratch) -> DataFrame:
    """What a batch changes as of a date: versions that it opens, overwrites or closes, stored.

    * unknown key: a first version opens at ``as_of``;
    * current version opened at ``as_of``: its attributes are overwritten;
    * a tracked column differs (NULL counts as a value): the version closes the day
      before and a new one opens;
    * current version opened after ``as_of``: unchanged, a late batch rewrites no newer one;
    * everything else, and keys absent from ``rows``: unchanged.

    ``current`` needs to hold the current versions of the batch's keys only. Both join sides
    hold one row per key, so no key can be hot. New keys count up from ``last_key``.
    """
    natural, surrogate = dimension.natural, dimension.surrogate
    names = dimension.schema.fieldNames()
    old, new = F.col("old"), F.col("new")
    pairs = newest_rows(rows, dimension).select(F.struct("*").alias("new")).join(
        current.select(F.struct(*names).alias("old")), old[natural] == new[natural], "left")

    def differs(columns) -> Column:
        return reduce(Column.__or__, [~old[name].eqNullSafe(new[name]) for name in columns],
                      F.lit(False))

    written = [*dimension.tracked, *dimension.derived]
    close = old.isNotNull() & (old["valid_from"] < F.lit(as_of)) & differs(dimension.tracked)
    overwrite = old.isNotNull() & (old["valid_from"] == F.lit(as_of)) & differs(written)

    def kept(name: str) -> Column:
        if name in written:
            return F.when(overwrite, new[name]).otherwise(old[name])
        if name == "valid_to":
            return F.when(close, F.date_sub(F.lit(as_of), 1)).otherwise(old[name])
        return ~close if name == "is_current" else old[name]

    def opened(name: str) -> Column:
        fixed = {surrogate: F.lit(None).cast("long"), "valid_from": F.lit(as_of),
                 "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}
        return fixed[name] if name in fixed else new[name]

    versions = F.array_compact(F.array(
        F.when(overwrite | close, F.struct(*[kept(n).alias(n) for n in names])),
        F.when(old.isNull() | close, F.struct(*[opened(n).alias(n) for n in names])),
    ))
    made = scratch.keep(pairs.select(F.inline(versions)), f"versions_{surrogate}")
    fresh = with_row_ids(made.where(F.col(surrogate).isNull()).drop(surrogate),
                         [F.col(natural)], surrogate, scratch, last_key)
    changes = made.where(F.col(surrogate).isNotNull()).unionByName(fresh.select(*names))
    return scratch.keep(changes, f"changes_{surrogate}")


def with_changes(current: DataFrame, changes: DataFrame, dimension: Dimension) -> DataFrame:
    """Current versions after the changes."""
    touched = changes.select(dimension.natural).distinct()
    return current.join(touched, dimension.natural, "left_anti").select(
        *dimension.schema.fieldNames()).unionByName(changes.where("is_current"))


def scd2_merge(dim: DataFrame | None, rows: DataFrame, dimension: Dimension, as_of: dt.date,
               scratch: Scratch) -> DataFrame:
    """The whole dimension after staged ``rows`` are merged into it as of a date. Stored keys
    never change."""
    if dim is None:
        return first_versions(rows, dimension, as_of, scratch)
    current = dim.where("is_current")
    last = dim.agg(F.max(dimension.surrogate)).first()[0] or 0
    changes = scd2_changes(current, rows, dimension, as_of, last, scratch)
    return (
        dim.where(~F.col("is_current"))
        .unionByName(changes.where(~F.col("is_current")))
        .unionByName(with_changes(current, changes, dimension))
    )


def bucket(dimension: Dimension, buckets: int) -> Column:
    """The part of the stored current versions that holds a key."""
    return F.pmod(F.xxhash64(dimension.natural), F.lit(buckets)).cast("int")
