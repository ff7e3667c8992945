"""Fact load: key lookup, measures, reject reasons and insert-ignore."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import fit, month_of_key, sale_margin
from starloom.operators.loaded_keys import SALE_KEY
from starloom.schemas import AMOUNT, FACT_SALES

# Order of the running key of facts; it tells all rows of a load apart, as a load takes one
# sale of an order and product.
LOAD_ORDER = ("date_key", "order_id", "product_id")
SALE_COLUMNS = ("staging_id", "order_id", "order_date", "customer_id", "product_id",
                "quantity", "unit_price", "total_amount")
STATUS = ("processed_flag", "error_message")
# What facts are made of, sorted and numbered.
FACT_PARTS = ("date_key", "order_date", "order_id", "product_id", "customer_key", "product_key",
              "quantity", "unit_price", "total_amount", "cost_price")
MEASURES = [name for name in FACT_SALES.fieldNames() if name != "sales_key"]

NO_PRODUCT = "Unknown product"
NO_CUSTOMER = "Unknown customer"
NO_DATE = "Date outside calendar"
NO_VALUE = "Missing value"
LOADED = "Already loaded"
FILTERED = "Before date filter"
# A sale held back for one of these may load in a later run.
RETRIED = (NO_PRODUCT, NO_CUSTOMER, NO_DATE, FILTERED)
# What became of an offered sale, as a number: 0 loaded, or the place of the reason from 1 on.
REASONS = (*RETRIED, NO_VALUE, LOADED)
FATE_SCHEMA = "staging_id long, fate int, load_run long"


def fact_candidates(sales: DataFrame, customers: DataFrame, products: DataFrame,
                    dates: DataFrame, loaded: DataFrame | None = None,
                    first: dt.date | None = None) -> DataFrame:
    """Resolved sales with their measures: one row per sale with fact columns, the staged columns,
    and ``reject_reason`` (NULL for rows to insert)."""
    return with_measures(resolve(sales, customers, products, dates, loaded, first))


def resolve(sales: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame,
            loaded: DataFrame | None = None, first: dt.date | None = None) -> DataFrame:
    """Resolve valid sales against the current dimension versions.

    Returns one row per sale with the staged columns, keys, ``cost_price`` and
    ``reject_reason``, all that :func:`with_measures` needs: rows travel and are stored without
    what follows from them. Lookup sides are narrow and hold one row per key. They are
    left joins with the sales on the left, so AQE may broadcast a small dimension and can
    split a hot customer or product over tasks when the dimension is large. The cost comes
    with the product lookup: the current version carries the newest valid staged price.
    ``loaded`` has the distinct order and product ids of sales loaded before.
    Sales before the date ``first`` are held back for a later run.
    """
    product = products.where("is_current").select("product_id", "product_key", "cost_price")
    customer = customers.where("is_current").select("customer_id", "customer_key")
    calendar = F.broadcast(dates.select(F.col("full_date").alias("order_date"), "date_key"))
    offered = sales.select(*SALE_COLUMNS)
    if loaded is not None:
        # Before the lookups, while the rows are narrow.
        offered = offered.join(loaded.select(*SALE_KEY).withColumn("_hit", F.lit(True)),
                               list(SALE_KEY), "left")
    resolved = (
        offered
        # The cost comes last, so that fewer columns travel to the second lookup.
        .join(customer, "customer_id", "left")
        .join(product, "product_id", "left")
        .join(calendar, "order_date", "left")
    )
    missing = reduce(lambda a, b: a | b, [
        F.col(name).isNull() for name in ("order_id", "quantity", "unit_price", "total_amount")
    ])
    keyless = F.col("order_id").isNull() | F.col("product_id").isNull()
    early = F.lit(False) if first is None else F.col("order_date") < F.lit(first)
    reason = (
        F.when(keyless, NO_VALUE)
        .when(early, FILTERED)
        .when(F.col("product_key").isNull(), NO_PRODUCT)
        .when(F.col("customer_key").isNull(), NO_CUSTOMER)
        .when(F.col("date_key").isNull(), NO_DATE)
        .when(missing, NO_VALUE)
    )
    if loaded is None:
        return resolved.withColumn("reject_reason", reason)
    return resolved.withColumn(
        "reject_reason", F.coalesce(reason, F.when(F.col("_hit"), LOADED))).drop("_hit")


def with_measures(resolved: DataFrame) -> DataFrame:
    """Add the measures of resolved sales, in place of the cost price."""
    cost = F.col("quantity") * F.col("cost_price")
    profit = F.col("total_amount") - cost
    return resolved.withColumns({
        "cost_amount": fit(cost, AMOUNT),
        "profit_amount": fit(profit, AMOUNT),
        "profit_margin": sale_margin(profit, F.col("total_amount")),
        "order_timestamp": F.col("order_date").cast("timestamp"),
    }).drop("cost_price")


def accepted(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("reject_reason").isNull())


def rejected(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("reject_reason").isNotNull())


def retried(candidates: DataFrame) -> DataFrame:
    """Sales to offer again in the next run, in staged form."""
    return candidates.where(F.col("reject_reason").isin(*RETRIED)).select(*SALE_COLUMNS)


def reject_counts(candidates: DataFrame) -> DataFrame:
    return rejected(candidates).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def fates(candidates: DataFrame) -> DataFrame:
    """(staging_id, fate) of every sale that a load was offered."""
    number = F.array_position(F.array(*map(F.lit, REASONS)), F.col("reject_reason"))
    return candidates.select("staging_id", F.coalesce(number, F.lit(0)).cast("int").alias("fate"))


def last_fates(stored: DataFrame) -> DataFrame:
    """(staging_id, load_run, fate) of the last load that each sale was offered to. Both are one
    number, so that map tasks can reduce them in place."""
    size = len(REASONS) + 1
    last = stored.groupBy("staging_id").agg(
        F.max(F.col("load_run") * size + F.col("fate")).alias("_last"))
    return last.select("staging_id", F.floor(F.col("_last") / size).alias("load_run"),
                       (F.col("_last") % size).cast("int").alias("fate"))


def settled(last: DataFrame, latest_run: int) -> DataFrame:
    """Staging ids of the sales that are loaded, rejected for good, or held back by the latest
    load. A sale held back by an earlier one and not offered since is lost."""
    held = F.col("fate").between(1, len(RETRIED))
    return last.where(~held | (F.col("load_run") == latest_run)).select("staging_id")


def with_month(fact: DataFrame) -> DataFrame:
    """Add the partition column of the stored fact table."""
    return fact.withColumn("order_month", month_of_key(F.col("date_key")))
