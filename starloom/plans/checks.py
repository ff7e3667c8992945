"""Checks on a loaded warehouse: headline metrics and invariants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.dedup import KEY, latest_valid_sales
from starloom.operators.facts import settled
from starloom.plans.reports import MONEY, money, orders
from starloom.schemas import Star
from starloom.session import Scratch


def validation(star: Star) -> DataFrame:
    """Headline metrics as (label, value) rows; every table is scanned once."""
    def rows(summary: DataFrame) -> DataFrame:
        texts = summary.select(*[F.col(n).cast("string").alias(n) for n in summary.columns])
        return texts.unpivot([], texts.columns, "label", "value")

    count = F.count(F.lit(1))
    parts = [
        star.customer.where("is_current").agg(count.alias("Total Customers")),
        star.product.where("is_current").agg(count.alias("Total Products")),
        star.fact.agg(count.alias("Total Sales Records"),
                      money("total_amount").alias("Total Sales Amount"),
                      orders().alias("Unique Orders")),
        star.date.agg(F.min("full_date").alias("Date Range Start"),
                      F.max("full_date").alias("Date Range End")),
    ]
    return reduce(DataFrame.unionByName, [rows(part) for part in parts])


def _one(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.agg(F.coalesce(value, F.lit(0)).cast(MONEY).alias("n")).select(
        F.lit(name).alias("check"), "n"
    )


def balances(sales: DataFrame, last_fates: DataFrame, latest_run: int,
             scratch: Scratch | None = None) -> DataFrame:
    """Violations of the two balances of staged sales: every row is valid, invalid or removed as
    a duplicate; every valid one is loaded, rejected for good, or held back by the latest load."""
    valid = F.col("processed_flag") & F.col("error_message").isNull()
    keyless = F.col("order_id").isNull() | F.col("product_id").isNull()
    keyed = sales.where(~keyless).groupBy(*KEY).agg(
        F.count_if(valid).alias("valid"), F.max(F.when(valid, F.col("staging_id"))).alias("good"),
        F.max("staging_id").alias("last"))
    survivors = latest_valid_sales(sales, scratch)
    total = F.sum("n")
    counted = reduce(DataFrame.unionByName, [
        sales.select(F.when(valid, 1).otherwise(0).alias("n")),
        keyed.select((F.when(F.col("good") == F.col("last"), 1).otherwise(0)
                      - F.col("valid")).cast("int").alias("n")),
        survivors.select(F.lit(-1).alias("n")),
    ])
    lost = survivors.select("staging_id").join(
        settled(last_fates, latest_run), "staging_id", "left_anti")
    return _one(counted, "staged sales neither valid, invalid nor removed",
                F.abs(total)).unionByName(
        _one(lost, "valid sales neither loaded nor rejected", F.count(F.lit(1))))


def fact_balance(fact: DataFrame, fates: DataFrame) -> DataFrame:
    """Difference between facts and sales taken, load by load."""
    both = fact.select("load_run", F.lit(1).alias("n")).unionByName(
        fates.where("fate = 0").select("load_run", F.lit(-1).alias("n")))
    runs = both.groupBy("load_run").agg(F.sum("n").alias("n"))
    return _one(runs, "facts differ from sales taken", F.sum(F.abs("n")))


def invariants(star: Star, agg: DataFrame) -> DataFrame:
    """Violations per invariant; a sound warehouse has 0 in every row."""
    grain = (F.when(F.col("customer_key").isNotNull(), "customer")
             .when(F.col("product_key").isNotNull(), "product").otherwise("day"))
    sums = star.fact.select(F.lit("fact").alias("grain"), "total_amount").unionByName(
        agg.select(grain.alias("grain"), "total_amount")
    ).agg(*[F.coalesce(F.sum(F.when(F.col("grain") == name, F.col("total_amount"))), F.lit(0))
            .cast(MONEY).alias(name) for name in ("fact", "day", "customer", "product")])
    parts = [sums.select(*[
        F.abs(F.col(name) - F.col("fact")).cast(MONEY)
        .alias(f"amount of {name} grain differs from facts")
        for name in ("day", "customer", "product")
    ])]
    parts = [part.unpivot([], part.columns, "check", "n") for part in parts]
    for name, dim, key in (("customer", star.customer, "customer_id"),
                           ("product", star.product, "product_id")):
        current = dim.groupBy(key).agg(F.count_if("is_current").alias("n"))
        parts.append(_one(current, f"{name} without exactly one current version",
                          F.count_if(F.col("n") != 1)))
    repeated = star.fact.select("order_id", "product_key").join(
        star.product.select("product_key", "product_id"), "product_key"
    ).groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    parts.append(_one(repeated, "fact key repeated", F.count_if(F.col("n") > 1)))
    for name, dim, key in (("customer", star.customer, "customer_key"),
                           ("product", star.product, "product_key"),
                           ("date", star.date, "date_key")):
        keys = star.fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(_one(keys.join(dim.select(key), key, "left_anti"),
                          f"facts without {name}", F.sum("n")))
    return reduce(DataFrame.unionByName, parts)
