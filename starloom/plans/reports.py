"""Reports over the star schema.

Each report is a declarative plan over :class:`Star`. The calendar is broadcast, its size
being fixed by the date range. Customer and product sides carry no hint: they are broadcast
only when Spark measures them as small. Where the measures allow it, facts are reduced to
one row per dimension key before the join, so that no hot key reaches it. Every LIMIT is
part of the report and has tie-breaking sort columns.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import month_of_key, ratio
from starloom.schemas import Star

MONEY = "decimal(22,2)"
MEAN_MONEY = "decimal(16,6)"
MEAN_PERCENT = "decimal(9,6)"
RATIO4 = "decimal(22,4)"
RATIO6 = "decimal(24,6)"
PERCENT2 = "decimal(18,2)"


def money(name: str) -> Column:
    return F.sum(name).cast(MONEY)


def mean_amount() -> Column:
    return F.avg("total_amount").cast(MEAN_MONEY)


def quotient(top: Column, bottom: Column, kind: str) -> Column:
    """Exact decimal quotient, rounded half up to the scale of ``kind``; NULL for 0 below."""
    wide = "decimal(24,6)"
    return ratio(top.cast(wide), bottom.cast("decimal(12,0)")).cast(kind)


def percent(top: Column, bottom: Column) -> Column:
    return F.round(ratio(top.cast(MONEY), bottom.cast(MONEY)) * 100, 2).cast(PERCENT2)


def orders() -> Column:
    return F.count_distinct("order_id")


def buyers() -> Column:
    return F.count_distinct("customer_key")


def with_counts(rows: DataFrame, by: tuple[str, ...], *measures: Column) -> DataFrame:
    """Groups with their measures, ``order_count`` and ``customer_count``.

    Each aggregate holds one distinct count, which Spark rolls up from finer groups, map-side
    first. Two in one aggregate would copy every row once per distinct column. The two results,
    one row per group, are put together.
    """
    found = rows.groupBy(*by).agg(*measures, orders().alias("order_count"))
    return beside(found, rows.groupBy(*by).agg(buyers().alias("customer_count")), by)


def beside(left: DataFrame, right: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Columns of two frames with the same groups, NULL being a group as well."""
    named = right.withColumnsRenamed({name: f"_of_{name}" for name in by})
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in by])
    return left.join(named, same).drop(*[f"_of_{name}" for name in by])


def by_customers(fact: DataFrame, customers: DataFrame, by: tuple[str, ...],
                 *measures: Column) -> DataFrame:
    """Groups of customers with ``customer_count``, ``order_count`` and further measures.

    ``measures`` add up per-customer parts: amount, profit, quantity and lines. Facts shrink
    to one row per customer, or per customer and order, before they meet the customers, so
    customers are counted without a distinct and no hot customer reaches the join.
    """
    parts = fact.groupBy("customer_key").agg(
        money("total_amount").alias("amount"), money("profit_amount").alias("profit"),
        F.sum("quantity").alias("quantity"), F.count("total_amount").alias("lines"))
    found = parts.join(customers, "customer_key").groupBy(*by).agg(
        *measures, F.count(F.lit(1)).alias("customer_count"))
    sold = fact.select("customer_key", "order_id").distinct().join(customers, "customer_key")
    return beside(found, sold.groupBy(*by).agg(orders().alias("order_count")), by)


def mean_part() -> Column:
    """Mean amount of a sale, from per-customer parts."""
    return quotient(F.sum("amount"), F.sum("lines"), MEAN_MONEY)


def days(star: Star, *columns: str) -> DataFrame:
    """Calendar columns for a join on date_key; safe to broadcast."""
    return F.broadcast(star.date.select("date_key", *columns))


def current_customers(star: Star, *columns: str) -> DataFrame:
    return star.customer.where("is_current").select("customer_key", *columns)


def current_products(star: Star, *columns: str) -> DataFrame:
    return star.product.where("is_current").select("product_key", *columns)


def facts_between(star: Star, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Facts of a closed date range, pruned by month partition and by date key."""
    fact = star.fact
    for bound, keep in ((first, lambda c, v: c >= v), (last, lambda c, v: c <= v)):
        if bound is not None:
            key = bound.year * 10000 + bound.month * 100 + bound.day
            fact = fact.where(keep(F.col("date_key"), key))
            if "order_month" in fact.columns:
                fact = fact.where(keep(F.col("order_month"), key // 100))
    return fact


def product_totals(fact: DataFrame) -> DataFrame:
    """One row per product key, with the parts of all additive product measures."""
    return fact.groupBy("product_key").agg(
        F.sum("quantity").alias("quantity"),
        money("total_amount").alias("revenue"),
        money("cost_amount").alias("cost"),
        money("profit_amount").alias("profit"),
        F.sum("profit_margin").cast(MONEY).alias("margin_sum"),
        F.count("profit_margin").alias("margin_count"),
    )


def _mean_margin() -> Column:
    return quotient(F.sum("margin_sum"), F.sum("margin_count"), MEAN_PERCENT)


def daily_sales(star: Star, limit: int = 30) -> DataFrame:
    """The last days with sales. Their first date key is found in a scan of that column alone,
    and prunes the month partitions of the scan that aggregates."""
    recent = star.fact.select("date_key").distinct().orderBy(F.desc("date_key")).limit(limit)
    first = recent.agg(F.min("date_key").alias("first"))
    fact = star.fact.where(F.col("date_key") >= first.scalar())
    if "order_month" in fact.columns:
        month = first.select(month_of_key(F.col("first")))
        fact = fact.where(F.col("order_month") >= month.scalar())
    daily = with_counts(fact, ("date_key",), money("total_amount").alias("daily_sales"),
                        F.sum("quantity").alias("total_quantity"))
    return (
        daily.join(days(star, "full_date", "day_name"), "date_key")
        .select("full_date", "day_name", "daily_sales", "total_quantity", "order_count",
                "customer_count")
        .orderBy(F.desc("full_date")).limit(limit)
    )


def top_customers(star: Star, limit: int = 10) -> DataFrame:
    who = ("customer_name", "city", "country")
    return (
        star.fact.join(current_customers(star, *who), "customer_key")
        .groupBy(*who)
        .agg(money("total_amount").alias("total_spent"), orders().alias("order_count"),
             mean_amount().alias("avg_order_value"))
        .orderBy(F.desc("total_spent"), *who).limit(limit)
    )


def product_performance(star: Star, limit: int = 20) -> DataFrame:
    what = ("product_name", "category", "subcategory")
    return (
        product_totals(star.fact).join(current_products(star, *what), "product_key")
        .groupBy(*what)
        .agg(F.sum("quantity").alias("total_quantity"), money("revenue").alias("revenue"),
             money("cost").alias("cost"), money("profit").alias("profit"),
             _mean_margin().alias("avg_margin"))
        .orderBy(F.desc("profit"), *what).limit(limit)
    )


def _monthly(star: Star) -> DataFrame:
    return with_counts(
        star.fact.join(days(star, "year", "month", "month_name"), "date_key"),
        ("year", "month", "month_name"), money("total_amount").alias("monthly_sales"),
        money("profit_amount").alias("monthly_profit"),
    )


def monthly_trend(star: Star) -> DataFrame:
    return _monthly(star).orderBy(F.desc("year"), F.desc("month"))


def monthly_performance(star: Star) -> DataFrame:
    """Monthly figures in calendar order, with a printable month label."""
    label = F.concat_ws(" ", "month_name", F.col("year").cast("string"))
    return _monthly(star).withColumn("month_year", label).orderBy("year", "month")


def segment_analysis(star: Star) -> DataFrame:
    by = ("customer_segment",)
    found = by_customers(star.fact, current_customers(star, *by), by,
                         money("amount").alias("segment_revenue"),
                         mean_part().alias("avg_customer_value"))
    per_customer = quotient(F.col("order_count"), F.col("customer_count"), RATIO4)
    return (
        found.select(*by, "customer_count", "segment_revenue", "avg_customer_value",
                     per_customer.alias("avg_orders_per_customer"))
        .orderBy(F.desc("segment_revenue"), "customer_segment")
    )


def hourly_pattern(rows: DataFrame, time: str = "order_timestamp", item: str = "order_id",
                   amount: str = "total_amount") -> DataFrame:
    """Activity by hour of day, for facts or any rows with a time, an id and an amount."""
    return (
        rows.where(F.col(time).isNotNull())
        .groupBy(F.hour(time).alias("hour_of_day"))
        .agg(F.count_distinct(item).alias("order_count"),
             money(amount).alias("hourly_sales"),
             F.avg(amount).cast(MEAN_MONEY).alias("avg_order_value"))
        .orderBy("hour_of_day")
    )


def yoy_growth(star: Star, as_of: dt.date) -> DataFrame:
    """Sales by month of the year of ``as_of`` against the year before.

    Both years come from one scan, pruned to two years of partitions. Months without sales
    in the current year drop out, as in a left join from the current year.
    """
    this_year = as_of.year
    now, before = F.col("year") == this_year, F.col("year") == this_year - 1
    fact = facts_between(star, dt.date(this_year - 1, 1, 1), dt.date(this_year, 12, 31))
    by_month = (
        fact.join(days(star, "year", "month", "month_name"), "date_key")
        .groupBy("month", "month_name")
        .agg(F.sum(F.when(now, F.col("total_amount"))).cast(MONEY).alias("monthly_sales"),
             F.sum(F.when(before, F.col("total_amount"))).cast(MONEY).alias("prev_year_sales"),
             F.count_if(now).alias("lines"))
        .where("lines > 0")
    )
    growth = percent(F.col("monthly_sales") - F.col("prev_year_sales"), F.col("prev_year_sales"))
    return by_month.select(
        F.lit(this_year).alias("year"), "month", "month_name", "monthly_sales",
        "prev_year_sales", growth.alias("yoy_growth_percent"),
    ).orderBy(F.desc("year"), F.desc("month"))


def category_performance(star: Star) -> DataFrame:
    """Ranking of categories. After reduction a product is one row, so counting products
    needs no distinct."""
    return (
        product_totals(star.fact).join(current_products(star, "category"), "product_key")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("product_count"),
             F.sum("quantity").alias("total_quantity"),
             money("revenue").alias("category_revenue"),
             money("profit").alias("category_profit"),
             percent(F.sum("profit"), F.sum("revenue")).alias("category_margin"))
        .orderBy(F.desc("category_profit"), "category")
    )


def retention(star: Star) -> DataFrame:
    """Customers by registration year, and how many ordered in that year or later."""
    last = star.fact.groupBy("customer_key").agg(
        F.year(F.max("order_timestamp")).alias("last_order_year")
    )
    stayed = F.when(F.col("last_order_year") >= F.col("registration_year"), 1).otherwise(0)
    return (
        current_customers(star, F.year("registration_date").alias("registration_year"))
        .join(last, "customer_key", "left")
        .groupBy("registration_year")
        .agg(F.count("customer_key").alias("total_customers"),
             F.sum(stayed).alias("retained_customers"),
             percent(F.sum(stayed), F.count("customer_key")).alias("retention_rate"))
        .orderBy(F.desc("registration_year"))
    )


def sales_by_geography(star: Star) -> DataFrame:
    by = ("country", "city")
    found = by_customers(star.fact, current_customers(star, *by), by,
                         money("amount").alias("regional_sales"),
                         mean_part().alias("avg_order_value"))
    return (
        found.select(*by, "customer_count", "regional_sales", "order_count", "avg_order_value")
        .orderBy(F.desc("regional_sales"), "country", "city")
    )
