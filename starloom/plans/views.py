"""The five wide views, and running totals. Views are unsorted relations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions.columns import customer_tier, date_key
from starloom.operators.numbering import spread_ranks
from starloom.plans.reports import (
    MEAN_PERCENT, MONEY, RATIO4, RATIO6,
    by_customers, current_customers, current_products, days, facts_between, mean_amount, money,
    orders, quotient, with_counts,
)
from starloom.schemas import Star
from starloom.session import Scratch

_DATE_PART = ("full_date", "year", "month", "month_name", "quarter", "day_of_week",
              "day_name", "is_weekend")
_CUSTOMER_PART = ("customer_id", "customer_name", "email", "phone", "city", "country",
                  "customer_segment", "registration_date")
_PRODUCT_PART = ("product_id", "product_name", "category", "subcategory", "supplier",
                 "cost_price", "msrp")
_FACT_PART = ("sales_key", "order_id", "order_timestamp", "quantity", "unit_price",
              "total_amount", "cost_amount", "profit_amount", "profit_margin")


def sales_view(star: Star) -> DataFrame:
    """Facts with all their dimension columns, current versions only."""
    products = current_products(
        star, *_PRODUCT_PART, F.col("profit_margin").alias("product_profit_margin")
    )
    return (
        star.fact.select("date_key", "customer_key", "product_key", *_FACT_PART)
        .join(days(star, *_DATE_PART), "date_key")
        .join(current_customers(star, *_CUSTOMER_PART), "customer_key")
        .join(products, "product_key")
        .select(*_FACT_PART, *_DATE_PART, *_CUSTOMER_PART, *_PRODUCT_PART,
                "product_profit_margin")
    )


def daily_aggregates(star: Star, window_rows: int = 7) -> DataFrame:
    """One row per day with a moving average over the last rows present.

    Month-to-date and year-to-date compare a day with the first of its own month and year,
    which always holds: both equal the sales of the day. See :func:`mtd_running` for totals
    that do accumulate. The window runs over calendar days, a fixed small number of rows.
    """
    by_day = ("full_date", "year", "month", "month_name", "day_name", "is_weekend")
    recent = Window.orderBy("full_date").rowsBetween(1 - window_rows, 0)
    day, amount = F.col("full_date"), F.col("total_amount")

    def since(unit: str):
        return F.sum(F.when(day >= F.trunc(day, unit), amount).otherwise(0)).cast(MONEY)

    daily = with_counts(
        star.fact.join(days(star, *by_day), "date_key"), by_day,
        F.sum("quantity").alias("total_quantity"),
        money("total_amount").alias("total_sales"),
        money("cost_amount").alias("total_cost"),
        money("profit_amount").alias("total_profit"),
        F.avg("profit_margin").cast(MEAN_PERCENT).alias("avg_profit_margin"),
        since("MM").alias("mtd_sales"), since("YEAR").alias("ytd_sales"),
    )
    moving = F.avg("total_sales").over(recent).cast(RATIO6)
    return daily.select(
        *by_day, "order_count", "customer_count", "total_quantity", "total_sales", "total_cost",
        "total_profit", "avg_profit_margin", "mtd_sales", "ytd_sales",
        moving.alias("weekly_moving_avg"),
    )


def _running(star: Star, out: str, *period: str) -> DataFrame:
    """Running total of daily sales within a period; at most 366 rows per period."""
    daily = (
        star.fact.join(days(star, "full_date", "year", "month"), "date_key")
        .groupBy("full_date", "year", "month")
        .agg(money("total_amount").alias("daily_sales"))
    )
    so_far = Window.partitionBy(*period).orderBy("full_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = F.sum("daily_sales").over(so_far).cast(MONEY)
    return daily.select("full_date", "daily_sales", total.alias(out))


def mtd_running(star: Star) -> DataFrame:
    return _running(star, "mtd_sales", "year", "month")


def ytd_running(star: Star) -> DataFrame:
    return _running(star, "ytd_sales", "year")


def customer_analysis(star: Star, as_of: dt.date) -> DataFrame:
    """Recency, frequency and value per customer.

    Facts are reduced to one row per customer before the join with the customer dimension.
    """
    who = ("customer_id", "customer_name", "city", "country", "customer_segment",
           "registration_date")
    now = F.lit(as_of)
    per_customer = (
        star.fact.join(days(star, "full_date"), "date_key")
        .groupBy("customer_key")
        .agg(orders().alias("total_orders"), F.sum("quantity").alias("total_quantity"),
             money("total_amount").alias("lifetime_value"),
             mean_amount().alias("avg_order_value"),
             F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"))
    )
    month_days = F.lit("30.44").cast("decimal(4,2)")
    active_days = F.datediff(now, "first_day")
    return per_customer.join(current_customers(star, *who), "customer_key").select(
        "customer_key", *who, "total_orders", "total_quantity", "lifetime_value",
        "avg_order_value",
        F.datediff(now, "last_day").alias("days_since_last_order"),
        quotient(F.col("total_orders") * month_days, active_days, RATIO4)
        .alias("monthly_frequency"),
        customer_tier(F.col("lifetime_value")).alias("customer_tier"),
    )


def product_performance_view(star: Star, scratch: Scratch) -> DataFrame:
    """Product figures with global ranks and totals of their category.

    Facts are reduced to one row per product. That is stored once, ranked slice by slice, and
    category totals are aggregated and joined back, so that neither all products nor those of
    a category meet in one task. The result shows the facts as of the call.
    """
    what = ("product_id", "product_name", "category", "subcategory", "supplier", "cost_price",
            "msrp")
    per_product = star.fact.groupBy("product_key").agg(
        orders().alias("times_ordered"),
        F.sum("quantity").alias("total_quantity_sold"),
        money("total_amount").alias("total_revenue"),
        money("cost_amount").alias("total_cost"),
        money("profit_amount").alias("total_profit"),
        F.avg("profit_margin").cast(MEAN_PERCENT).alias("actual_margin"),
    )
    products = current_products(star, *what, F.col("profit_margin").alias("expected_margin"))
    sold = per_product.join(products, "product_key")
    ranks = {"revenue_rank": "total_revenue", "profit_rank": "total_profit"}
    stored = scratch.keep(sold, "sold_products")
    categories = stored.groupBy(F.col("category").alias("_category")).agg(
        money("total_revenue").alias("category_revenue"),
        F.sum("times_ordered").alias("category_orders"),
    )
    result = spread_ranks(stored, ranks, scratch, "product_key").join(
        categories, F.col("category").eqNullSafe(F.col("_category"))
    )
    inventory = (F.col("total_quantity_sold") * F.col("cost_price")).cast(MONEY)
    return result.select(
        "product_key", *what, "expected_margin", "times_ordered", "total_quantity_sold",
        "total_revenue", "total_cost", "total_profit", "actual_margin",
        inventory.alias("inventory_cost"), "revenue_rank", "profit_rank", "category_revenue",
        "category_orders",
    )


def geographic_analysis(star: Star, as_of: dt.date) -> DataFrame:
    place = ("country", "city")

    customers = current_customers(star, *place)
    found = by_customers(
        star.fact, customers, place, F.sum("quantity").alias("total_quantity"),
        money("amount").alias("total_sales"), money("profit").alias("total_profit"),
    )

    def since(number: int) -> Column:
        key = date_key(F.date_sub(F.lit(as_of), number))
        return F.sum(F.when(F.col("date_key") >= key, F.col("total_amount")).otherwise(0)
                     ).cast(MONEY)

    # A scan pruned to the last 90 days; places without sales in them have 0.
    last = facts_between(star, as_of - dt.timedelta(days=90), None).groupBy("customer_key").agg(
        since(30).alias("last_30"), since(90).alias("last_90"))
    late = last.join(customers, "customer_key").groupBy(*[F.col(n).alias(f"_of_{n}")
                                                          for n in place]).agg(
        money("last_30").alias("last_30_days_sales"),
        money("last_90").alias("last_90_days_sales"))
    same = (F.col("country").eqNullSafe(F.col("_of_country"))
            & F.col("city").eqNullSafe(F.col("_of_city")))
    buyer_count = F.col("customer_count")
    zero = F.lit(0).cast(MONEY)
    return found.join(late, same, "left").select(
        *place, "customer_count", "order_count", "total_quantity", "total_sales",
        "total_profit",
        quotient(F.col("total_sales"), buyer_count, RATIO6).alias("sales_per_customer"),
        quotient(F.col("total_quantity"), buyer_count, RATIO4).alias("quantity_per_customer"),
        F.coalesce("last_30_days_sales", zero).alias("last_30_days_sales"),
        F.coalesce("last_90_days_sales", zero).alias("last_90_days_sales"),
    )


def register_views(spark: SparkSession, star: Star, as_of: dt.date, scratch: Scratch) -> None:
    """Publish the views, and the star itself, as temporary views for SQL users. Ranks of
    ``product_performance`` are stored when it is published; the others are computed on use."""
    frames = {
        "fact_sales": star.fact, "dim_customer": star.customer,
        "dim_product": star.product, "dim_date": star.date,
        "sales_view": sales_view(star), "daily_aggregates": daily_aggregates(star),
        "customer_analysis": customer_analysis(star, as_of),
        "product_performance": product_performance_view(star, scratch),
        "geographic_analysis": geographic_analysis(star, as_of),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
