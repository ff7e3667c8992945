"""Data behind the dashboard: key figures, trends, top lists, filters and export.

Unlike the reports, product and customer figures here cover every dimension version.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.reports import (
    MEAN_PERCENT, MONEY, by_customers, days, facts_between, mean_part, money, orders,
    product_totals, quotient,
)
from starloom.schemas import Star


def kpi_summary(star: Star) -> DataFrame:
    return star.fact.agg(
        money("total_amount").alias("total_sales"),
        money("profit_amount").alias("total_profit"),
        F.sum("quantity").alias("total_quantity"),
        orders().alias("order_count"),
        F.avg("profit_margin").cast(MEAN_PERCENT).alias("avg_margin"),
    )


def kpi_export(star: Star) -> DataFrame:
    """The key figures as (Metric, Value) rows, ready for a CSV file."""
    # Metric labels, in report order.
    labels = {
        "total_sales": "Total Sales", "total_profit": "Total Profit",
        "total_quantity": "Quantity Sold", "order_count": "Total Orders",
        "avg_margin": "Avg Margin",
    }
    texts = kpi_summary(star).select(
        *[F.col(name).cast("string").alias(label) for name, label in labels.items()]
    )
    return texts.unpivot([], list(labels.values()), "Metric", "Value")


def write_csv(df: DataFrame, path: str) -> None:
    """Write a small report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def daily_trend(star: Star, first: dt.date | None = None,
                last: dt.date | None = None) -> DataFrame:
    """Sales by day, optionally for a closed date range."""
    by_day = ("full_date", "day_name", "month_name", "year")
    return (
        facts_between(star, first, last).join(days(star, *by_day), "date_key")
        .groupBy(*by_day)
        .agg(money("total_amount").alias("daily_sales"),
             money("profit_amount").alias("daily_profit"),
             F.sum("quantity").alias("daily_quantity"),
             orders().alias("daily_orders"))
        .orderBy("full_date")
    )


def top_products(star: Star, limit: int = 20, category: str | None = None) -> DataFrame:
    """Products by revenue, optionally of one category."""
    products = star.product.select("product_key", "product_name", "category")
    if category is not None:
        products = products.where(F.col("category") == category)
    return (
        product_totals(star.fact).join(products, "product_key")
        .groupBy("product_name", "category")
        .agg(F.sum("quantity").alias("total_quantity"), money("revenue").alias("revenue"),
             money("profit").alias("profit"),
             quotient(F.sum("margin_sum"), F.sum("margin_count"), MEAN_PERCENT)
             .alias("avg_margin"))
        .orderBy(F.desc("revenue"), "product_name", "category").limit(limit)
    )


def product_categories(star: Star) -> DataFrame:
    """Choices of the category filter."""
    return star.product.select("category").distinct().orderBy("category")


def customers_by_place(star: Star) -> DataFrame:
    where = ("city", "country", "customer_segment")
    found = by_customers(star.fact, star.customer.select("customer_key", *where), where,
                         money("amount").alias("total_sales"),
                         mean_part().alias("avg_order_value"))
    return found.select(*where, "customer_count", "total_sales", "order_count",
                        "avg_order_value")


def segment_sales(star: Star) -> DataFrame:
    """Sales by segment. Only sums are wanted, so facts shrink to customers first."""
    per_customer = star.fact.groupBy("customer_key").agg(money("total_amount").alias("amount"))
    segments = star.customer.select("customer_key", "customer_segment")
    return (
        per_customer.join(segments, "customer_key")
        .groupBy("customer_segment").agg(F.sum("amount").cast(MONEY).alias("total_sales"))
    )
