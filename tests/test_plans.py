"""Properties of physical plans that decide how queries behave at scale."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.sample import sample
from starloom.operators import facts
from starloom.plans import dashboard, reports, views
from starloom.sources.calendar import date_dimension


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan as executed; collecting fixes it."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def star(spark, tables):
    return sample(spark, tables).star


@pytest.fixture
def unhinted(spark):
    """No join side counts as small: large dimensions, in effect."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
             "spark.sql.shuffle.partitions": "8"}
    old = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_date_filter_prunes_partitions_and_columns(star):
    text = plan(dashboard.daily_trend(star, dt.date(1997, 3, 1), dt.date(1998, 2, 28)))
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*order_month#\d+ >= 199703", scan)
    assert "GreaterThanOrEqual(date_key,19970301)" in scan
    schema = scan.split("ReadSchema: ")[1]
    assert "unit_price" not in schema and "customer_key" not in schema


def test_growth_reads_two_years_once(star):
    text = plan(reports.yoy_growth(star, dt.date(2001, 6, 30)))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1 and "order_month" in scans[0].split("PartitionFilters: ")[1]


def test_top_lists_do_not_sort_everything(star):
    for report in (reports.daily_sales, reports.top_customers, reports.product_performance):
        assert "TakeOrderedAndProject" in plan(report(star))


def test_products_are_reduced_before_the_join(star, unhinted):
    text = final_plan(reports.product_performance(star))
    below = text[text.index("SortMergeJoin"):]
    assert "HashAggregate(keys=[product_key" in below and "partial_sum" in below


def test_spread_ranks_have_no_global_window(star, scratch):
    assert "Window" not in plan(views.product_performance_view(star, scratch))


def test_wide_rows_are_not_aggregated_to_find_the_latest(spark, tables, star):
    text = plan(queries.registered()["clean_sales"](spark, tables))
    assert "SortAggregate" not in text and "LeftAnti" in text


def test_no_row_is_copied_for_a_second_distinct_count(star):
    day = dt.date(2001, 6, 30)
    for report in (reports.daily_sales(star), reports.monthly_trend(star),
                   reports.segment_analysis(star), reports.sales_by_geography(star),
                   views.daily_aggregates(star), views.geographic_analysis(star, day),
                   dashboard.customers_by_place(star)):
        assert "Expand" not in plan(report)


def test_the_last_days_prune_months(star):
    text = plan(reports.daily_sales(star))
    assert re.search(r"PartitionFilters: \[[^\]]*order_month#\d+ >= [^\]]*[Ss]ubquery", text)


def test_a_hot_customer_is_split_over_tasks(spark, unhinted):
    """A third of the sales belong to one customer; the lookup join splits them."""
    count = 60000
    sales = spark.range(0, count, 1, 6).select(
        F.col("id").alias("staging_id"), F.concat(F.lit("O"), "id").alias("order_id"),
        F.lit(dt.date(2024, 1, 5)).alias("order_date"),
        F.when(F.col("id") % 3 == 0, "C0").otherwise(F.concat(F.lit("C"), F.col("id") % 500))
        .alias("customer_id"),
        F.lit("P1").alias("product_id"), F.lit(1).alias("quantity"),
        F.lit("2.00").cast("decimal(10,2)").alias("unit_price"),
        F.lit("2.00").cast("decimal(12,2)").alias("total_amount"))
    customers = spark.range(500).select(
        F.concat(F.lit("C"), "id").alias("customer_id"), F.col("id").alias("customer_key"),
        F.lit(True).alias("is_current"))
    products = spark.createDataFrame([("P1", 1, True)],
                                     "product_id string, product_key long, is_current boolean")
    products = products.withColumn("cost_price", F.lit("1.00").cast("decimal(10,2)"))
    dates = date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    found = facts.fact_candidates(sales, customers, products, dates)
    total = found.groupBy("customer_key").agg(F.count(F.lit(1)).alias("n"))
    rows = total.collect()
    assert sum(r.n for r in rows) == count and all(r.customer_key is not None for r in rows)
    assert max(r.n for r in rows) >= count // 3
    assert "SortMergeJoin(skew=true)" in plan(total).split("== Initial Plan ==")[0]
