"""Every registered query: name -> function of (session, folder of the given tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sample import SECOND_DAY, Sample, sample
from starloom import schemas as S
from starloom.operators import aggregates, dedup, dimensions, facts, quality
from starloom.plans import checks, dashboard, reports, views
from starloom.plans.pipeline import CUSTOMERS, LOAD_FACTS, PRODUCTS, SALES
from starloom.sources import csv_files, ledger, quoted_csv
from starloom.sources.calendar import date_dimension

FIRST_LOAD_END = dt.date(1999, 1, 1)
LATE_CUSTOMERS = dt.date(1997, 1, 1)
FILTER_FIRST, FILTER_LAST = dt.date(1997, 3, 1), dt.date(1998, 2, 28)
FILTER_CATEGORY = "ECONOMY"

_QUERIES: dict[str, Callable[[Sample], DataFrame]] = {}


def query(function: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
    _QUERIES[function.__name__] = function
    return function


# -- staging ---------------------------------------------------------------------------

@query
def stage_sales(s):
    return s.raw_sales


@query
def stage_customers(s):
    return s.raw_customers


@query
def stage_products(s):
    return s.raw_products


def _through_files(s, kind, raw: DataFrame) -> DataFrame:
    """Rows written as source files and read as an extract reads them, names included."""
    columns = kind.file_schema.fieldNames()
    folder = s.scratch.path(f"{kind.name}_files")
    csv_files.write_rows(raw.select(*columns), folder)
    return csv_files.read_rows(s.spark, [folder], kind.file_schema).where(
        F.col(csv_files.CORRUPT).isNull()).select(*columns)


@query
def extract_sales(s):
    return _through_files(s, SALES, s.raw_sales)


@query
def extract_customers(s):
    """Names carry quotes, commas and blanks at both ends."""
    quoted = F.concat(F.lit(' "'), "customer_name", F.lit('", '))
    return _through_files(s, CUSTOMERS, s.raw_customers.withColumn("customer_name", quoted))


@query
def extract_customer_lines(s):
    """Names hold line breaks and quotes; the files are still read in splits."""
    broken = F.concat("customer_name", F.lit('\n"'), "city", F.lit('"\n'))
    raw = s.raw_customers.withColumn("customer_name", broken)
    columns = CUSTOMERS.file_schema.fieldNames()
    folder = s.scratch.path("customer_lines")
    csv_files.write_rows(raw.select(*columns), folder)
    rows = quoted_csv.read_records(s.spark, [folder], CUSTOMERS.file_schema, s.scratch)
    return rows.where(F.col(csv_files.CORRUPT).isNull()).select(*columns)


@query
def extract_products(s):
    return _through_files(s, PRODUCTS, s.raw_products)


def _sales_ledger(files: DataFrame) -> DataFrame:
    """Ledger rows for the monthly files: older ones done, the next quarter failed."""
    month = F.substring("file_name", 7, 6)
    status = F.when(month < "199901", ledger.COMPLETED).when(month <= "199903", ledger.FAILED)
    return files.select(
        F.lit("EXTRACT_SALES").alias("process_name"), F.col("file_name").alias("source_file"),
        status.alias("status"),
    ).where("status IS NOT NULL")


@query
def pending_files(s):
    files = s.raw_sales.select("file_name").distinct()
    return ledger.pending_files(files, _sales_ledger(files), "EXTRACT_SALES")


@query
def ledger_status(s):
    events = s.spark.read.parquet(f"{s.folder}/events.parquet").select(
        F.col("user_id").alias("process_id"), F.col("event_type").alias("status"),
        F.col("ts").cast("timestamp").alias("event_time"), "event_id",
    )
    return ledger.latest_events(events, "process_id", ["event_time", "event_id"])


# -- cleaning --------------------------------------------------------------------------

@query
def validate_sales(s):
    judged = quality.validate_sales(s.raw_sales, s.rules)
    return judged.select("staging_id", "order_id", "product_id", "processed_flag",
                         "error_message")


@query
def dedup_sales(s):
    return dedup.dedup_sales(s.sales).select("staging_id", "order_id", "product_id",
                                             "processed_flag", "error_message")


@query
def clean_sales(s):
    judged = quality.validate_sales(s.raw_sales, s.rules)
    survivors = dedup.latest_valid_sales(judged.select(*facts.SALE_COLUMNS, *facts.STATUS))
    return survivors.select(*facts.SALE_COLUMNS)


@query
def clean_customers(s):
    return quality.clean_customers(s.raw_customers, s.rules).drop("load_timestamp")


@query
def validate_customers(s):
    judged = quality.clean_customers(s.raw_customers, s.rules)
    return judged.select("staging_id", "customer_id", "processed_flag", "error_message")


@query
def clean_products(s):
    return quality.clean_products(s.raw_products, s.rules).drop("load_timestamp")


@query
def validate_products(s):
    judged = quality.clean_products(s.raw_products, s.rules)
    return judged.select("staging_id", "product_id", "processed_flag", "error_message")


@query
def quality_summary(s):
    return quality.quality_summary(s.sales, s.customers, s.products)


@query
def customer_segment(s):
    rows = dimensions.customer_rows(s.customers, s.rules)
    return rows.select("customer_id", "country", "city", "customer_segment")


@query
def distinct_customers(s):
    rows = dimensions.customer_rows(s.customers, s.rules)
    return dimensions.distinct_rows(rows, dimensions.CUSTOMER)


# -- dimensions ------------------------------------------------------------------------

@query
def dim_date(s):
    return date_dimension(s.spark, s.rules.start_date, s.rules.end_date)


@query
def dim_customer(s):
    return s.customer


@query
def dim_product(s):
    return s.product


@query
def scd2_customers(s):
    """Second batch a day later: MIDDLE EAST is new, AFRICA is absent, NATION_3 moved."""
    rows = dimensions.customer_rows(s.customers, s.rules)
    first = rows.where("country <> 'MIDDLE EAST'")
    moved = F.when(F.col("city") == "NATION_3", F.lit("NATION_3 EAST")).otherwise(F.col("city"))
    second = rows.where("country <> 'AFRICA'").withColumns(
        {"city": moved, "registration_date": F.date_add("registration_date", 1)}
    )
    merge = dimensions.scd2_merge
    before = s.scratch.keep(
        merge(None, first, dimensions.CUSTOMER, s.as_of, s.scratch), "first_customers"
    )
    return merge(before, second, dimensions.CUSTOMER, SECOND_DAY, s.scratch)


def _cheaper(products: DataFrame, kind) -> DataFrame:
    """STANDARD costs a tenth less."""
    less = (F.col("cost_price") * F.lit("0.9").cast("decimal(2,1)")).cast(kind)
    return products.withColumn("cost_price", F.when(F.col("category") == "STANDARD", less)
                               .otherwise(F.col("cost_price")))


@query
def scd2_products(s):
    """Second batch a day later: STANDARD costs a tenth less, Brand#1 is absent."""
    rows = dimensions.product_rows(s.products)
    second = _cheaper(rows.where("supplier <> 'Brand#1'"), S.PRICE)
    merge = dimensions.scd2_merge
    before = s.scratch.keep(
        merge(None, rows, dimensions.PRODUCT, s.as_of, s.scratch), "first_products"
    )
    return merge(before, second, dimensions.PRODUCT, SECOND_DAY, s.scratch)


# -- facts and aggregates --------------------------------------------------------------

@query
def fact_sales(s):
    return s.star.fact.select(*S.FACT_SALES.fieldNames())


@query
def fact_rejects(s):
    return facts.rejected(s.candidates).select(
        "staging_id", "order_id", "customer_id", "product_id", "order_date", "reject_reason"
    )


@query
def fact_reject_counts(s):
    return facts.reject_counts(s.candidates)


def _loaded_by(s, warehouse) -> DataFrame:
    """Facts with the number of the load that added them. Customer keys are those of a single
    load, as a customer who comes later has a later key."""
    ids = warehouse.dimension(dimensions.CUSTOMER).select("customer_key", "customer_id").distinct()
    known = s.customer.select(F.col("customer_id"), F.col("customer_key").alias("_key"))
    first = min(int(path.rsplit("=", 1)[1]) for _, path in warehouse.ledger.outputs(LOAD_FACTS))
    return (
        warehouse.fact().join(ids, "customer_key").join(known, "customer_id")
        .withColumn("customer_key", F.col("_key"))
        .select(*facts.MEASURES, F.when(F.col("load_run") == first, 1).otherwise(2).alias("run"))
    )


@query
def fact_insert_ignore(s):
    """Sales until 1998 load first, then all are offered: no loaded fact changes. Those of the
    first load are shown with negated amounts."""
    early = F.col("order_date") < F.lit(FIRST_LOAD_END)
    both = s.offered_twice("insert_ignore", {SALES: early}, {})
    amount = F.when(F.col("run") == 1, -F.col("total_amount")).otherwise(F.col("total_amount"))
    return _loaded_by(s, both).withColumn(
        "total_amount", amount.cast(S.AMOUNT)).select(*facts.MEASURES)


@query
def incremental_facts(s):
    """Customers who registered late are unknown to the first run and known to the second,
    which offers all sales again: those held back then load, and no other."""
    late = F.col("registration_date") >= F.lit(LATE_CUSTOMERS)
    both = s.offered_twice("incremental", {CUSTOMERS: ~late},
                           {CUSTOMERS: s.raw_customers.where(late)})
    return _loaded_by(s, both)


@query
def fact_reload_after_version(s):
    """STANDARD products get cheaper, which opens versions with new keys, and all sales are
    offered again: no fact is added. Products that were invalid are not sent again, as a lower
    cost would release their sales."""
    valid = s.raw_products.where("cost_price <= msrp")
    both = s.offered_twice("reload", {}, {PRODUCTS: _cheaper(valid, S.PRICE)})
    return _loaded_by(s, both)


@query
def full_run(s):
    """Facts of a full run from source files."""
    return s.full_run.fact().select(*S.FACT_SALES.fieldNames())


@query
def stream_run(s):
    """Facts of file streams over the same source files."""
    return s.stream_run.fact().select(*S.FACT_SALES.fieldNames())


@query
def published_views(s):
    """Customers and places, asked in SQL of the published views."""
    views.register_views(s.spark, s.star, s.as_of, s.scratch)
    return s.spark.sql("""
        SELECT g.country, g.city, g.customer_count, g.order_count, g.total_sales,
               count(*) AS customers,
               CAST(sum(c.lifetime_value) AS DECIMAL(22, 2)) AS lifetime_value
        FROM geographic_analysis g JOIN customer_analysis c
          ON c.country = g.country AND c.city = g.city
        GROUP BY g.country, g.city, g.customer_count, g.order_count, g.total_sales""")


@query
def agg_sales_daily(s):
    return s.aggregates


@query
def agg_daily_union(s):
    return aggregates.daily_by_union(s.star.fact)


@query
def agg_daily_grouping_sets(s):
    return aggregates.daily_by_grouping_sets(s.star.fact)


# -- reports ---------------------------------------------------------------------------

for _report in (
    reports.daily_sales, reports.top_customers, reports.product_performance,
    reports.monthly_trend, reports.monthly_performance, reports.segment_analysis,
    reports.category_performance, reports.retention, reports.sales_by_geography,
    views.sales_view, views.daily_aggregates, views.mtd_running, views.ytd_running,
    dashboard.kpi_summary, dashboard.kpi_export, dashboard.daily_trend,
    dashboard.top_products, dashboard.product_categories, dashboard.customers_by_place,
    dashboard.segment_sales, checks.validation,
):
    _QUERIES[_report.__name__] = lambda s, report=_report: report(s.star)


@query
def hourly_pattern(s):
    return reports.hourly_pattern(s.star.fact)


@query
def hourly_events(s):
    events = s.spark.read.parquet(f"{s.folder}/events.parquet")
    cents = F.round(F.col("value") * 100).cast("long").cast("decimal(18,0)")
    value = (cents * F.lit("0.01").cast("decimal(3,2)")).cast(S.AMOUNT)
    return reports.hourly_pattern(events.withColumn("value", value), "ts", "event_id", "value")


@query
def yoy_growth(s):
    return reports.yoy_growth(s.star, s.as_of)


@query
def customer_analysis(s):
    return views.customer_analysis(s.star, s.as_of)


@query
def product_performance_view(s):
    return views.product_performance_view(s.star, s.scratch)


@query
def product_ranks_spread(s):
    """The ranks of the product view, computed without a single-task window."""
    view = views.product_performance_view(s.star, s.scratch)
    return view.select("product_key", "total_revenue", "total_profit", "revenue_rank",
                       "profit_rank", "category_revenue", "category_orders")


@query
def geographic_analysis(s):
    return views.geographic_analysis(s.star, s.as_of)


@query
def daily_trend_filtered(s):
    return dashboard.daily_trend(s.star, FILTER_FIRST, FILTER_LAST)


@query
def top_products_10(s):
    return dashboard.top_products(s.star, limit=10)


@query
def top_products_filtered(s):
    return dashboard.top_products(s.star, category=FILTER_CATEGORY)


@query
def warehouse_invariants(s):
    _ = s.aggregates
    return s.warehouse.invariants()


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function):
        return lambda spark, folder: function(sample(spark, folder))

    return {name: bind(function) for name, function in _QUERIES.items()}
