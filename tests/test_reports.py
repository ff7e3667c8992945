from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.columns import customer_tier
from starloom.operators import aggregates
from starloom.plans import checks, dashboard, reports, views
from starloom.sources.calendar import date_dimension


def fact_rows(spark, rows):
    """rows: (day, customer key, product key, order, amount)."""
    full = [(i, day.year * 10000 + day.month * 100 + day.day, c, p, o, 1, D(a), D(a), D("1.00"),
             D(a) - 1, D("10.00"), dt.datetime(day.year, day.month, day.day))
            for i, (day, c, p, o, a) in enumerate(rows, 1)]
    return spark.createDataFrame(full, S.FACT_SALES)


def customers(spark, rows):
    """rows: (key, id, city, registration, current)."""
    names = S.DIM_CUSTOMER.fieldNames()
    return spark.createDataFrame([tuple({
        "customer_key": k, "customer_id": i, "customer_name": i, "city": city, "country": "X",
        "customer_segment": "OTHER", "registration_date": reg, "valid_from": reg,
        "is_current": cur}.get(n) for n in names) for k, i, city, reg, cur in rows],
        S.DIM_CUSTOMER)


def products(spark, rows):
    names = S.DIM_PRODUCT.fieldNames()
    return spark.createDataFrame([tuple({
        "product_key": k, "product_id": i, "product_name": i, "category": cat,
        "cost_price": D("1.00"), "msrp": D("2.00"), "is_current": cur}.get(n) for n in names)
        for k, i, cat, cur in rows], S.DIM_PRODUCT)


REG = dt.date(2022, 5, 1)


@pytest.fixture(scope="module")
def dates(spark):
    return date_dimension(spark, dt.date(2020, 1, 1), dt.date(2025, 12, 31)).cache()


def star(spark, dates, fact, people=None, items=None):
    people = people or [(1, "A", "c", REG, True), (2, "B", "c", REG, True)]
    items = items or [(1, "P", "FOOD", True), (2, "Q", "FOOD", True)]
    return S.Star(fact_rows(spark, fact), customers(spark, people), products(spark, items), dates)


def day(text):
    return dt.date.fromisoformat(text)


def test_calendar(dates):
    assert dates.count() == 2192
    rows = {r.date_key: r for r in dates.where(F.col("date_key").isin(20240101, 20240106)).collect()}
    monday, saturday = rows[20240101], rows[20240106]
    assert (monday.day_of_week, monday.is_weekend, monday.day_name, monday.month_name,
            monday.quarter, monday.is_holiday) == (1, False, "Monday", "January", 1, False)
    assert (saturday.day_of_week, saturday.is_weekend) == (6, True)


@pytest.mark.parametrize("value,tier", [("1000", "Basic"), ("1000.01", "Regular"),
                                        ("5000", "Regular"), ("5000.01", "Premium"),
                                        ("10000", "Premium"), ("10000.01", "VIP")])
def test_tiers(spark, value, tier):
    df = spark.range(1).select(customer_tier(F.lit(value).cast("decimal(22,2)")).alias("t"))
    assert df.first().t == tier


def test_retention_counts_customers_without_sales(spark, dates):
    people = [(1, "A", "c", day("2023-01-01"), True), (2, "B", "c", day("2023-06-01"), True),
              (3, "C", "c", day("2024-01-01"), True), (4, "D", "c", day("2023-01-01"), False)]
    s = star(spark, dates, [(day("2023-02-01"), 1, 1, "o1", "5.00"),
                            (day("2023-02-01"), 3, 1, "o2", "5.00")], people)
    got = [tuple(r) for r in reports.retention(s).collect()]
    assert got == [(2024, 1, 0, D("0.00")), (2023, 2, 1, D("50.00"))]


def test_moving_average_counts_rows_not_days(spark, dates):
    days = [day(f"2024-01-{n:02d}") for n in (1, 2, 3, 4, 5, 6, 7, 20)]
    s = star(spark, dates, [(d, 1, 1, f"o{i}", f"{i}.00") for i, d in enumerate(days, 1)])
    rows = {r.full_date: r for r in views.daily_aggregates(s).collect()}
    assert rows[days[0]].weekly_moving_avg == D("1.000000")
    assert rows[days[-1]].weekly_moving_avg == D("5.000000")  # (2 + .. + 8) / 7
    assert rows[days[-1]].mtd_sales == rows[days[-1]].ytd_sales == D("8.00")


def test_running_totals(spark, dates):
    s = star(spark, dates, [(day("2024-01-30"), 1, 1, "a", "1.00"),
                            (day("2024-01-31"), 1, 1, "b", "2.00"),
                            (day("2024-02-01"), 1, 1, "c", "4.00"),
                            (day("2025-01-01"), 1, 1, "d", "8.00")])
    assert [r.mtd_sales for r in views.mtd_running(s).orderBy("full_date").collect()] == [
        D(1), D(3), D(4), D(8)]
    assert [r.ytd_sales for r in views.ytd_running(s).orderBy("full_date").collect()] == [
        D(1), D(3), D(7), D(8)]


def test_growth_equals_the_self_join(spark, dates):
    rows = [(day("2024-01-05"), 1, 1, "a", "150.00"), (day("2023-01-05"), 1, 1, "b", "100.00"),
            (day("2024-02-05"), 1, 1, "c", "10.00"), (day("2023-03-05"), 1, 1, "d", "10.00"),
            (day("2022-01-05"), 1, 1, "e", "7.00")]
    s = star(spark, dates, rows)
    got = [tuple(r) for r in reports.yoy_growth(s, day("2024-06-01")).collect()]
    assert got == [(2024, 2, "February", D("10.00"), None, None),
                   (2024, 1, "January", D("150.00"), D("100.00"), D("50.00"))]


def test_reports_follow_current_versions_and_dashboard_follows_all(spark, dates):
    people = [(1, "A", "old", REG, False), (2, "A", "new", REG, True)]
    items = [(1, "P", "FOOD", False), (2, "P", "FOOD", True)]
    s = star(spark, dates, [(day("2024-01-01"), 1, 1, "a", "5.00"),
                            (day("2024-01-02"), 2, 2, "b", "7.00")], people, items)
    assert [r.total_spent for r in reports.top_customers(s).collect()] == [D("7.00")]
    assert [r.revenue for r in reports.product_performance(s).collect()] == [D("7.00")]
    assert views.sales_view(s).count() == 1
    assert [r.revenue for r in dashboard.top_products(s).collect()] == [D("12.00")]
    assert sorted(r.city for r in dashboard.customers_by_place(s).collect()) == ["new", "old"]
    assert [r.total_sales for r in dashboard.segment_sales(s).collect()] == [D("12.00")]


def test_frequency_without_active_days_is_null(spark, dates):
    s = star(spark, dates, [(day("2024-01-01"), 1, 1, "a", "5.00"),
                            (day("2023-12-02"), 2, 1, "b", "5.00")])
    rows = {r.customer_id: r for r in views.customer_analysis(s, day("2024-01-01")).collect()}
    assert (rows["A"].days_since_last_order, rows["A"].monthly_frequency) == (0, None)
    assert (rows["B"].days_since_last_order, rows["B"].monthly_frequency) == (30, D("1.0147"))


def test_filters(spark, dates):
    s = star(spark, dates, [(day("2024-01-01"), 1, 1, "a", "5.00"),
                            (day("2024-01-02"), 1, 2, "b", "6.00")],
             items=[(1, "P", "FOOD", True), (2, "Q", "HOME", True)])
    trend = dashboard.daily_trend(s, day("2024-01-02"), day("2024-01-02")).collect()
    assert [r.full_date for r in trend] == [day("2024-01-02")]
    assert [r.product_name for r in dashboard.top_products(s, category="HOME").collect()] == ["Q"]
    assert [r.category for r in dashboard.product_categories(s).collect()] == ["FOOD", "HOME"]


def test_export_file(spark, dates, tmp_path):
    s = star(spark, dates, [(day("2024-01-01"), 1, 1, "a", "5.00")])
    dashboard.write_csv(dashboard.kpi_export(s), str(tmp_path / "kpi"))
    text = next((tmp_path / "kpi").glob("part-*.csv")).read_text().splitlines()
    assert text == ["Metric,Value", "Total Sales,5.00", "Total Profit,4.00", "Quantity Sold,1",
                    "Total Orders,1", "Avg Margin,10.000000"]


def test_an_empty_warehouse(spark, dates):
    s = star(spark, dates, [])
    assert reports.daily_sales(s).count() == 0
    assert dashboard.kpi_summary(s).first().order_count == 0
    assert {r.label: r.value for r in checks.validation(s).collect()}["Total Sales Amount"] is None


def test_views_are_published_for_sql(spark, dates, scratch):
    s = star(spark, dates, [(day("2024-01-01"), 1, 1, "a", "5.00")])
    views.register_views(spark, s, day("2024-01-02"), scratch)
    for name in ("sales_view", "daily_aggregates", "customer_analysis", "product_performance",
                 "geographic_analysis"):
        assert spark.sql(f"SELECT * FROM {name}").count() == 1


def test_aggregate_forms_agree(spark):
    """Orders are shared by customers and days here, which plain counts would get wrong."""
    rng = random.Random(11)
    keys = {(rng.randrange(60), rng.randrange(6)) for _ in range(250)}
    rows = [(day(f"2024-01-{rng.randrange(1, 6):02d}"), rng.randrange(5), p, f"o{o}",
             f"{rng.randrange(1, 900)}.{rng.randrange(100):02d}") for o, p in sorted(keys)]
    fact = fact_rows(spark, rows)
    forms = [aggregates.daily_aggregates, aggregates.daily_by_union,
             aggregates.daily_by_grouping_sets]
    results = [sorted(map(str, (tuple(r) for r in form(fact).select(*aggregates.COLUMNS).collect())))
               for form in forms]
    assert results[0] == results[1] == results[2]
    keyed = aggregates.with_agg_key(aggregates.daily_aggregates(fact))
    assert keyed.select("agg_key").distinct().count() == keyed.count() == len(results[0])


def test_grouping_sets_copy_rows_for_no_second_distinct_count(spark):
    """Every expansion makes a copy for each of two sets, and none for a distinct column."""
    fact = fact_rows(spark, [(day("2024-01-01"), 1, 1, "o1", "2.50")])
    plan = aggregates.daily_by_grouping_sets(fact)._jdf.queryExecution().optimizedPlan().toString()
    expands = [line for line in plan.splitlines() if "Expand [" in line]
    # Projections and the list of their columns, with a comma between every two.
    assert expands and all(line.split("Expand [[")[1].count("], [") == 2 for line in expands)


def test_invariants_find_faults(spark, dates):
    rows = [(day("2024-01-01"), 1, 1, "a", "5.00"), (day("2024-01-01"), 9, 1, "a", "5.00")]
    s = star(spark, dates, rows, people=[(1, "A", "c", REG, True), (2, "A", "c", REG, True)])
    agg = aggregates.daily_by_union(fact_rows(spark, rows[:1]))
    found = {r.check: r.n for r in checks.invariants(s, agg).collect()}
    assert found["amount of day grain differs from facts"] == 5
    assert found["customer without exactly one current version"] == 1
    assert found["fact key repeated"] == 1
    assert found["facts without customer"] == 1
    assert found["facts without date"] == 0


@pytest.mark.parametrize("lines, busy", [(1 << 20, 1 << 22), (10, 1 << 22), (10, 20), (1, 1)])
def test_aggregates_by_slices_agree(spark, scratch, monkeypatch, lines, busy):
    """Slices of a month or a few days, and days that are cut, some or all."""
    monkeypatch.setattr(aggregates, "LINES", lines)
    monkeypatch.setattr(aggregates, "BUSY", busy)
    rng = random.Random(5)
    keys = {(rng.randrange(60), rng.randrange(6)) for _ in range(250)}
    rows = [(day(f"2024-0{rng.randrange(1, 4)}-0{rng.randrange(1, 6)}"), rng.randrange(5), p,
             f"o{o}", f"{rng.randrange(1, 900)}.{rng.randrange(100):02d}") for o, p in sorted(keys)]
    fact = scratch.keep(fact_rows(spark, rows), "facts_of_days")
    made = aggregates.daily_by_slices(fact, scratch).select(*aggregates.COLUMNS)
    ours, theirs = (sorted(map(str, map(tuple, f.collect())))
                    for f in (made, aggregates.daily_aggregates(fact).select(*aggregates.COLUMNS)))
    assert ours == theirs
    if busy > 250:
        # Lines travel once for all grains but the orders of a day, and grains not at all.
        plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        sent = [line for line in plan.splitlines()
                if "- Exchange hashpartitioning(order_month" in line]
        assert len(sent) == 1 and "REPARTITION_BY_COL" in sent[0] and "ReusedExchange" in plan
        assert "REBALANCE" not in plan
    assert aggregates.daily_by_slices(fact.limit(0), scratch).count() == 0
