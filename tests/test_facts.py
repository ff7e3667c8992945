from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.columns import product_margin, sale_margin
from starloom.operators import facts
from starloom.operators.numbering import with_row_ids
from starloom.sources.calendar import date_dimension

DAY = dt.date(2024, 1, 5)
SALES = ("staging_id long, order_id string, order_date date, customer_id string, "
         "product_id string, quantity int, unit_price decimal(10,2), total_amount decimal(12,2)")


def dims(spark):
    customers = spark.createDataFrame(
        [(1, "C1", True), (2, "C2", False)],
        "customer_key long, customer_id string, is_current boolean")
    products = spark.createDataFrame(
        [(1, "P1", D("4.00"), True), (2, "P2", D("99999999.99"), True), (3, "P3", D("1"), False)],
        "product_key long, product_id string, cost_price decimal(10,2), is_current boolean")
    return customers, products, date_dimension(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31))


def sale(i, **c):
    row = {"order_id": f"O{i}", "order_date": DAY, "customer_id": "C1", "product_id": "P1",
           "quantity": 2, "unit_price": D("5.00"), "total_amount": D("10.00"), **c}
    return (i, *row.values())


def candidates(spark, rows, existing=None):
    return facts.fact_candidates(spark.createDataFrame(rows, SALES), *dims(spark), existing)


def test_measures(spark):
    row = facts.accepted(candidates(spark, [sale(1)])).first()
    assert (row.date_key, row.customer_key, row.product_key) == (20240105, 1, 1)
    assert (row.cost_amount, row.profit_amount, row.profit_margin) == (
        D("8.00"), D("2.00"), D("20.00"))
    assert row.order_timestamp == dt.datetime(2024, 1, 5)


def test_reject_reasons(spark):
    rows = [sale(1, product_id="P9"), sale(2, customer_id="C9"), sale(3, customer_id="C2"),
            sale(4, product_id="P3"), sale(5, order_date=dt.date(2024, 2, 1)),
            sale(6, quantity=None), sale(7, order_date=None), sale(8),
            sale(9, product_id="P9", customer_id="C9")]
    got = {r.staging_id: r.reject_reason for r in candidates(spark, rows).collect()}
    assert got == {1: facts.NO_PRODUCT, 2: facts.NO_CUSTOMER, 3: facts.NO_CUSTOMER,
                   4: facts.NO_PRODUCT, 5: facts.NO_DATE, 6: facts.NO_VALUE, 7: facts.NO_DATE,
                   8: None, 9: facts.NO_PRODUCT}
    held = facts.retried(candidates(spark, rows))
    assert sorted(r.staging_id for r in held.collect()) == [1, 2, 3, 4, 5, 7, 9]
    counts = {r.reject_reason: r.row_count for r in
              facts.reject_counts(candidates(spark, rows)).collect()}
    assert sum(counts.values()) == 8


def test_values_are_clipped_to_their_columns(spark):
    row = facts.accepted(candidates(spark, [sale(1, product_id="P2", quantity=1000)])).first()
    assert (row.cost_amount, row.profit_amount, row.profit_margin) == (
        D("9999999999.99"), D("-9999999999.99"), D("-999.99"))


def test_stored_keys_are_marked(spark):
    stored = spark.createDataFrame([("O1", "P1"), ("O2", "P2")],
                                   "order_id string, product_id string")
    got = {r.order_id: r.reject_reason for r in
           candidates(spark, [sale(1), sale(2), sale(3)], stored).collect()}
    assert got == {"O1": facts.LOADED, "O2": None, "O3": None}


def test_margin_rounds_halves_to_even(spark):
    df = spark.createDataFrame(
        [(D("0.0469"), D("2.00")), (D("2.345"), D("100.00")), (D("2.355"), D("100.00")),
         (D("-2.345"), D("100.00")), (D("5"), D("0.00")), (D("-2000"), D("100.00")),
         (D("2000"), D("100.00")), (D("1"), D("3.00"))],
        "profit decimal(22,4), total decimal(12,2)")
    got = [r.m for r in df.select(sale_margin(F.col("profit"), F.col("total")).alias("m")).collect()]
    assert got == [D("2.34"), D("2.34"), D("2.36"), D("-2.34"), D("0.00"), D("-999.99"),
                   D("999.99"), D("33.33")]


def test_list_margin_rounds_halves_up(spark):
    df = spark.createDataFrame([(D("97.655"), D("100")), (D("1"), D("0")), (D("0"), None)],
                               "cost decimal(10,3), msrp decimal(10,2)")
    got = [r.m for r in df.select(product_margin(F.col("cost"), F.col("msrp")).alias("m")).collect()]
    assert got == [D("2.35"), None, None]


def test_schema_of_the_fact_row(spark):
    types = dict(candidates(spark, [sale(1)]).dtypes)
    for field in S.FACT_SALES.fields[1:]:
        assert types[field.name] == field.dataType.simpleString(), field.name


def test_a_date_filter_holds_sales_back(spark):
    rows = [sale(1), sale(2, order_date=dt.date(2024, 1, 4)), sale(3, order_date=None)]
    found = facts.fact_candidates(spark.createDataFrame(rows, SALES), *dims(spark), first=DAY)
    got = {r.staging_id: r.reject_reason for r in found.collect()}
    assert got == {1: None, 2: facts.FILTERED, 3: facts.NO_DATE}
    assert sorted(r.staging_id for r in facts.retried(found).collect()) == [2, 3]


@pytest.mark.parametrize("partitions", [1, 3, 13])
def test_keys_follow_day_order_and_product_alone(spark, scratch, partitions):
    """One busy day over several partitions: keys equal row numbers, whatever the settings."""
    rows = [sale(i, order_id=f"O{i * 7919 % 4001:05d}",
                 order_date=dt.date(2024, 1, 1 + (i % 7 if i % 3 else 0)),
                 product_id="P1" if i % 2 else "P2") for i in range(4000)]
    found = facts.accepted(candidates(spark, rows))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        numbered = with_row_ids(found, [F.col(n) for n in facts.LOAD_ORDER], "n", scratch)
        got = [(r.n, r.staging_id) for r in numbered.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    keys = {r.staging_id: (r.date_key, r.order_id, r.product_id) for r in found.collect()}
    wanted = sorted(keys, key=keys.get)
    assert sorted(got) == list(enumerate(wanted, 1))


def test_resolved_sales_travel_without_measures(spark):
    """What follows from a resolved sale is added where it is read."""
    found = facts.resolve(spark.createDataFrame([sale(1), sale(2, product_id="P9")], SALES),
                          *dims(spark))
    assert not {"cost_amount", "profit_amount", "profit_margin", "order_timestamp"} & set(
        found.columns)
    assert {"staging_id", "reject_reason", *facts.FACT_PARTS} <= set(found.columns)
    parts = facts.accepted(found).select(*facts.FACT_PARTS)
    direct = facts.accepted(candidates(spark, [sale(1)]))
    assert facts.with_measures(parts).select(*facts.MEASURES).collect() == direct.select(
        *facts.MEASURES).collect()
