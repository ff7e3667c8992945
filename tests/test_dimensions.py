from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import dimensions
from starloom.operators.dimensions import CUSTOMER, PRODUCT, scd2_merge

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 5)


def people(spark, *rows):
    full = []
    for i, row in enumerate(rows, 1):
        base = {"staging_id": i, "customer_name": "n", "email": "a@b.c", "phone": "0",
                "address": "x", "city": "Hanoi", "country": "Vietnam",
                "registration_date": D1, "processed_flag": True}
        full.append(tuple({**base, **row}.get(n) for n in S.STAGING_CUSTOMERS.fieldNames()))
    return dimensions.customer_rows(spark.createDataFrame(full, S.STAGING_CUSTOMERS))


def versions(dim):
    return sorted((r.customer_id, r.valid_from, r.valid_to, r.is_current, r.city, r.customer_key)
                  for r in dim.collect())


@pytest.fixture
def first(spark, scratch):
    rows = people(spark, {"customer_id": "B"}, {"customer_id": "A"}, {"customer_id": "C"})
    return scd2_merge(None, rows, CUSTOMER, D1, scratch)


def check_invariant(dim):
    current = dim.groupBy("customer_id").agg(F.count_if("is_current").alias("n"))
    assert current.where("n <> 1").count() == 0
    assert dim.groupBy("customer_key").count().where("count > 1").count() == 0
    overlaps = dim.alias("a").join(dim.alias("b"), F.expr(
        "a.customer_id = b.customer_id AND a.customer_key < b.customer_key "
        "AND a.valid_from <= coalesce(b.valid_to, date '9999-12-31') "
        "AND b.valid_from <= coalesce(a.valid_to, date '9999-12-31')"))
    assert overlaps.count() == 0


def test_first_load(first):
    assert versions(first) == [
        ("A", D1, None, True, "Hanoi", 1), ("B", D1, None, True, "Hanoi", 2),
        ("C", D1, None, True, "Hanoi", 3)]
    assert first.columns == S.DIM_CUSTOMER.fieldNames()


def test_latest_staged_row_wins_and_invalid_rows_do_not_count(spark, scratch):
    rows = people(spark, {"customer_id": "A", "city": "one"}, {"customer_id": "A", "city": "two"},
                  {"customer_id": "A", "city": "three", "processed_flag": False,
                   "error_message": "bad"}, {"customer_id": None})
    dim = scd2_merge(None, rows, CUSTOMER, D1, scratch)
    assert [v[4] for v in versions(dim)] == ["two"]


def test_change_over_three_days(spark, scratch, first):
    day2 = people(spark, {"customer_id": "A", "city": "Hue"}, {"customer_id": "D"},
                  {"customer_id": "B", "registration_date": D3})
    dim = scd2_merge(first, day2, CUSTOMER, D2, scratch)
    check_invariant(dim)
    assert versions(dim) == [
        ("A", D1, D1, False, "Hanoi", 1), ("A", D2, None, True, "Hue", 4),
        ("B", D1, None, True, "Hanoi", 2), ("C", D1, None, True, "Hanoi", 3),
        ("D", D2, None, True, "Hanoi", 5)]
    assert dim.where("customer_id = 'B'").first().registration_date == D1
    again = scd2_merge(dim, day2, CUSTOMER, D2, scratch)
    assert versions(again) == versions(dim)
    day3 = people(spark, {"customer_id": "A", "city": "Hanoi"})
    last = scd2_merge(dim, day3, CUSTOMER, D3, scratch)
    check_invariant(last)
    assert versions(last)[:3] == [
        ("A", D1, D1, False, "Hanoi", 1), ("A", D2, dt.date(2024, 1, 4), False, "Hue", 4),
        ("A", D3, None, True, "Hanoi", 6)]


def test_same_day_change_overwrites(spark, scratch, first):
    rows = people(spark, {"customer_id": "A", "city": "Da Nang", "registration_date": D3})
    dim = scd2_merge(first, rows, CUSTOMER, D1, scratch)
    row = dim.where("customer_id = 'A'").first()
    assert dim.count() == 3
    assert (row.city, row.customer_segment, row.customer_key, row.registration_date,
            row.is_current) == ("Da Nang", "OTHER", 1, D1, True)


@pytest.mark.parametrize("before,after", [(None, "x"), ("x", None)])
def test_null_is_a_value(spark, scratch, before, after):
    dim = scd2_merge(None, people(spark, {"customer_id": "A", "phone": before}), CUSTOMER, D1,
                     scratch)
    dim = scd2_merge(dim, people(spark, {"customer_id": "A", "phone": after}), CUSTOMER, D2,
                     scratch)
    assert [(r.phone, r.is_current) for r in dim.orderBy("valid_from").collect()] == [
        (before, False), (after, True)]


def test_product_margin_and_versions(spark, scratch):
    names = S.STAGING_PRODUCTS.fieldNames()

    def products(*prices):
        rows = [{"staging_id": i, "product_id": f"P{i}", "product_name": "n", "cost_price": D(c),
                 "msrp": D(m), "processed_flag": True} for i, (c, m) in enumerate(prices, 1)]
        return dimensions.product_rows(
            spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows],
                                  S.STAGING_PRODUCTS))

    dim = scd2_merge(None, products(("150.00", "199.99"), ("25.00", "39.99"), ("9.9825", "10.00")),
                     PRODUCT, D1, scratch)
    assert [r.profit_margin for r in dim.orderBy("product_key").collect()] == [
        D("25.00"), D("37.48"), D("0.20")]
    dim = scd2_merge(dim, products(("140.00", "199.99")), PRODUCT, D2, scratch)
    rows = dim.where("product_id = 'P1'").orderBy("valid_from").collect()
    assert [(r.cost_price, r.profit_margin, r.is_current) for r in rows] == [
        (D("150.00"), D("25.00"), False), (D("140.00"), D("30.00"), True)]
