from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

import pytest

from starloom import schemas as S
from starloom.operators import quality

RULES = S.Rules()
DAY = dt.date(2024, 1, 5)


def staged(spark, schema, rows):
    names = schema.fieldNames()
    base = {"processed_flag": False}
    return spark.createDataFrame(
        [tuple({"staging_id": i, **base, **row}.get(n) for n in names)
         for i, row in enumerate(rows, 1)], schema)


def sale(**changes):
    row = {"order_id": "O1", "product_id": "P1", "order_date": DAY, "quantity": 2,
           "unit_price": D("5.00")}
    row.update(changes)
    if "total_amount" not in row:
        known = row["quantity"] is not None and row["unit_price"] is not None
        row["total_amount"] = row["quantity"] * row["unit_price"] if known else D("1.00")
    return row


SALE_CASES = [
    (sale(quantity=0), S.QUANTITY_LOW),
    (sale(quantity=1), None),
    (sale(quantity=1000), None),
    (sale(quantity=1001), S.QUANTITY_HIGH),
    (sale(unit_price=D("0.00")), S.PRICE_LOW),
    (sale(unit_price=D("0.01")), None),
    (sale(unit_price=D("10000.00")), None),
    (sale(unit_price=D("10000.01")), S.PRICE_HIGH),
    (sale(unit_price=D("39.99"), total_amount=D("79.99")), S.TOTAL_MISMATCH),
    (sale(unit_price=D("39.99"), total_amount=D("79.98")), None),
    (sale(order_date=dt.date(2019, 12, 31)), S.DATE_OUTSIDE),
    (sale(order_date=dt.date(2020, 1, 1)), None),
    (sale(order_date=dt.date(2025, 12, 31)), None),
    (sale(order_date=dt.date(2026, 1, 1)), S.DATE_OUTSIDE),
    (sale(quantity=0, unit_price=D("0.00")), S.QUANTITY_LOW),
    (sale(quantity=1001, unit_price=D("10000.01")), S.QUANTITY_HIGH),
    (sale(unit_price=D("10000.01"), total_amount=D("1.00")), S.PRICE_HIGH),
    (sale(total_amount=D("1.00"), order_date=dt.date(2019, 1, 1)), S.TOTAL_MISMATCH),
    (sale(quantity=None), None),
    (sale(unit_price=None), None),
    (sale(order_date=None), None),
    (sale(total_amount=None), None),
]


def judged(df):
    return {r.staging_id: r for r in df.collect()}


def test_sales_rules(spark):
    rows = judged(quality.validate_sales(
        staged(spark, S.STAGING_SALES, [case for case, _ in SALE_CASES]), RULES))
    for number, (case, expected) in enumerate(SALE_CASES, 1):
        assert rows[number].error_message == expected, case
        assert rows[number].processed_flag is (expected is None), case


def test_null_can_be_an_error(spark):
    rules = replace(RULES, null_is_error=True)
    rows = judged(quality.validate_sales(
        staged(spark, S.STAGING_SALES, [sale(quantity=None), sale()]), rules))
    assert [rows[i].error_message for i in (1, 2)] == [S.MISSING_VALUE, None]


def test_total_tolerance(spark):
    rules = replace(RULES, tolerance=D("0.01"))
    rows = judged(quality.validate_sales(staged(spark, S.STAGING_SALES, [
        sale(total_amount=D("10.01")), sale(total_amount=D("10.02"))]), rules))
    assert [rows[i].error_message for i in (1, 2)] == [None, S.TOTAL_MISMATCH]


def test_errors_and_finished_rows_are_sticky(spark):
    rows = judged(quality.validate_sales(staged(spark, S.STAGING_SALES, [
        sale(error_message="earlier"), sale(quantity=0, processed_flag=True)]), RULES))
    assert (rows[1].error_message, rows[1].processed_flag) == ("earlier", False)
    assert (rows[2].error_message, rows[2].processed_flag) == (None, True)


def test_customer_cleaning(spark):
    emails = ["a@b", "a@b.c", " A@B.C ", None, "user.example.com"]
    rows = judged(quality.clean_customers(staged(spark, S.STAGING_CUSTOMERS, [
        {"customer_id": str(i), "customer_name": "  Ann Lee ", "email": e, "phone": " 0987 ",
         "address": " x ", "city": " Hanoi ", "country": " Vietnam "}
        for i, e in enumerate(emails)])))
    bad = S.EMAIL_INVALID
    assert [rows[i].error_message for i in range(1, 6)] == [bad, None, None, None, bad]
    third = rows[3]
    assert (third.email, third.customer_name, third.phone, third.city, third.country,
            third.address) == ("a@b.c", "Ann Lee", "0987", "Hanoi", "Vietnam", "x")


def test_finished_customers_are_not_cleaned_again(spark):
    rows = judged(quality.clean_customers(staged(spark, S.STAGING_CUSTOMERS, [
        {"customer_id": "1", "city": " Hanoi ", "email": "a@b.c", "processed_flag": True}])))
    assert rows[1].city == " Hanoi "


@pytest.mark.parametrize("text,expected", [
    (" team SPORTS ", "Team sports"), ("Team Sports", "Team sports"), ("x", "X"), ("", ""),
    (None, None), ("éCLAIR", "Éclair"),
])
def test_subcategory(spark, text, expected):
    rows = judged(quality.standardise_products(staged(spark, S.STAGING_PRODUCTS, [
        {"product_id": "1", "subcategory": text, "category": " food ", "supplier": " s "}])))
    assert (rows[1].subcategory, rows[1].category, rows[1].supplier) == (expected, "FOOD", "s")


def test_product_rules(spark):
    prices = [("0", "5"), ("-1", "-2"), ("5", "0"), ("5", "4.99"), ("5", "5"), (None, "5"),
              ("5", None)]
    rows = judged(quality.validate_products(staged(spark, S.STAGING_PRODUCTS, [
        {"product_id": "1", "cost_price": c and D(c), "msrp": m and D(m)} for c, m in prices])))
    assert [rows[i].error_message for i in range(1, 8)] == [
        S.COST_INVALID, S.COST_INVALID, S.MSRP_INVALID, S.MSRP_LOW, None, None, None]


def test_segments(spark):
    places = [("USA", "x", "INTERNATIONAL"), ("UK", "x", "INTERNATIONAL"),
              ("Australia", "x", "INTERNATIONAL"), ("Vietnam", "Hanoi", "MAJOR_CITY"),
              ("Vietnam", "Ho Chi Minh", "MAJOR_CITY"), ("Vietnam", "Da Nang", "OTHER"),
              ("usa", "x", "OTHER"), ("Japan", "Hanoi", "OTHER"), (None, None, "OTHER")]
    df = spark.createDataFrame([p[:2] for p in places], "country string, city string")
    got = [r.customer_segment for r in quality.with_segment(df).collect()]
    assert got == [p[2] for p in places]


def test_summary_counts_every_row(spark):
    sales = quality.validate_sales(staged(spark, S.STAGING_SALES, [c for c, _ in SALE_CASES]))
    empty = spark.createDataFrame([], S.STAGING_CUSTOMERS)
    summary = quality.quality_summary(sales, empty, empty).collect()
    assert sum(r.row_count for r in summary) == len(SALE_CASES)
    counts = {r.outcome: r.row_count for r in summary}
    assert counts["Valid"] == sum(e is None for _, e in SALE_CASES)
