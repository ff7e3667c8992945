"""Cleaning and validation of staged rows.

Every function only adds or replaces columns, so a whole cleaning chain stays one narrow
stage without a shuffle. Rejected rows stay in the frame with ``error_message`` set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions.columns import capitalise_first, customer_segment


def first_match(rules: list[tuple[Column, str]]) -> Column:
    """Text of the first rule that holds, NULL if none does."""
    return F.coalesce(*[F.when(condition, F.lit(text)) for condition, text in rules])


def _any_null(names: tuple[str, ...]) -> Column:
    return reduce(lambda left, right: left | right, [F.col(name).isNull() for name in names])


def _judge(staged: DataFrame, rules: list[tuple[Column, str]], needed: tuple[str, ...],
           null_is_error: bool) -> DataFrame:
    """Judge rows that are open; finished rows and earlier errors are left as they are."""
    if null_is_error:
        rules = [(_any_null(needed), S.MISSING_VALUE), *rules]
    open_row = ~F.col("processed_flag") & F.col("error_message").isNull()
    return staged.withColumn(
        "error_message", F.when(open_row, first_match(rules)).otherwise(F.col("error_message"))
    ).withColumn("processed_flag", F.col("processed_flag") | F.col("error_message").isNull())


def _replace_open(staged: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return staged.withColumns(
        {name: F.when(F.col("processed_flag"), F.col(name)).otherwise(new)
         for name, new in changes.items()}
    )


def validate_sales(staged: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    """Apply the sales rules in order. A comparison with NULL holds for no rule."""
    quantity, price, total, day = (
        F.col(name) for name in ("quantity", "unit_price", "total_amount", "order_date")
    )
    product = quantity * price
    if rules.tolerance:
        mismatch = F.abs(total - product) > F.lit(rules.tolerance)
    else:
        mismatch = total != product
    checks = [
        (quantity < rules.min_quantity, S.QUANTITY_LOW),
        (quantity > rules.max_quantity, S.QUANTITY_HIGH),
        (price < F.lit(rules.min_unit_price), S.PRICE_LOW),
        (price > F.lit(rules.max_unit_price), S.PRICE_HIGH),
        (mismatch, S.TOTAL_MISMATCH),
        (~day.between(F.lit(rules.start_date), F.lit(rules.end_date)), S.DATE_OUTSIDE),
    ]
    needed = ("quantity", "unit_price", "total_amount", "order_date")
    return _judge(staged, checks, needed, rules.null_is_error)


def standardise_customers(staged: DataFrame) -> DataFrame:
    trimmed = {name: F.trim(F.col(name))
               for name in ("customer_name", "phone", "address", "city", "country")}
    return _replace_open(staged, {**trimmed, "email": F.lower(F.trim(F.col("email")))})


def validate_customers(staged: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    checks = [(~F.col("email").like("%@%.%"), S.EMAIL_INVALID)]
    return _judge(staged, checks, ("email",), rules.null_is_error)


def clean_customers(staged: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    return validate_customers(standardise_customers(staged), rules)


def standardise_products(staged: DataFrame) -> DataFrame:
    return _replace_open(staged, {
        "product_name": F.trim(F.col("product_name")),
        "category": F.upper(F.trim(F.col("category"))),
        "subcategory": capitalise_first(F.trim(F.col("subcategory"))),
        "supplier": F.trim(F.col("supplier")),
    })


def validate_products(staged: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    cost, msrp = F.col("cost_price"), F.col("msrp")
    checks = [(cost <= 0, S.COST_INVALID), (msrp <= 0, S.MSRP_INVALID), (msrp < cost, S.MSRP_LOW)]
    return _judge(staged, checks, ("cost_price", "msrp"), rules.null_is_error)


def clean_products(staged: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    return validate_products(standardise_products(staged), rules)


def valid_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("processed_flag") & F.col("error_message").isNull())


def with_segment(customers: DataFrame, rules: S.Rules = S.Rules()) -> DataFrame:
    return customers.withColumn(
        "customer_segment", customer_segment(F.col("country"), F.col("city"), rules)
    )


def quality_summary(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Rows per staged table and outcome; the partial counts leave few rows to shuffle."""
    parts = [
        frame.groupBy(F.lit(name).alias("table_name"),
                      F.coalesce("error_message", F.lit("Valid")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        for name, frame in (("sales", sales), ("customers", customers), ("products", products))
    ]
    return reduce(DataFrame.unionByName, parts)
