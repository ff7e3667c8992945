"""Source rows from order tables (lineitem, orders, customer, nation, region, part).

Money arrives as binary floating point there; it is turned into whole cents once, and all
later arithmetic is decimal.
"""

from __future__ import annotations

from dataclasses import replace
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.schemas import AMOUNT, PRICE, Rules

RULES = replace(
    Rules(), start_date=dt.date(1995, 1, 1), end_date=dt.date(2001, 6, 30),
    international=("AMERICA", "EUROPE"), home_country="ASIA",
    major_cities=("NATION_2", "NATION_7"),
)
AS_OF = dt.date(2001, 6, 30)
LOAD_TIME = dt.datetime(2001, 6, 30, 2, 0, tzinfo=dt.timezone.utc)

_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
         "l_quantity", "l_shipdate", "l_discount", "l_tax")
# The place in the table's files tells equal rows apart, so that a range of copies can be
# split over tasks. Lines stay with their order, which has few of them.
_PLACE = ("_file", "_row")
SALES_ORDER, SALES_KEY = _LINE, ("l_orderkey",)
CUSTOMERS_ORDER = ("c_custkey", *_PLACE)
PRODUCTS_ORDER = ("p_partkey", *_PLACE)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _placed(table: DataFrame) -> DataFrame:
    return table.select("*", F.col("_metadata.file_name").alias("_file"),
                        F.col("_metadata.row_index").alias("_row"))


def _id(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _from_cents(cents: Column, kind) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(kind)


def sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines, and a row for each order. Both travel once, to the place of the order in
    the sorted lines, where :func:`with_orders` joins them."""
    lines = _table(spark, folder, "lineitem").select(*_LINE, F.lit(False).alias("_is_order"))
    orders = _table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
        F.col("o_orderdate").cast("date").alias("order_date"), F.lit(True).alias("_is_order"),
    )
    return lines.unionByName(orders, allowMissingColumns=True).where("l_orderkey IS NOT NULL")


def with_orders(rows: DataFrame) -> DataFrame:
    """Order lines with customer and date of their order: the inner join of the lines and orders
    in ``rows``, whose rows of one order lie together. It keeps their order."""
    order = F.when(F.col("_is_order"), F.struct("o_custkey", "order_date"))
    orders = F.collect_list(order).over(Window.partitionBy("l_orderkey"))
    return rows.withColumn("_orders", orders).where(~F.col("_is_order")).select(
        *_LINE, F.inline("_orders"))


def as_sales(lines: DataFrame) -> DataFrame:
    units = F.col("l_quantity").cast("int")
    total = F.round(F.col("l_extendedprice") * 100).cast("long")
    # Cents per unit, halves up, in whole numbers.
    unit = F.floor(F.expr("(total_cents * 2 + quantity) div (quantity * 2)"))
    charged = F.when(F.col("l_linenumber") == 7, F.col("total_cents")).otherwise(
        F.col("unit_cents") * F.col("quantity")
    )
    return (
        lines.withColumns({"quantity": units, "total_cents": total})
        .withColumn("unit_cents", unit)
        .select(
            "_slice", "_place",
            _id("ORD", "l_orderkey").alias("order_id"), "order_date",
            _id("CUST", "o_custkey").alias("customer_id"),
            _id("PROD", "l_partkey").alias("product_id"),
            "quantity",
            _from_cents(F.col("unit_cents"), PRICE).alias("unit_price"),
            _from_cents(charged, AMOUNT).alias("total_amount"),
            F.concat(F.lit("sales_"), F.date_format("order_date", "yyyyMM"), F.lit(".csv"))
            .alias("file_name"),
        )
    )


def customer_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the names of their nation and region, two small fixed tables."""
    nation = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        _placed(_table(spark, folder, "customer"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(*CUSTOMERS_ORDER, "c_name", "n_name", "r_name")
    )


def as_customers(lines: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    number = key.cast("string")
    email = F.when(key % 20 == 7, F.concat(F.lit("User"), number, F.lit(".example.com")))
    return lines.select(
        "_slice", "_place",
        _id("CUST", "c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("customer_name"),
        email.otherwise(F.concat(F.lit(" User"), number, F.lit("@Example.com ")))
        .alias("email"),
        F.col("n_name").alias("city"), F.col("r_name").alias("country"),
        F.date_add(F.lit(dt.date(1994, 1, 1)), (key % 2500).cast("int"))
        .alias("registration_date"),
        F.lit("customers.csv").alias("file_name"),
    )


def product_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _placed(_table(spark, folder, "part")).select(
        *PRODUCTS_ORDER, "p_name", "p_type", "p_brand", "p_retailprice"
    )


def as_products(lines: DataFrame) -> DataFrame:
    factor = (F.lit("0.50").cast("decimal(4,2)")
              + F.lit("0.06").cast("decimal(4,2)") * (F.col("p_partkey") % 10).cast("int"))
    msrp = F.col("p_retailprice").cast(PRICE)
    return lines.select(
        "_slice", "_place",
        _id("PROD", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_name").alias("subcategory"), F.col("p_brand").alias("supplier"),
        (msrp * factor.cast("decimal(4,2)")).cast(PRICE).alias("cost_price"),
        msrp.alias("msrp"),
        F.lit("products.csv").alias("file_name"),
    )
