"""Daily aggregate table: per day, per day and customer, per day and product."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.columns import month_of_key
from starloom.schemas import PRICE
from starloom.session import Scratch

#: Lines of a slice of days, about, and of a day that is cut.
LINES, BUSY = 1 << 20, 1 << 22

# Grain numbers inside agg_key.
DAY, DAY_CUSTOMER, DAY_PRODUCT = 0, 1, 2
COLUMNS = ("date_key", "customer_key", "product_key", "total_quantity", "total_amount",
           "avg_unit_price", "order_count", "unique_customers")


def _null_key(name: str) -> Column:
    return F.lit(None).cast("long").alias(name)


def _cents(name: str) -> Column:
    return (F.col(name) * 100).cast("long")


def _amount(cents: str, kind: str) -> Column:
    return (F.col(cents).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(kind)


def _sums(*, stored: bool) -> list[Column]:
    """Additive parts, from fact rows or from rows that hold such parts already. Money is summed
    in whole cents, which take a third of the room of a wide decimal in a shuffle; a sum beyond
    a long fails, and none is cut."""
    lines = F.sum("lines") if stored else F.count("unit_price")
    amount, price = ("amount", "price") if stored else map(
        _cents, ("total_amount", "unit_price"))
    return [F.sum("quantity").alias("quantity"), F.sum(amount).alias("amount"),
            F.sum(price).alias("price"), lines.alias("lines")]


def _finish(parts: DataFrame, customer: Column, product: Column, orders: Column,
            customers: Column) -> DataFrame:
    return parts.select(
        "date_key", customer, product,
        F.col("quantity").cast("long").alias("total_quantity"),
        _amount("amount", "decimal(22,2)").alias("total_amount"),
        (_amount("price", "decimal(30,2)") / F.col("lines")).cast(PRICE).alias("avg_unit_price"),
        orders.cast("long").alias("order_count"),
        customers.cast("long").alias("unique_customers"),
    )


def daily_aggregates(fact: DataFrame) -> DataFrame:
    """The three grains by stepwise roll-up.

    Each grain is rolled up from a finer one: lines to orders to customers to days, and
    lines to product customers to products. Distinct counts become plain counts of finer
    groups, so nothing is expanded per distinct column, and every step combines map-side
    before it shuffles, which also reduces hot days, customers and products. An order shared
    by several customers counts once per day: days are counted over (day, order).

    Days and customers read the same exchange. For Spark to see that, both have to use the
    same columns of it, hence the bound on the day's orders, and the join must not filter
    the day side, hence a left join.
    """
    lines = fact.select("date_key", "customer_key", "product_key", "order_id", "quantity",
                        "total_amount", "unit_price")
    orders = lines.groupBy("date_key", "customer_key", "order_id").agg(*_sums(stored=False))
    customers = orders.groupBy("date_key", "customer_key").agg(
        *_sums(stored=True), F.count(F.lit(1)).alias("orders")
    )
    day_sums = customers.groupBy("date_key").agg(
        *_sums(stored=True), F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("bound")
    )
    day_orders = lines.groupBy("date_key").agg(F.count_distinct("order_id").alias("orders"))
    days = day_sums.join(day_orders, "date_key", "left")
    # A fact row is unique by (order, product): within a product, rows are orders.
    product_customers = lines.groupBy("date_key", "product_key", "customer_key").agg(
        *_sums(stored=False), F.count(F.lit(1)).alias("orders")
    )
    products = product_customers.groupBy("date_key", "product_key").agg(
        *_sums(stored=True), F.sum("orders").alias("orders"),
        F.count(F.lit(1)).alias("customers"),
    )
    return _grains(days, F.least("orders", "bound"), customers, products)


def _grains(days: DataFrame, day_orders: Column, customers: DataFrame, products: DataFrame
            ) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        _finish(days, _null_key("customer_key"), _null_key("product_key"), day_orders,
                F.col("customers")),
        _finish(customers, F.col("customer_key"), _null_key("product_key"),
                F.col("orders"), F.lit(1)),
        _finish(products, _null_key("customer_key"), F.col("product_key"),
                F.col("orders"), F.col("customers")),
    ])


def daily_by_slices(fact: DataFrame, scratch: Scratch) -> DataFrame:
    """The same table by one shuffle of narrow lines, for facts that are stored.

    The days of a month are put together in slices of about ``LINES`` lines, from their counts,
    and every grain is rolled up where its slice lies. So a line travels once, the rows of all
    grains not at all, and a month still gets few files. A day with ``BUSY`` lines or more is left to
    :func:`daily_aggregates`, which reduces it before each shuffle and cuts it.

    All grains start from the same aggregate, which needs all columns of the lines, so Spark
    shuffles them once. Only the orders of a day, which map tasks reduce well, go their own way.
    """
    month, lines = F.col("order_month"), F.col("_lines")
    earlier = Window.partitionBy(month).orderBy("date_key").rowsBetween(
        Window.unboundedPreceding, -1)
    # At most the days of the calendar.
    days = scratch.keep(
        fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("_lines"))
        .withColumn("order_month", month_of_key(F.col("date_key")))
        .withColumn("_slice", F.when(lines < BUSY, F.floor(
            F.coalesce(F.sum(lines).over(earlier), F.lit(0)) / LINES))),
        "days")
    busy = days.where("_slice IS NULL").select("date_key")
    quiet = days.where("_slice IS NOT NULL").select("date_key", "order_month", "_slice")
    place = ("order_month", "_slice", "date_key")
    dealt = fact.select(
        "date_key", "customer_key", "product_key", "order_id", "quantity", "total_amount",
        "unit_price").join(F.broadcast(quiet), "date_key").repartition("order_month", "_slice")
    parts = dealt.groupBy(*place, "customer_key", "product_key", "order_id").agg(
        *_sums(stored=False))
    customers = parts.groupBy(*place, "customer_key", "order_id").agg(*_sums(stored=True)).groupBy(
        *place, "customer_key").agg(*_sums(stored=True), F.count(F.lit(1)).alias("orders"))
    day_orders = fact.join(F.broadcast(quiet.select("date_key")), "date_key").groupBy(
        "date_key").agg(F.count_distinct("order_id").alias("orders"))
    day_sums = customers.groupBy(*place).agg(
        *_sums(stored=True), F.count(F.lit(1)).alias("customers"))
    # A fact row is unique by (order, product): within a product, rows are orders.
    products = parts.groupBy(*place, "product_key", "customer_key").agg(
        *_sums(stored=True), F.count(F.lit(1)).alias("orders")).groupBy(
        *place, "product_key").agg(
        *_sums(stored=True), F.sum("orders").alias("orders"),
        F.count(F.lit(1)).alias("customers"))
    made = _grains(day_sums.join(day_orders, "date_key", "left"), F.col("orders"), customers,
                   products)
    if not busy.head(1):
        return made
    # Gather each month into few files; AQE splits a busy month over tasks.
    rest = daily_aggregates(fact.join(F.broadcast(busy), "date_key", "left_semi"))
    return made.unionByName(rest.withColumn("_month", month_of_key(F.col("date_key"))).hint(
        "rebalance", F.col("_month")).drop("_month"))


def _direct_measures() -> list[Column]:
    return [
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_amount").cast("decimal(22,2)").alias("total_amount"),
        F.avg("unit_price").cast(PRICE).alias("avg_unit_price"),
        F.count_distinct("order_id").alias("order_count"),
    ]


def daily_by_union(fact: DataFrame) -> DataFrame:
    """The same table as three separate aggregations put together."""
    customers = F.count_distinct("customer_key").alias("unique_customers")
    one = F.lit(1).cast("long").alias("unique_customers")
    days = fact.groupBy("date_key").agg(*_direct_measures(), customers)
    by_customer = fact.groupBy("date_key", "customer_key").agg(*_direct_measures())
    by_product = fact.groupBy("date_key", "product_key").agg(*_direct_measures(), customers)
    return (
        days.withColumns({"customer_key": F.lit(None).cast("long"),
                          "product_key": F.lit(None).cast("long")})
        .unionByName(by_customer.withColumn("product_key", F.lit(None).cast("long"))
                     .withColumn("unique_customers", one))
        .unionByName(by_product.withColumn("customer_key", F.lit(None).cast("long")))
        .select(*COLUMNS)
    )


def daily_by_grouping_sets(fact: DataFrame) -> DataFrame:
    """The same table as two GROUPING SETS aggregations.

    Each holds one distinct count: two in one would copy the rows of every set once per distinct
    column. Orders are counted by day and customer. Customers are counted by day and product,
    where rows are orders. Only days, one row each, need both.
    """
    day, customer, product = (F.col(n) for n in ("date_key", "customer_key", "product_key"))
    lines = fact.select("date_key", "customer_key", "product_key", "order_id", "quantity",
                        "total_amount", "unit_price", customer.alias("buyer"))
    sold = lines.groupingSets([[day], [day, customer]], day, customer).agg(
        *_sums(stored=False), F.count_distinct("order_id").alias("orders"))
    bought = lines.groupingSets([[day], [day, product]], day, product).agg(
        *_sums(stored=False), F.count(F.lit(1)).alias("orders"),
        F.count_distinct("buyer").alias("customers"))
    buyers = bought.where(product.isNull()).select("date_key", "customers")
    days = sold.where(customer.isNull()).join(buyers, "date_key")
    return reduce(DataFrame.unionByName, [
        _finish(days, _null_key("customer_key"), _null_key("product_key"), F.col("orders"),
                F.col("customers")),
        _finish(sold.where(customer.isNotNull()), F.col("customer_key"),
                _null_key("product_key"), F.col("orders"), F.lit(1)),
        _finish(bought.where(product.isNotNull()), _null_key("customer_key"),
                F.col("product_key"), F.col("orders"), F.col("customers")),
    ]).select(*COLUMNS)


def with_agg_key(daily: DataFrame) -> DataFrame:
    """Add a unique key made of day, grain and member key.

    It depends on the row alone: recomputed days keep their keys and no numbering pass is
    needed. 25 bits hold the day, 2 the grain, 36 the member key.
    """
    grain = (
        F.when(F.col("customer_key").isNotNull(), DAY_CUSTOMER)
        .when(F.col("product_key").isNotNull(), DAY_PRODUCT).otherwise(DAY)
    )
    member = F.coalesce("customer_key", "product_key", F.lit(0))
    key = (F.shiftleft(F.col("date_key").cast("long"), 38)
           + F.shiftleft(grain.cast("long"), 36) + member)
    return daily.select(key.alias("agg_key"), *COLUMNS)
