from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.numbering import number_stored, slice_rows, spread_ranks, with_row_ids
from starloom.sources import retail_tables


def test_numbers_are_dense_and_ordered(spark, scratch):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"))
    rows = with_row_ids(df, [F.col("v")], "n", scratch, start=100).orderBy("n").collect()
    assert [r.n for r in rows] == list(range(101, 5101))
    assert [r.v for r in rows] == sorted(r.v for r in rows)


def test_no_row_and_one_row(spark, scratch):
    none = spark.range(0).select(F.col("id").alias("v"))
    assert with_row_ids(none, [F.col("v")], "n", scratch).count() == 0
    one = with_row_ids(spark.range(1), [F.col("id")], "n", scratch).first()
    assert one.n == 1


def test_a_hot_first_column_is_split(spark, scratch):
    df = spark.range(9000).select(F.lit("HOT").alias("k"), F.col("id").alias("i"))
    path_rows = with_row_ids(df, [F.col("k"), F.col("i")], "n", scratch)
    assert path_rows.agg(F.count_distinct("n"), F.max("n")).first() == (9000, 9000)
    assert path_rows.where("n <> i + 1").count() == 0


def test_numbers_stay_the_same_on_every_read(spark, scratch):
    df = spark.range(1000).select(F.rand(3).alias("v"), "id")
    numbered = with_row_ids(df, [F.col("v")], "n", scratch)
    assert numbered.orderBy("id").collect() == numbered.orderBy("id").collect()


def test_spread_ranks_equal_the_window(spark, scratch):
    rng = random.Random(5)
    values = [rng.choice([1, 2, 2, 2, 3, 50, None]) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(values)), "key long, v int")
    spread = spread_ranks(scratch.keep(df, "ranked"), {"r": "v"}, scratch, "key")
    expected = df.withColumn("r", F.rank().over(Window.orderBy(F.desc_nulls_last("v"))).cast("long"))
    want = sorted(tuple(r) for r in expected.select("key", "r").collect())
    assert sorted(tuple(r) for r in spread.select("key", "r").collect()) == want


def test_offsets_add_up_over_blocks_of_slices(spark, scratch):
    """More slices than a block holds, with gaps, and files as blocks."""
    slices = spark.range(3000).select((F.col("id") * 3).cast("long").alias("_slice"))
    rows = scratch.keep(slices.withColumn("_place", F.explode(F.array(F.lit(5), F.lit(6)))), "r")
    got = number_stored(rows.withColumn("k", F.col("_slice") * 10 + F.col("_place")), "n", scratch)
    assert [r.n for r in got.orderBy("k").collect()] == list(range(1, 6001))
    files = scratch.keep(spark.range(400).select(
        F.concat(F.lit("f"), F.col("id") % 7).alias("f"), F.floor(F.col("id") / 50).alias("s"),
        F.col("id").alias("p")), "files")
    found = number_stored(files.withColumns({"f2": F.col("f"), "s2": F.col("s"), "p2": F.col("p")}),
                          "n", scratch, 10, ("f", "s"), "p").collect()
    assert sorted(r.n for r in found) != [] and len(found) == 400


def test_slice_starts_are_not_hinted(spark, scratch):
    rows = scratch.keep(spark.range(10).select(F.lit(0).cast("long").alias("_slice"),
                                               F.col("id").alias("_place")), "r")
    logical = number_stored(rows, "n", scratch)._jdf.queryExecution().logical().toString()
    assert "UnresolvedHint" not in logical and "ResolvedHint" not in logical


def test_orders_meet_their_lines_in_the_shuffle_that_sorts_them(spark, tmp_path):
    """An inner join by one shuffle: lines without an order, orders without lines or sent twice, and
    missing keys."""
    rng = random.Random(3)
    lines = [(rng.choice([None, *range(40)]), rng.randrange(9), rng.randrange(1, 8), 2.0,
              rng.randrange(900) / 4, "2024-01-01") for _ in range(400)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
                                 "l_extendedprice double, l_shipdate string").selectExpr(
        "*", "1L AS l_suppkey", "0.1D AS l_discount", "0.0D AS l_tax").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    orders = [(k, rng.randrange(5), f"2024-02-0{k % 9 + 1} 00:00:00") for k in range(10, 60)]
    orders += [(12, 77, None), (13, None, "2024-02-01 00:00:00"), (None, 1, "2024-02-01 00:00:00")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp")).write.parquet(
        str(tmp_path / "orders.parquet"))
    sliced = slice_rows(retail_tables.sales_lines(spark, str(tmp_path)),
                        [F.col(n) for n in retail_tables.SALES_ORDER],
                        [F.col(n) for n in retail_tables.SALES_KEY], retail_tables.with_orders)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sorted(sliced.collect(), key=lambda r: (r["_slice"], r["_place"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["_slice"] for r in found}) > 1
    expected = [(k, n, p, price, c, str(d)[:10] if d else None) for k, p, n, _, price, _ in lines
                for o, c, d in orders if k is not None and k == o]
    of = lambda r: (r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_extendedprice)
    assert sorted(map(str, expected)) == sorted(str((
        *of(r), r.o_custkey, str(r.order_date) if r.order_date else None)) for r in found)
    assert [of(r) for r in found] == sorted(of(r) for r in found)
    for number in {r["_slice"] for r in found}:
        places = [r["_place"] for r in found if r["_slice"] == number]
        assert places == list(range(len(places)))
    plan = sliced._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and "Join" not in plan
