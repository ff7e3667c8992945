from __future__ import annotations

import random

from pyspark.sql import functions as F

from starloom.operators import dedup

SCHEMA = ("staging_id long, order_id string, product_id string, quantity int, "
          "processed_flag boolean, error_message string")


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, o, p, i, ok, None if ok else "bad") for i, (o, p, ok) in enumerate(rows, 1)], SCHEMA)


def brute_force(rows):
    """Ids that stay: a valid row goes when a later row has the same complete key."""
    stay = set()
    for i, (o, p, ok) in enumerate(rows):
        later = o is not None and p is not None and any((a, b) == (o, p) for a, b, _ in rows[i + 1:])
        if not (ok and later):
            stay.add(i + 1)
    return stay


CASES = [
    [("O", "P", True), ("O", "P", True)],
    [("O", "P", True), ("O", "P", False)],
    [("O", "P", False), ("O", "P", True)],
    [(None, "P", True), (None, "P", True)],
    [("O", None, True), ("O", None, True)],
    [("O", "P", True), ("O", "Q", True)],
]


def ids(df):
    got = [r.staging_id for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_cases(spark):
    for rows in CASES:
        assert ids(dedup.dedup_sales(frame(spark, rows))) == brute_force(rows), rows


def test_random_rows_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["A", "B", "C", None]), rng.choice(["X", "Y", "Z", None]),
             rng.random() < 0.7) for _ in range(300)]
    df = frame(spark, rows)
    assert ids(dedup.dedup_sales(df)) == brute_force(rows)
    loadable = {i for i in brute_force(rows) if rows[i - 1][2]}
    assert ids(dedup.latest_valid_sales(df)) == loadable


def test_survivors_keep_their_columns(spark):
    rows = [("O", "P", True)] * 3
    kept = dedup.dedup_sales(frame(spark, rows)).collect()
    assert [(r.staging_id, r.quantity, r.processed_flag, r.error_message) for r in kept] == [
        (3, 3, True, None)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(20000).select(
        F.col("id").alias("staging_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.lit("P").alias("product_id"), F.lit(True).alias("processed_flag"),
        F.lit(None).cast("string").alias("error_message"))
    result = dedup.latest_valid_sales(hot)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
    assert result.count() == 20000 - 6667 + 1
    assert result.where("order_id = 'HOT'").first().staging_id == 19998


def test_rows_are_not_shuffled_for_few_repeated_keys(spark, scratch):
    """Stored first, few repeated keys are broadcast; without, both sides were shuffled."""
    rows = [(f"O{i % 990}", "P", True) for i in range(1000)]
    df = scratch.keep(frame(spark, rows), "staged")
    kept = dedup.latest_valid_sales(df, scratch)
    assert ids(kept) == brute_force(rows)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_carried_sales_are_replaced_by_any_newer_row_of_their_key(spark):
    """Valid or not; a row without a key replaces nothing. Two loads equal one frame."""
    old = [("O", "P", True), ("O", "Q", True), ("R", "P", True), (None, "P", True)]
    new = [("O", "P", False), ("R", "P", True), (None, "P", True)]
    both = frame(spark, old + new)
    staged = both.where(F.col("staging_id") > len(old))
    carried = both.where(F.col("staging_id") <= len(old))
    found = dedup.latest_valid_sales(staged).unionByName(dedup.latest_carried(carried, staged))
    assert ids(found) == ids(dedup.latest_valid_sales(both)) == {2, 4, 6, 7}
