"""Keys of loaded sales: filters rule out loads, buckets hold the rest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import loaded_keys
from starloom.session import Scratch
from test_pipeline import COUNT, DAY2, HEADER, SALES, Site

SCHEMA = "order_id string, product_id string"


def keys(spark, prefix, numbers):
    return spark.createDataFrame([(f"{prefix}{i:06d}", f"P{i % 7}") for i in numbers], SCHEMA)


def store(spark, root, run, frame):
    loaded_keys.write_keys(frame, f"{root}/keys/load_run={run}")
    loaded_keys.write_filter(frame, frame.count(), f"{root}/filters/load_run={run}")


def filters(spark, root):
    return spark.read.schema(loaded_keys.FILTER_SCHEMA).option(
        "basePath", f"{root}/filters").parquet(f"{root}/filters")


def levels(frame):
    return [r.level for r in frame.select("level").distinct().collect()]


def test_a_filter_holds_all_its_keys_and_few_others(spark, tmp_path):
    stored = keys(spark, "O", range(0, 40_000, 2)).repartition(4)
    store(spark, str(tmp_path), 1, stored)
    found = filters(spark, str(tmp_path))
    assert levels(found) == [loaded_keys.level(20_000)] and found.count() == 8
    # Keys between the stored ones, so that ranges alone tell nothing.
    wanted = stored.limit(3000).unionByName(keys(spark, "O", range(1, 40_000, 2)))
    number = F.col("load_run")
    passed = loaded_keys.may_hold(wanted, found, levels(found))
    assert {r.load_run for r in passed.collect()} == {1}
    bits = found.agg(F.sum(F.bitmap_count("bitmap"))).first()[0]
    assert 0.7 * 20_000 * loaded_keys.PROBES < bits <= 20_000 * loaded_keys.PROBES
    alone = loaded_keys.may_hold(keys(spark, "O", [1, 3, 5]), found, levels(found))
    assert alone.where(number == 1).count() <= 1


def test_every_stored_key_is_found_in_its_run_and_bucket(spark, tmp_path):
    root, runs = str(tmp_path), {1: range(50), 2: range(40, 9000), 5: range(20_000, 20_010), 6: ()}
    for run, numbers in runs.items():
        store(spark, root, run, keys(spark, "O", numbers))
    wanted = keys(spark, "O", [*range(30, 60), 8999, 15_000, 20_003, 30_000])
    found = filters(spark, root)
    places = [tuple(r) for r in loaded_keys.may_hold(wanted, found, levels(found)).collect()]
    stored = spark.read.schema(loaded_keys.KEYS_SCHEMA).option(
        "basePath", f"{root}/keys").parquet(f"{root}/keys")
    got = loaded_keys.found(stored.where(loaded_keys.selected(places)), wanted).collect()
    assert sorted(r.order_id for r in got) == [
        f"O{i:06d}" for i in [*range(30, 60), 8999, 20_003]]
    assert 6 not in {run for run, _ in places}


def test_keys_without_a_part_are_none(spark):
    frame = spark.createDataFrame([("a", None), (None, "p"), ("a", "p"), ("a", "p")], SCHEMA)
    assert [tuple(r) for r in loaded_keys.keys_of(frame).collect()] == [("a", "p")]


def files_read(frame):
    return {f.split("load_run=")[1].split("/")[0] for f in frame.inputFiles() if "load_run=" in f}


def test_a_load_opens_only_runs_that_may_hold_its_keys(spark, tmp_path):
    site = Site(spark, tmp_path).mini()
    site.full()
    site.put(sales_2=HEADER + "".join(
        f"Z-{i:03d},2023-05-0{i % 9 + 1},K-ada,P-comb,1,2.50,2.50\n" for i in range(50)))
    site.incremental(DAY2)
    warehouse = site.warehouse
    runs = [run for run, _ in warehouse._fact_runs()]
    assert len(runs) == 2
    offered = spark.createDataFrame([("Z-007", "P-comb"), ("Z-999", "P-comb")], SCHEMA)
    loaded = warehouse.loaded_keys(offered, runs, Scratch(spark, str(tmp_path / "s")))
    assert [tuple(r) for r in loaded.collect()] == [("Z-007", "P-comb")]
    assert files_read(loaded) == {str(runs[1])}
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "fact_sales" not in plan and "PartitionFilters" in plan
    nothing = spark.createDataFrame([("A-1", "P-comb")], SCHEMA)
    assert warehouse.loaded_keys(nothing, runs, Scratch(spark, str(tmp_path / "s"))).count() == 0
    # Sent again, nothing is added, whichever run holds it.
    site.put(sales_3=SALES + "Z-050,2023-05-05,K-ada,P-comb,1,2.50,2.50\n")
    site.incremental(DAY2 + dt.timedelta(days=1))
    assert len(site.loaded()) == COUNT + 51
    site.sound()


def test_keys_travel_to_large_filters_without_their_spots(spark, tmp_path):
    store(spark, str(tmp_path), 1, keys(spark, "O", range(20_000)))
    found = filters(spark, str(tmp_path))
    passed = loaded_keys.may_hold(keys(spark, "O", [1, 3]), found.hint("merge"), levels(found))
    plan = passed._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "hashpartitioning(level" in line]
    assert len(sent) == 2 and passed.count() == 2
    assert "spot" not in plan.split("SortMergeJoin")[1].split("hashpartitioning(level")[1]
