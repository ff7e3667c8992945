"""The ledger as frames: snapshots, consumed inputs, published parts, many processes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.schemas import LEDGER
from starloom.sources.ledger import COMPLETED, FAILED, RUNNING, Ledger, pending_files


def run(ledger, name, source=None, consumed=(), published=None, **result):
    opened = ledger.open(name, [source])
    ledger.close(opened, [result], consumed, published)
    return opened[0]["process_id"]


def told(ledger, names):
    state = sorted((r.process_id, r.process_name, r.status, r.output)
                   for r in ledger.state().collect())
    return (state, *[(ledger.outputs(n), ledger.last_output(n), ledger.last_id(n),
                      ledger.published(n), ledger.total(n, "records_loaded"),
                      sorted(r.source_file for r in ledger.consumed(n).collect()))
                     for n in names])


def fill(ledger):
    run(ledger, "A", "f1", output="a1", records_loaded=2)
    run(ledger, "B", consumed=["a1"], published={"m1": "b/m1", "m2": "b/m2"}, output="b")
    bad = ledger.open("A", ["f2"])
    ledger.fail(bad, ValueError("broken"))
    ledger.open("A", ["f3"])
    run(ledger, "A", "f2", output="a2", records_loaded=5)
    run(ledger, "B", consumed=["a2"], published={"m2": "c/m2"}, output="c")


def test_what_is_told(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert told(ledger, "A") == ([], ([], None, 0, {}, 0, []))
    fill(ledger)
    state, a, b = told(ledger, "AB")
    assert [s[1:3] for s in state] == [("A", COMPLETED), ("B", COMPLETED), ("A", FAILED),
                                       ("A", RUNNING), ("A", COMPLETED), ("B", COMPLETED)]
    assert a == ([("f1", "a1"), ("f2", "a2")], "a2", 5, {}, 7, [])
    assert b == ([(None, "b"), (None, "c")], "c", 6, {"m1": "b/m1", "m2": "c/m2"}, 0, ["a1", "a2"])


@pytest.mark.parametrize("tail", [1, 3, 100])
def test_snapshots_change_nothing(spark, tmp_path, tail):
    plain, short = (Ledger(spark, str(tmp_path / str(n)), n) for n in (1000, tail))
    for ledger in (plain, short):
        fill(ledger)
    assert told(short, "AB") == told(plain, "AB")
    again = Ledger(spark, short.path, tail)  # another writer goes on
    assert told(again, "AB") == told(plain, "AB")
    assert run(again, "A", "f9", output="a9") == 7
    assert again.last_output("A") == "a9" and len(again.state().collect()) == 7


def test_a_snapshot_that_was_not_finished_does_not_count(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    fill(ledger)
    before = told(ledger, "AB")
    ledger.compact()
    (tmp_path / "snapshot" / "generation=0" / "_SUCCESS").unlink()
    assert told(Ledger(spark, str(tmp_path)), "AB") == before
    again = Ledger(spark, str(tmp_path))
    again.compact()
    assert told(again, "AB") == before


def test_many_processes(spark, tmp_path):
    """Ten thousand files, of which one is new: only it comes to the driver."""
    when = dt.datetime(2024, 1, 1)
    filled = {"process_id": F.col("id") + 1, "process_name": F.lit("EXTRACT_SALES"),
              "source_file": F.concat(F.lit("f"), "id"), "records_extracted": F.lit(3),
              "status": F.lit(COMPLETED), "output": F.concat(F.lit("load-"), F.col("id") % 9),
              "event_time": F.lit(when), "end_time": F.lit(when)}
    rows = spark.range(10_000).select(*[
        filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER.fields])
    rows.write.parquet(f"{tmp_path}/log/generation=0")
    ledger = Ledger(spark, str(tmp_path), tail=4)
    assert ledger.total("EXTRACT_SALES", "records_extracted") == 30_000
    files = spark.range(9_990, 10_001).select(F.concat(F.lit("f"), "id").alias("file_name"))
    assert [r.file_name for r in pending_files(files, ledger.state(), "EXTRACT_SALES").collect()
            ] == ["f10000"]
    assert run(ledger, "EXTRACT_SALES", "f10000", output="load-x") == 10_001
    assert run(ledger, "OTHER", output="y") == 10_002
    assert ledger._snapshot() is not None
    assert Ledger(spark, str(tmp_path)).last_id("EXTRACT_SALES") == 10_001
    assert pending_files(files, ledger.state(), "EXTRACT_SALES").count() == 0
