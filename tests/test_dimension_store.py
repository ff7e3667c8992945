"""A stored dimension changes by delta and reads as a whole merge would give it."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.operators.dimensions import CUSTOMER, scd2_merge
from starloom.plans import dimension_store as store
from test_dimensions import check_invariant, people, versions

DAY = dt.date(2024, 3, 1)


def later(days):
    return DAY + dt.timedelta(days=days)


def crowd(**changes):
    return [{"customer_id": f"K{i:02d}", "city": "Ghent", **changes.get(f"K{i:02d}", {})}
            for i in range(40)]


class Stored:
    def __init__(self, spark, path, scratch, buckets=8):
        self.spark, self.path, self.scratch, self.buckets = spark, path, scratch, buckets
        self.parts, self.loads = None, 0

    def merge(self, rows, as_of):
        self.loads += 1
        folder = f"{self.path}/run-{self.loads}"
        count = store.merge(self.parts, rows, CUSTOMER, as_of, folder, self.scratch, self.buckets)
        self.parts = store.read_parts(self.spark, folder)
        return count

    @property
    def frame(self):
        return store.read_versions(self.spark, self.parts.paths, CUSTOMER)

    def written(self, load):
        """Folders of versions that a load wrote."""
        root = Path(f"{self.path}/run-{load}")
        return sorted(str(p.parent.relative_to(root)) for p in root.rglob("part-*.parquet")
                      if "manifest" not in str(p))


@pytest.fixture
def stored(spark, tmp_path, scratch):
    return Stored(spark, tmp_path, scratch)


def test_loads_equal_whole_merges(spark, stored, scratch):
    batches = [
        (crowd(), 0), (crowd(K03={"city": "Accra"}, K20={"phone": "9"}), 1),
        ([{"customer_id": "K03", "city": "Haifa"}, {"customer_id": "K99"}], 1),  # the same day
        ([{"customer_id": "K03", "city": "Cork"}], 0),  # late: older than the current version
        ([{"customer_id": "K20", "phone": None}, {"customer_id": "K20", "phone": "8"}], 4),
    ]
    whole = None
    for rows, day in batches:
        frame = people(spark, *rows)
        whole = scratch.keep(scd2_merge(whole, frame, CUSTOMER, later(day), scratch), "whole")
        stored.merge(frame, later(day))
        assert versions(stored.frame) == versions(whole)
        assert sorted(map(str, stored.frame.collect())) == sorted(map(str, whole.collect()))
        check_invariant(stored.frame)
    assert stored.parts.last_key == whole.agg(F.max("customer_key")).first()[0]


def test_a_batch_of_one_row_writes_one_bucket(spark, stored):
    stored.merge(people(spark, *crowd()), DAY)
    assert len({p for p in stored.written(1)}) == len(stored.parts.current) > 4
    before = dict(stored.parts.current)
    assert stored.merge(people(spark, {"customer_id": "K07", "city": "Oslo"}), later(1)) == 1
    current = [p for p in stored.written(2) if p.startswith("current")]
    assert len(current) == 1 and [p for p in stored.written(2) if p == "history"] == ["history"]
    changed = [b for b in before if stored.parts.current[b] != before[b]]
    assert len(changed) == 1


def test_a_batch_without_changes_writes_no_versions(spark, stored):
    stored.merge(people(spark, *crowd()), DAY)
    before = versions(stored.frame)
    assert stored.merge(people(spark, *crowd()), later(1)) == 0
    assert stored.written(2) == [] and versions(stored.frame) == before
    assert stored.merge(people(spark, {"customer_id": None}), later(2)) == 0


def test_history_parts_are_written_together(spark, stored, monkeypatch):
    monkeypatch.setattr(store, "HISTORY_PARTS", 2)
    stored.merge(people(spark, {"customer_id": "A"}), DAY)
    for i in range(1, 6):
        stored.merge(people(spark, {"customer_id": "A", "city": f"c{i}"}), later(i))
        assert len(stored.parts.history) <= 2
    assert len(versions(stored.frame)) == 6
    check_invariant(stored.frame)


def test_an_empty_first_batch(spark, stored):
    assert stored.merge(people(spark, {"customer_id": None}), DAY) == 0
    assert stored.frame.count() == 0
    stored.merge(people(spark, {"customer_id": "A"}), later(1))
    assert [v[0] for v in versions(stored.frame)] == ["A"]
