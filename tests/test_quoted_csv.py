"""CSV files with line breaks inside quotes, in many splits."""

from __future__ import annotations

import random

import pytest

from starloom import schemas as S
from starloom.session import Scratch
from starloom.sources import csv_files, quoted_csv

NAMES = ["plain", 'a "quoted" one', "two\nlines", 'x\n\ny, "z"\n', "end\n", '"\n"', " pad ",
         "crlf\r\nhere", None, "comma, too"]
COLUMNS = S.CUSTOMERS_FILE.fieldNames()


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def customers(names):
    return [(f"C{i:04d}", name, f"u{i}@x.test", f"0{i}", "1 road\nback" if i % 50 == 0 else "r",
             "city", "land", None) for i, name in enumerate(names)]


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, str(x)) for x in r])


def test_records_are_those_written(spark, tmp_path, small_splits):
    rng = random.Random(4)
    rows = customers([rng.choice(NAMES) for _ in range(300)]
                     + ["long\n" + "word\n" * 900 + "end"] + ["plain"] * 200)
    files = str(tmp_path / "files")
    csv_files.write_rows(spark.createDataFrame(rows, S.CUSTOMERS_FILE).coalesce(2), files)
    lines = quoted_csv.marked_lines(spark, [files])
    assert lines.select("file_name", "_split_start").distinct().count() > 10
    assert lines.rdd.getNumPartitions() > 10  # several tasks for each file
    found = quoted_csv.read_records(spark, [files], S.CUSTOMERS_FILE, Scratch(spark, str(tmp_path / "s")))
    assert found.where(f"{csv_files.CORRUPT} IS NOT NULL").count() == 0
    assert sorted_rows(found.select(*COLUMNS).collect()) == sorted_rows(rows)
    whole = csv_files.read_rows(spark, [files], S.CUSTOMERS_FILE, True).select(*COLUMNS)
    assert sorted_rows(whole.collect()) == sorted_rows(rows)


def test_rows_keep_the_order_of_the_file(spark, tmp_path, small_splits):
    text = ",".join(COLUMNS) + "\r\n" + "".join(
        f'C{i:04d},"n{i}{chr(10) if i % 7 == 0 else ""}",,,,,,\r\n' + ("\r\n" if i % 90 == 0 else "")
        for i in range(600))
    (tmp_path / "one.csv").write_bytes(text.encode())
    found = quoted_csv.read_records(spark, [str(tmp_path / "one.csv")], S.CUSTOMERS_FILE,
                                    Scratch(spark, str(tmp_path / "s")))
    rows = found.orderBy("_split_start", "_spot").collect()
    assert [r.customer_id for r in rows] == [f"C{i:04d}" for i in range(600)]
    assert {r.customer_name for r in rows} == {
        f"n{i}" + ("\n" if i % 7 == 0 else "") for i in range(600)}
    spots = {}
    for r in rows:  # numbers count up without gaps within a split
        last = spots.setdefault(r["_split_start"], r["_spot"] - 1)
        assert r["_spot"] == last + 1
        spots[r["_split_start"]] = r["_spot"]
    assert len(spots) > 3


def test_a_quote_that_is_never_closed_spoils_no_row_before_it(spark, tmp_path):
    text = ",".join(COLUMNS) + '\nC1,"a\nb",,,,,,\nC2,"open,,,,,,\nC3,c,,,,,,\nC4,d,,,,,,\n'
    (tmp_path / "open.csv").write_text(text)
    found = quoted_csv.read_records(spark, [str(tmp_path / "open.csv")], S.CUSTOMERS_FILE,
                                    Scratch(spark, str(tmp_path / "s"))).collect()
    assert [(r.customer_id, r.customer_name) for r in found if r.customer_id != "C2"] == [
        ("C1", "a\nb"), ("C3", "c"), ("C4", "d")]
    assert [r[csv_files.CORRUPT] is not None for r in found if r.customer_id == "C2"] == [True]


def test_a_wrong_header_is_refused(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("customer_id,other\nC1,x\n")
    with pytest.raises(ValueError, match="header of bad.csv"):
        quoted_csv.read_records(spark, [str(tmp_path / "bad.csv")], S.CUSTOMERS_FILE,
                                Scratch(spark, str(tmp_path / "s")))


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text(",".join(COLUMNS) + "\n")
    paths = [str(tmp_path / n) for n in ("empty.csv", "head.csv")]
    found = quoted_csv.read_records(spark, paths, S.CUSTOMERS_FILE, Scratch(spark, str(tmp_path / "s")))
    assert found.count() == 0
