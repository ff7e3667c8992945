from __future__ import annotations

import datetime as dt
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators import facts
from starloom.operators.dimensions import CUSTOMER, PRODUCT
from starloom.operators.numbering import slice_rows
from starloom.plans import pipeline as P
from starloom.plans.pipeline import Warehouse
from starloom.sources import csv_files
from starloom.sources.ledger import COMPLETED, FAILED
from starloom.streaming import filestream

DAY1, DAY2 = dt.date(2024, 6, 1), dt.date(2024, 6, 2)

CUSTOMERS = """customer_id,customer_name,email,phone,address,city,country,registration_date
K-ada,Ada Blom,ada@kiosk.test,0470111,Elm 4,Ghent,Belgium,2022-11-05
K-ben,Ben Osei,ben@kiosk.test,0470222,Oak 9,Accra,Ghana,2022-12-17
K-cho,Cho Minh,cho@kiosk.test,0470333,Ash 1,Ho Chi Minh,Vietnam,2023-01-21
K-dov,Dov Arazi,dov@kiosk.test,0470444,Fir 7,Haifa,Israel,2023-02-02
"""
PRODUCTS = """product_id,product_name,category,subcategory,supplier,cost_price,msrp
P-anvil,Anvil,Tools,Forge,Hephaest,40.00,75.00
P-bench,Bench,Garden,Seats,Timberco,55.50,99.00
P-comb,Comb,Care,Hair,Spruce,0.80,2.50
P-drum,Drum,Music,Percussion,Beatwerk,120.00,180.00
"""
HEADER = "order_id,order_date,customer_id,product_id,quantity,unit_price,total_amount\n"
SALES = HEADER + """S-201,2023-04-02,K-cho,P-comb,10,2.50,25.00
S-202,2023-04-28,K-ada,P-drum,1,180.00,180.00
S-203,2023-06-11,K-dov,P-anvil,2,75.00,150.00
S-204,2023-06-12,K-ben,P-bench,1,99.00,99.00
S-205,2023-07-30,K-ada,P-comb,4,2.50,10.00
S-206,2023-09-09,K-ben,P-anvil,3,70.00,210.00
S-207,2023-09-10,K-cho,P-drum,1,175.00,175.00
"""
COUNT = 7
#: The last customer, who bought S-203, comes late in some tests.
EARLY = "".join(CUSTOMERS.splitlines(keepends=True)[:4])
LATE = CUSTOMERS.splitlines(keepends=True)[0] + CUSTOMERS.splitlines(keepends=True)[4]


class Site:
    def __init__(self, spark, path: Path):
        self.spark, self.source, self.path = spark, path / "in", path
        self.source.mkdir(parents=True)
        self.warehouse = Warehouse(spark, str(path / "wh"))

    def put(self, **files):
        for name, text in files.items():
            (self.source / f"{name}.csv").write_text(text)
        return self

    def mini(self):
        return self.put(customers=CUSTOMERS, products=PRODUCTS, sales=SALES)

    def full(self, day=DAY1):
        self.warehouse.run_full(str(self.source), day)

    def incremental(self, day=DAY1):
        self.warehouse.run_incremental(str(self.source), day)

    def loaded(self):
        rows = self.warehouse.fact().collect()
        assert sorted(r.sales_key for r in rows) == list(range(1, len(rows) + 1))
        return {(r.order_id, r.product_key): r.total_amount for r in rows}

    def sound(self):
        bad = self.warehouse.invariants().where("n <> 0").collect()
        assert not bad, bad


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def test_mini_set_end_to_end(site):
    site.mini().full()
    star = site.warehouse.star()
    assert len(site.loaded()) == COUNT
    total = star.fact.agg(F.sum("total_amount"), F.sum("profit_amount")).first()
    assert tuple(total) == (D("849.00"), D("342.30"))
    segments = {r.customer_segment: r["count"] for r in
                star.customer.groupBy("customer_segment").count().collect()}
    assert segments == {"MAJOR_CITY": 1, "OTHER": 3}
    assert [r.phone for r in star.customer.orderBy("customer_key").collect()] == [
        "0470111", "0470222", "0470333", "0470444"]
    labels = {r.label: r.value for r in site.warehouse.validate().collect()}
    assert labels["Total Sales Amount"] == "849.00" and labels["Date Range End"] == "2025-12-31"
    site.sound()
    state = {r.process_name: r for r in site.warehouse.ledger.state().collect()}
    assert {r.status for r in state.values()} == {COMPLETED}
    assert state["EXTRACT_SALES"].records_extracted == COUNT
    assert state["TRANSFORM_SALES"].records_transformed == COUNT
    assert state["LOAD_FACT_SALES"].records_loaded == COUNT


def test_second_run_adds_nothing(site):
    site.mini().full()
    before = site.loaded()
    assert len(before) == COUNT
    dims = [sorted(map(str, site.warehouse.dimension(d).collect())) for d in (CUSTOMER, PRODUCT)]
    site.full(DAY2)
    site.incremental(DAY2)
    assert site.loaded() == before
    assert dims == [sorted(map(str, site.warehouse.dimension(d).collect()))
                    for d in (CUSTOMER, PRODUCT)]
    assert site.warehouse.staged(P.SALES).count() == COUNT
    site.sound()


def test_staging_numbers_follow_the_files(spark, tmp_path):
    """Small splits, several files: numbers must follow file name and row order."""
    site = Site(spark, tmp_path)
    for part in range(3):
        rows = "".join(f"ORD{part}-{i:05d},2023-01-20,C,P,1,1.00,1.00\n" for i in range(2000))
        site.put(**{f"sales_{part}": HEADER + rows})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        site.warehouse.extract(P.SALES, str(site.source))
        site.warehouse.transform(P.SALES, dt.datetime(2024, 1, 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows = site.warehouse.staged(P.SALES).orderBy("staging_id").collect()
    assert [r.staging_id for r in rows] == list(range(1, 6001))
    assert [r.order_id for r in rows] == [f"ORD{p}-{i:05d}" for p in range(3) for i in range(2000)]
    assert rows[0].file_name == "sales_0.csv" and rows[-1].file_name == "sales_2.csv"


def test_malformed_rows_are_quarantined(site):
    site.mini().put(sales=SALES + "BAD1,not a date,K-ada,P-comb,1,1.00,1.00\n"
                    "BAD2,2023-05-05,K-ada,P-comb,one,1.00,1.00\n"
                    "BAD3,2023-05-05,K-ada\n").full()
    bad = site.warehouse.staged(P.SALES).where(F.col("error_message") == S.MALFORMED)
    assert sorted(r.order_id for r in bad.collect()) == ["BAD1", "BAD2", "BAD3"]
    assert len(site.loaded()) == COUNT


def test_failed_extract_is_recorded_and_leaves_nothing(site, monkeypatch):
    site.mini().put(sales="order_id,wrong,header\n1,2,3\n")
    with pytest.raises(Exception):
        site.full()
    state = {r.process_name: r for r in site.warehouse.ledger.state().collect()}
    assert state["EXTRACT_SALES"].status == FAILED and state["EXTRACT_SALES"].error_message
    assert site.warehouse.staged(P.SALES).count() == 0
    site.put(sales=SALES).full()
    assert len(site.loaded()) == COUNT
    site.sound()


def test_run_that_dies_in_the_fact_load_is_repeated(site, monkeypatch):
    site.mini()
    close = site.warehouse.ledger.close

    def broken(opened, *results):
        if opened[0]["process_name"] == P.LOAD_FACTS:
            raise RuntimeError("lost")
        close(opened, *results)

    monkeypatch.setattr(site.warehouse.ledger, "close", broken)
    with pytest.raises(RuntimeError):
        site.full()
    monkeypatch.undo()
    site.warehouse = Warehouse(site.spark, site.warehouse.root)
    assert site.loaded() == {}
    site.incremental()
    assert len(site.loaded()) == COUNT
    site.sound()


@pytest.mark.parametrize("run", ["full", "incremental"])
def test_late_rows(site, run):
    """A late customer releases held sales; a late correction leaves the fact alone."""
    site.put(customers=EARLY, products=PRODUCTS, sales=SALES).full()
    assert len(site.loaded()) == COUNT - 1
    held = facts.reject_counts(site.warehouse.candidates()).collect()
    assert [(r.reject_reason, r.row_count) for r in held] == [(facts.NO_CUSTOMER, 1)]
    site.put(customers_2=LATE, sales_2=HEADER
             + "S-201,2023-04-03,K-cho,P-comb,20,2.50,50.00\n"
             + "S-301,2023-10-01,K-dov,P-bench,1,98.00,98.00\n")
    getattr(site, run)(DAY2)
    loaded = site.loaded()
    assert len(loaded) == COUNT + 1 and loaded[("S-201", 3)] == D("25.00")
    assert ("S-203", 1) in loaded
    site.sound()


def test_a_held_sale_is_shadowed_by_a_later_invalid_copy(site):
    site.put(customers=EARLY, products=PRODUCTS, sales=SALES).full()
    site.put(sales_2=HEADER + "S-203,2023-06-11,K-dov,P-anvil,0,75.00,0.00\n", customers_2=LATE)
    site.incremental(DAY2)
    assert len(site.loaded()) == COUNT - 1


def test_increments_equal_a_full_rebuild(spark, tmp_path):
    buyers = ("K-ada", "K-ben", "K-cho", "K-dov", "K-eve")
    goods = ("P-anvil", "P-bench", "P-comb")
    lines = [f"T{i:04d},2023-{i % 9 + 1:02d}-{i % 27 + 1:02d},{buyers[i % 5]},"
             f"{goods[i % 3]},{i % 4},7.25,{i % 4 * 7.25:.2f}\n" for i in range(120)]
    lines += lines[10:20]
    more = CUSTOMERS + "K-eve,Eve Moss,eve@kiosk.test,0470555,Yew 2,Cork,Ireland,2023-03-09\n"
    moved = CUSTOMERS.replace("Elm 4,Ghent", "Elm 6,Namur")
    steps = Site(spark, tmp_path / "steps")
    steps.put(customers=CUSTOMERS, products=PRODUCTS, sales_1=HEADER + "".join(lines[:50]))
    steps.incremental(DAY1)
    steps.put(customers_2=more, sales_2=HEADER + "".join(lines[50:90]))
    steps.incremental(DAY1)
    steps.put(sales_3=HEADER + "".join(lines[90:]))
    steps.incremental(DAY1)
    once = Site(spark, tmp_path / "once")
    once.put(customers=CUSTOMERS, customers_2=more, products=PRODUCTS, sales=HEADER + "".join(lines))
    once.full(DAY1)
    assert steps.loaded() == once.loaded()

    def daily(site):
        return sorted(map(str, site.warehouse.aggregates().collect()))

    assert daily(steps) == daily(once)
    steps.sound()
    # A moved customer opens a version; facts keep their key.
    steps.put(customers_3=moved).incremental(DAY2)
    assert steps.loaded() == once.loaded()
    versions = steps.warehouse.dimension(CUSTOMER).where("customer_id = 'K-ada'")
    assert versions.count() == 2
    steps.sound()


def test_only_touched_months_are_written(site):
    site.mini().full()
    first = sorted(site.warehouse.ledger.published(P.LOAD_AGGREGATES).values())
    assert [p[-6:] for p in first] == ["202304", "202306", "202307", "202309"]
    before = {p: sorted(f.name for f in Path(p).iterdir()) for p in first}
    site.put(sales_2=HEADER + "S-401,2023-06-20,K-cho,P-comb,2,2.00,4.00\n")
    site.incremental(DAY2)
    second = sorted(set(site.warehouse.ledger.published(P.LOAD_AGGREGATES).values()) - {*first})
    assert [p[-6:] for p in second] == ["202306"]
    assert before == {p: sorted(f.name for f in Path(p).iterdir()) for p in first}
    kept = sorted(map(str, site.warehouse.aggregates().collect()))
    site.warehouse.load_aggregates()
    assert kept == sorted(map(str, site.warehouse.aggregates().collect()))
    site.sound()


def test_sales_before_the_filter_wait_for_a_run_without_it(site):
    site.mini()
    site.warehouse.run_incremental(str(site.source), DAY1, date_filter=dt.date(2023, 6, 12))
    assert {order[-1] for order, _ in site.loaded()} == {"4", "5", "6", "7"}
    site.sound()
    site.warehouse.run_incremental(str(site.source), DAY1, date_filter=dt.date(2023, 4, 10))
    assert {order[-1] for order, _ in site.loaded()} == {"2", "3", "4", "5", "6", "7"}
    site.incremental()
    assert len(site.loaded()) == COUNT
    site.sound()


def test_a_late_batch_rewrites_no_newer_version(site):
    site.mini().full(DAY2)
    site.put(products_2=PRODUCTS.replace("40.00", "44.00"))
    site.incremental(DAY1)
    rows = site.warehouse.dimension(PRODUCT).where("product_id = 'P-anvil'").collect()
    assert [(r.cost_price, r.valid_from) for r in rows] == [(D("40.00"), DAY2)]


def test_line_breaks_inside_quotes(spark, tmp_path):
    site = Site(spark, tmp_path)
    site.warehouse = Warehouse(spark, str(tmp_path / "wh"), multi_line=True)
    text = CUSTOMERS.replace("Elm 4", '"Elm 4\nFlat 3"').replace("Ada Blom", '"Ada ""A"" Blom"')
    site.put(customers=text, products=PRODUCTS, sales=SALES).full()
    row = site.warehouse.dimension(CUSTOMER).orderBy("customer_key").first()
    assert (row.customer_name, row.address) == ('Ada "A" Blom', "Elm 4\nFlat 3")
    assert len(site.loaded()) == COUNT


def test_file_stream(site):
    warehouse, marks = site.warehouse, str(site.path / "marks")
    lines = SALES.splitlines(keepends=True)
    site.put(customers=EARLY, products=PRODUCTS, sales_1=HEADER + "".join(lines[1:3]),
             sales_2=HEADER + "".join(lines[3:]))
    filestream.run_available(warehouse, str(site.source), marks, DAY1, files_per_batch=1)
    assert len(site.loaded()) == COUNT - 1
    runs = len(warehouse.ledger.outputs(P.LOAD_FACTS))
    filestream.run_available(warehouse, str(site.source), marks, DAY1)
    assert len(warehouse.ledger.outputs(P.LOAD_FACTS)) == runs
    site.put(customers_2=LATE)
    filestream.run_available(warehouse, str(site.source), marks, DAY2)
    assert len(site.loaded()) == COUNT
    # A lost checkpoint replays every file; the ledger skips them.
    filestream.run_available(warehouse, str(site.source), str(site.path / "new"), DAY2)
    assert len(site.loaded()) == COUNT and warehouse.staged(P.SALES).count() == COUNT
    site.sound()


def test_a_replayed_batch_lands_in_its_own_folder_again(site):
    warehouse = site.warehouse
    site.mini().put(sales_2=HEADER + "S-301,2023-10-01,K-cho,P-bench,1,98.00,98.00\n")
    rows = csv_files.read_rows(site.spark, [f"{site.source}/sales.csv"], S.SALES_FILE)
    more = csv_files.read_rows(site.spark, [f"{site.source}/sales_2.csv"], S.SALES_FILE)
    assert warehouse.land_batch(P.SALES, rows, "stream-x-0") == COUNT
    assert warehouse.land_batch(P.SALES, rows, "stream-x-0") == 0
    # Another stream sees both files; the one that is known does not count there.
    assert warehouse.land_batch(P.SALES, rows.unionByName(more), "stream-y-0") == 1
    warehouse.transform(P.SALES, dt.datetime(2024, 1, 1))
    staged = warehouse.staged(P.SALES).orderBy("staging_id").collect()
    assert [r.staging_id for r in staged] == list(range(1, COUNT + 2))
    assert [r.order_id for r in staged][-1] == "S-301"


def test_a_sale_stays_loaded_once_after_its_product_changes(site):
    """A tracked change gives the product a new key; neither a full run nor a sale that is sent
    again may add facts."""
    site.mini().full()
    before = site.warehouse.fact().count()
    site.put(products2=PRODUCTS.replace("40.00", "44.00"))
    site.full(DAY2)
    assert site.warehouse.fact().count() == before
    site.put(sales2=SALES)
    site.incremental(DAY2)
    assert site.warehouse.fact().count() == before
    site.sound()


def test_a_sale_without_a_key_is_rejected_and_nothing_is_aggregated(site):
    assert site.warehouse.aggregates().count() == 0
    row = "S-901,2023-01-20,K-ada,,1,9.00,9.00\n,2023-01-20,K-ada,P-comb,1,9.00,9.00\n"
    site.put(customers=CUSTOMERS, products=PRODUCTS, sales=HEADER + row).full()
    reasons = [r.reject_reason for r in site.warehouse.candidates().collect()]
    assert reasons == [facts.NO_VALUE] * 2
    assert site.warehouse.fact().count() == 0 and site.warehouse.aggregates().count() == 0


def broken_checks(site):
    return {r.check: int(r.n) for r in site.warehouse.invariants().where("n <> 0").collect()}


def test_a_held_sale_that_a_run_forgets_is_reported(site, monkeypatch):
    site.put(customers=EARLY, products=PRODUCTS, sales=SALES).full()
    site.sound()
    monkeypatch.setattr(facts, "retried", lambda held: held.select(*facts.SALE_COLUMNS).limit(0))
    site.put(sales_2=HEADER + "S-501,2023-10-03,K-cho,P-comb,2,2.00,4.00\n").incremental(DAY2)
    assert broken_checks(site) == {"valid sales neither loaded nor rejected": 1}
    monkeypatch.undo()
    site.put(customers_2=LATE).full(DAY2)  # a full run offers everything again
    assert len(site.loaded()) == COUNT + 1
    site.sound()


def test_facts_that_are_lost_are_reported(site):
    site.mini().full()
    gone = next(Path(site.warehouse._fact_runs()[0][1]).glob("order_month=202304/*.parquet"))
    gone.rename(gone.with_name("_lost"))
    assert broken_checks(site)["facts differ from sales taken"] == 2


def test_source_files_keep_their_order_without_a_shuffle(spark, tmp_path):
    """A file for each slice and split of the stored rows, in their order."""
    rows = spark.range(20_000).withColumns({
        "_slice": (F.lit(12) - F.floor(F.col("id") / 2000)).cast("long"), "_place": F.col("id") % 2000,
        "text": F.concat(F.lit(" t"), F.col("id").cast("string"))})
    rows.coalesce(2).sortWithinPartitions("_slice", "_place").write.option(
        "parquet.block.size", "8192").parquet(str(tmp_path / "landed"))
    landed = spark.read.parquet(str(tmp_path / "landed"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        csv_files.write_in_place(landed, ["id", "text"], str(tmp_path / "files"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    files = csv_files.placed_files(spark, str(tmp_path / "files"))
    lines = [line for file in files
             for line in Path(file.removeprefix("file:")).read_text().splitlines()[1:]]
    ordered = [r.id for r in rows.orderBy("_slice", "_place").select("id").collect()]
    assert lines == [f"{i}, t{i}" for i in ordered]
    assert len(files) > 11


def test_loads_without_facts_or_held_sales_send_no_keys(site, monkeypatch):
    """Dimension batches of a stream load no fact; the sales behind them are all new."""
    asked = []
    monkeypatch.setattr(Warehouse, "loaded_keys", lambda *_: asked.append("loaded"))
    monkeypatch.setattr(P, "latest_carried", lambda *_: asked.append("carried"))
    site.mini()
    filestream.run_available(site.warehouse, str(site.source), str(site.path / "marks"), DAY1)
    assert len(site.warehouse._fact_runs()) > 1 and not asked
    assert len(site.loaded()) == COUNT
    monkeypatch.undo()
    site.put(sales_2=SALES + "S-301,2023-10-01,K-new,P-bench,1,98.00,98.00\n").incremental(DAY2)
    assert len(site.loaded()) == COUNT
    site.put(sales_3=HEADER + "S-302,2023-10-01,K-cho,P-bench,1,98.00,98.00\n").incremental(DAY2)
    assert len(site.loaded()) == COUNT + 1
    site.sound()


def test_packed_source_files_are_read_like_others(spark, tmp_path):
    """By a full run and by a stream, in the order of the tasks that wrote them."""
    rows = spark.createDataFrame(
        [(f"O-{i:04d}", dt.date(2023, 5, 1 + i % 20), "K-ada", "P-comb", 1, None, None)
         for i in range(300)], S.SALES_FILE)
    sliced = slice_rows(rows, [F.col("order_id")])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        csv_files.write_rows(sliced.drop("_slice", "_place"), str(tmp_path / "files"), packed=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = csv_files.sorted_files(spark, str(tmp_path / "files"))
    assert len(files) > 1 and all(name.endswith(".csv.gz") for name in files)
    site = Site(spark, tmp_path / "site").mini()
    for i, name in enumerate(files):
        Path(name.removeprefix("file:")).rename(site.source / f"sales_9{i:05d}.csv.gz")
    site.full()
    staged = site.warehouse.staged(P.SALES).where("file_name LIKE 'sales_9%'")
    ids = [r.order_id for r in staged.orderBy("staging_id").collect()]
    assert ids == [f"O-{i:04d}" for i in range(300)]
    other = Warehouse(spark, str(tmp_path / "streamed"))
    filestream.run_available(other, str(site.source), str(tmp_path / "marks"), DAY1)
    assert other.staged(P.SALES).count() == site.warehouse.staged(P.SALES).count()
    assert other.fact().count() == site.warehouse.fact().count() == COUNT
