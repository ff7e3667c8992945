"""The warehouse built from one folder of the given tables.

Each part is built once per session and folder, on first use, by the steps of the ordinary
pipeline over the whole tables, and stored in the shared folder. The registered queries read
the stored tables, as reports do in daily use.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.operators.dimensions import CUSTOMER, PRODUCT
from starloom.plans import pipeline as P
from starloom.session import Scratch, tune
from starloom.sources import csv_files
from starloom.sources import retail_tables as R
from starloom.streaming import filestream

SECOND_DAY = R.AS_OF + dt.timedelta(days=1)

_SAMPLES: dict[tuple[str, str], "Sample"] = {}


class Sample:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder
        self.rules, self.as_of = R.RULES, R.AS_OF
        self.scratch = Scratch(spark)
        self._twice: dict[str, P.Warehouse] = {}
        self.warehouse = P.Warehouse(spark, f"{self.scratch.root}/warehouse", self.rules)

    def _rows(self, kind: P.Kind) -> dict:
        """Rows of the given tables, their order, and what gives them the columns of a file."""
        read, order, shape = {
            P.SALES: (R.sales_lines, R.SALES_ORDER, R.as_sales),
            P.CUSTOMERS: (R.customer_lines, R.CUSTOMERS_ORDER, R.as_customers),
            P.PRODUCTS: (R.product_lines, R.PRODUCTS_ORDER, R.as_products),
        }[kind]
        found = {"rows": read(self.spark, self.folder), "shape": shape,
                 "order": [F.col(name) for name in order]}
        if kind is P.SALES:
            found |= {"key": [F.col(name) for name in R.SALES_KEY], "settle": R.with_orders}
        return found

    def _stage(self, kind: P.Kind) -> DataFrame:
        return self.warehouse.stage_rows(
            kind, source=f"{kind.name}.csv", load_time=R.LOAD_TIME, **self._rows(kind))

    @cached_property
    def raw_sales(self) -> DataFrame:
        return self._stage(P.SALES)

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self._stage(P.CUSTOMERS)

    @cached_property
    def raw_products(self) -> DataFrame:
        return self._stage(P.PRODUCTS)

    @cached_property
    def sales(self) -> DataFrame:
        """Validated staged sales, duplicates included."""
        _ = self.raw_sales
        return self.warehouse.staged(P.SALES)

    @cached_property
    def customers(self) -> DataFrame:
        """Cleaned staged customers."""
        _ = self.raw_customers
        return self.warehouse.staged(P.CUSTOMERS)

    @cached_property
    def products(self) -> DataFrame:
        """Cleaned staged products."""
        _ = self.raw_products
        return self.warehouse.staged(P.PRODUCTS)

    @cached_property
    def customer(self) -> DataFrame:
        """Customer dimension."""
        _ = self.customers
        self.warehouse.load_dimension(CUSTOMER, self.as_of)
        return self.warehouse.dimension(CUSTOMER)

    @cached_property
    def product(self) -> DataFrame:
        """Product dimension."""
        _ = self.products
        self.warehouse.load_dimension(PRODUCT, self.as_of)
        return self.warehouse.dimension(PRODUCT)

    @cached_property
    def fact(self) -> DataFrame:
        P.together(self.spark, lambda: self.customer, lambda: self.product, lambda: self.sales)
        self.warehouse.load_facts()
        return self.warehouse.fact()

    @cached_property
    def candidates(self) -> DataFrame:
        """Sales with resolved keys and reject reasons."""
        _ = self.fact
        return self.warehouse.candidates()

    @cached_property
    def aggregates(self) -> DataFrame:
        _ = self.fact
        self.warehouse.load_aggregates()
        return self.warehouse.aggregates()

    @cached_property
    def star(self) -> S.Star:
        return S.Star(self.fact, self.customer, self.product, self.warehouse.dates())

    @cached_property
    def source_files(self) -> str:
        """All raw rows as packed source files, in the order in which they are staged. Rows that
        this warehouse has landed are written in place, others as they are sorted, without being
        landed and staged here first."""
        folder = self.scratch.path("incoming")
        files = self.spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(
            self.spark._jsc.hadoopConfiguration())
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files.mkdirs(path(folder))
        for kind in (P.CUSTOMERS, P.PRODUCTS, P.SALES):
            written = self.scratch.path(kind.name)
            columns = kind.file_schema.fieldNames()
            landed = self.warehouse.landed.get(kind.name)
            if landed is not None:
                csv_files.write_in_place(landed, columns, written, packed=True)
                parts = csv_files.placed_files(self.spark, written)
            else:
                rows = self.warehouse.ordered_rows(kind, **self._rows(kind))
                csv_files.write_rows(rows.select(*columns), written, packed=True)
                parts = csv_files.sorted_files(self.spark, written)
            for i, part in enumerate(parts):
                files.rename(path(part), path(f"{folder}/{kind.name}_{i:05d}.csv.gz"))
        return folder

    @cached_property
    def full_run(self) -> P.Warehouse:
        """A warehouse of its own, loaded from the source files by a full run."""
        warehouse = P.Warehouse(self.spark, f"{self.scratch.root}/full_run", self.rules)
        warehouse.run_full(self.source_files, self.as_of, R.LOAD_TIME)
        return warehouse

    @cached_property
    def stream_run(self) -> P.Warehouse:
        """A warehouse of its own, loaded from the source files by file streams."""
        warehouse = P.Warehouse(self.spark, f"{self.scratch.root}/stream_run", self.rules)
        filestream.run_available(warehouse, self.source_files,
                                 f"{self.scratch.root}/stream_marks", self.as_of)
        return warehouse

    @cached_property
    def sales_again(self) -> str:
        """All sales staged a second time, numbered behind the first: the folder of that load."""
        again = P.Warehouse(self.spark, f"{self.scratch.root}/again", self.rules)
        again.adopt_staged(P.SALES, self._staged_path(P.SALES))
        again.stage_numbered(P.SALES, self.raw_sales, "sales_again.csv", R.LOAD_TIME)
        return again.ledger.last_output(P.SALES.process("TRANSFORM"))

    def _staged_path(self, kind: P.Kind) -> str:
        _ = {P.SALES: lambda: self.sales, P.CUSTOMERS: lambda: self.customers,
             P.PRODUCTS: lambda: self.products}[kind]()
        return self.warehouse.ledger.last_output(kind.process("TRANSFORM"))

    def offered_twice(self, name: str, first: dict[P.Kind, Column], second: dict[P.Kind, DataFrame]
                      ) -> P.Warehouse:
        """A warehouse of its own, loaded twice by the steps of the pipeline. The first load
        takes the rows that meet a condition, the second the given rows and all sales again.
        Whole loads are staged once and shared."""
        if name not in self._twice:
            warehouse = P.Warehouse(self.spark, f"{self.scratch.root}/{name}", self.rules)
            raw = {P.CUSTOMERS: self.raw_customers, P.PRODUCTS: self.raw_products,
                   P.SALES: self.raw_sales}

            def stage(kind: P.Kind, rows: DataFrame, load: str) -> None:
                warehouse.stage_rows(kind, rows, [F.col("staging_id")], lambda sliced: sliced,
                                     f"{kind.name}_{load}.csv", R.LOAD_TIME)

            P.together(self.spark, *[
                partial(stage, kind, rows.where(first[kind]), "1") if kind in first
                else partial(warehouse.adopt_staged, kind, self._staged_path(kind))
                for kind, rows in raw.items()
            ])
            P.together(self.spark, lambda: warehouse.load_dimension(CUSTOMER, self.as_of),
                       lambda: warehouse.load_dimension(PRODUCT, self.as_of))
            warehouse.load_facts()
            P.together(self.spark, *[partial(stage, kind, rows, "2")
                                     for kind, rows in second.items()],
                       partial(warehouse.adopt_staged, P.SALES, self.sales_again))
            warehouse.load_new(SECOND_DAY)
            self._twice[name] = warehouse
        return self._twice[name]


def sample(spark: SparkSession, folder: str) -> Sample:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _SAMPLES:
        _SAMPLES[key] = Sample(spark, folder)
    return _SAMPLES[key]
