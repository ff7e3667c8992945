"""The warehouse on disk, and its full and incremental runs.

Folders below the root, all Parquet::

    landing/<kind>/load-N     rows as read, with their position in the files; those of a stream
                              in a folder for each batch
    staging/<kind>/load-N     numbered, cleaned, validated rows; quarantine included
    dim_customer/run-N        what a load changed of the versioned dimensions, and a manifest
    dim_product/run-N         of their live parts
    fact_candidates/run-N     sales with resolved keys, cost price and reject reasons
    sale_fates/load_run=N     what the run did with each of them, as a number
    fact_sales/load_run=N     facts added by a run, partitioned by order_month
    fact_keys/load_run=N      order and product ids of those facts, by bucket of the order id
    fact_filters/load_run=N   a Bloom filter over these keys
    agg_sales_daily/load_run=N  daily aggregates of the months a run computed, by order_month
    etl_metadata              the ledger

N is the process id in the ledger, so every attempt writes to a fresh folder, and folders
count once their COMPLETED event is written. Each stage reads the stored result of the one
before: lineage is short, and a lost executor costs tasks and not the run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.functions.columns import day_of_key
from starloom.operators import dimensions, facts, loaded_keys, quality
from starloom.operators.aggregates import daily_aggregates, daily_by_slices, with_agg_key
from starloom.operators.dedup import KEY, latest_carried, latest_valid_sales
from starloom.operators.numbering import number_stored, slice_rows, with_row_ids
from starloom.plans import checks, dimension_store
from starloom.sources import csv_files, quoted_csv
from starloom.sources.calendar import date_dimension
from starloom.sources.ledger import Ledger, pending_files
from starloom.session import WAREHOUSE_SETTINGS, Scratch, tune


@dataclass(frozen=True)
class Kind:
    """One of the three inputs."""

    name: str
    file_schema: T.StructType
    staging_schema: T.StructType
    clean: Callable[[DataFrame, S.Rules], DataFrame]

    @property
    def pattern(self) -> str:
        return f"{self.name}{csv_files.ENDINGS}"

    def process(self, step: str) -> str:
        return f"{step}_{self.name.upper()}"


CUSTOMERS = Kind("customers", S.CUSTOMERS_FILE, S.STAGING_CUSTOMERS, quality.clean_customers)
PRODUCTS = Kind("products", S.PRODUCTS_FILE, S.STAGING_PRODUCTS, quality.clean_products)
SALES = Kind("sales", S.SALES_FILE, S.STAGING_SALES, quality.validate_sales)

# Process names of the load steps.
LOAD_CUSTOMERS, LOAD_PRODUCTS = "LOAD_DIM_CUSTOMERS", "LOAD_DIM_PRODUCTS"
LOAD_FACTS, LOAD_AGGREGATES = "LOAD_FACT_SALES", "LOAD_AGG_SALES_DAILY"


def together(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Run steps that do not depend on each other at the same time."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            done.result()


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, rules: S.Rules = S.Rules(),
                 multi_line: bool = False, dimension_buckets: int = dimension_store.BUCKETS):
        """``multi_line`` reads source files whose quoted texts hold line breaks;
        ``dimension_buckets`` are the parts of a new dimension that loads rewrite."""
        self.spark = tune(spark, WAREHOUSE_SETTINGS)
        self.multi_line = multi_line
        self.dimension_buckets = dimension_buckets
        self.root = root.rstrip("/")
        self.rules = rules
        self.ledger = Ledger(spark, f"{self.root}/etl_metadata")
        self.scratch = Scratch(spark, f"{self.root}/scratch")
        #: By kind the rows that :meth:`stage_rows` sorted last, with slice and place.
        self.landed: dict[str, DataFrame] = {}

    # -- stored tables ---------------------------------------------------------------

    def _read(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _loads(self, kind: Kind) -> list[str]:
        return [path for _, path in self.ledger.outputs(kind.process("TRANSFORM"))]

    def staged(self, kind: Kind, loads: list[str] | None = None) -> DataFrame:
        paths = self._loads(kind) if loads is None else loads
        return self._read(paths, kind.staging_schema)

    def _parts(self, process: str) -> dimension_store.Parts | None:
        folder = self.ledger.last_output(process)
        return dimension_store.read_parts(self.spark, folder) if folder else None

    def dimension(self, dimension: dimensions.Dimension) -> DataFrame:
        process = LOAD_CUSTOMERS if dimension is dimensions.CUSTOMER else LOAD_PRODUCTS
        parts = self._parts(process)
        return dimension_store.read_versions(self.spark, parts.paths if parts else [], dimension)

    def dates(self) -> DataFrame:
        return date_dimension(self.spark, self.rules.start_date, self.rules.end_date)

    def fact(self, runs: list[str] | None = None) -> DataFrame:
        """Facts of the given or all runs, as one scan partitioned by run and month."""
        if runs is None:
            runs = [path for _, path in self.ledger.outputs(LOAD_FACTS)]
        schema = T.StructType([*S.FACT_SALES.fields,
                               T.StructField("load_run", T.LongType(), True),
                               T.StructField("order_month", T.IntegerType(), True)])
        if not runs:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/fact_sales")
        return reader.parquet(*runs)

    def aggregates(self) -> DataFrame:
        """Daily aggregates: of every month the folder written last. A run that replaces months
        becomes visible as a whole, with its ledger entry."""
        empty = facts.with_month(with_agg_key(daily_aggregates(self.fact([]))))
        months = self.ledger.published(LOAD_AGGREGATES)  # at most those of the calendar
        if not months:
            return empty.drop("order_month")
        fields = [*empty.schema.fields, T.StructField("load_run", T.LongType(), True)]
        reader = self.spark.read.schema(T.StructType(fields))
        stored = reader.option("basePath", f"{self.root}/agg_sales_daily").parquet(
            *months.values())
        return stored.drop("order_month", "load_run")

    def star(self) -> S.Star:
        return S.Star(self.fact(), self.dimension(dimensions.CUSTOMER),
                      self.dimension(dimensions.PRODUCT), self.dates())

    def candidates(self) -> DataFrame | None:
        """Resolved sales of the last completed fact load, rejects included."""
        run = self.ledger.last_id(LOAD_FACTS)
        if not run:
            return None
        return facts.with_measures(
            self.spark.read.parquet(f"{self.root}/fact_candidates/run-{run}"))

    # -- extract ---------------------------------------------------------------------

    def _run(self, process: str, sources: list[str | None],
             work: Callable[[int], list[dict]], consumed: list[str] = (),
             published: Callable[[], dict[str, str]] = dict) -> list[dict]:
        """Run ``work`` under ledger entries, one per source; it returns their results.
        ``consumed`` are the inputs it reads; ``published`` tells afterwards which parts it
        replaces."""
        opened = self.ledger.open(process, sources)
        try:
            results = work(opened[0]["process_id"])
            parts = published()
        except Exception as error:
            self.ledger.fail(opened, error)
            raise
        self.ledger.close(opened, results, consumed, parts)
        return results

    def extract(self, kind: Kind, folder: str) -> int:
        """Land the files not yet completed, by base name; returns the number of rows."""
        files = csv_files.list_files(self.spark, folder, kind.pattern)
        process = kind.process("EXTRACT")
        todo = sorted(pending_files(files, self.ledger.state(), process).collect(),
                      key=lambda row: row.file_name)
        if not todo:
            return 0
        paths, names = [row.path for row in todo], [row.file_name for row in todo]

        def read(step: Scratch) -> DataFrame:
            if self.multi_line:
                return quoted_csv.read_records(self.spark, paths, kind.file_schema, step)
            return csv_files.read_rows(self.spark, paths, kind.file_schema)

        return self.land(kind, read, names)

    def land(self, kind: Kind, read: Callable[[Scratch], DataFrame], names: list[str]) -> int:
        """Store located rows of the named files as one load. ``read`` gets a scratch folder that
        is cleared once the rows are stored."""
        def work(process_id: int) -> list[dict]:
            path = f"{self.root}/landing/{kind.name}/load-{process_id}"
            step = self.scratch.part("landing")
            rows = read(step)
            rows.write.parquet(path)
            step.clear()
            counts = self.spark.read.schema(rows.schema).parquet(path).groupBy(
                csv_files.FILE).agg(F.count(F.lit(1)).alias("n"))
            found = {row.file_name: row.n for row in counts.collect()}
            return [{"records_extracted": found.get(name, 0), "output": path}
                    for name in names]

        results = self._run(kind.process("EXTRACT"), names, work)
        return sum(result["records_extracted"] for result in results)

    def land_batch(self, kind: Kind, rows: DataFrame, name: str) -> int:
        """Store located rows in the landing folder ``name``, in place of those of an earlier
        attempt, and record the files that were not completed before. Returns their rows."""
        process = kind.process("EXTRACT")
        path = f"{self.root}/landing/{kind.name}/{name}"
        rows.write.mode("overwrite").parquet(path)
        landed = self.spark.read.schema(rows.schema).parquet(path)
        counts = landed.groupBy(csv_files.FILE).agg(F.count(F.lit(1)).alias("n"))
        # The files of a batch, for each of which the ledger gets a row.
        new = pending_files(counts, self.ledger.state(), process).orderBy(csv_files.FILE).collect()
        if not new:
            return 0
        results = [{"records_extracted": row.n, "output": path} for row in new]
        self._run(process, [row.file_name for row in new], lambda _: results)
        return sum(row.n for row in new)

    # -- transform -------------------------------------------------------------------

    def transform(self, kind: Kind, load_time: dt.datetime) -> None:
        """Number, clean and validate landed loads that are not staged yet."""
        files = self.ledger.completed(kind.process("EXTRACT"))
        landed = files.groupBy("output").agg(F.min("process_id").alias("first"))
        done = self.ledger.completed(kind.process("TRANSFORM")).select(
            F.col("source_file").alias("output"))
        new = landed.join(done, "output", "left_anti").orderBy("first").collect()
        for path in [row.output for row in new]:
            # A landed file counts in the folder that the ledger names for it.
            here = files.where(F.col("output") == path).select(
                F.col("source_file").alias(csv_files.FILE))
            rows = self.spark.read.parquet(path).join(here, csv_files.FILE, "left_semi")
            numbered = number_stored(rows.withColumn("_file", F.col(csv_files.FILE)),
                                     "staging_id", self.scratch, self._staged_rows(kind),
                                     ("_file", csv_files.SPLIT), csv_files.SPOT)
            raw = csv_files.with_lineage(numbered, load_time, csv_files.malformed())
            self._stage(kind, path, raw)

    def ordered_rows(self, kind: Kind, rows: DataFrame, order: list[Column],
                     shape: Callable[[DataFrame], DataFrame], **places) -> DataFrame:
        """Rows of a table in an order, with the columns of a source file, slice and place.

        ``shape`` gives the ordered rows the columns of the file and a file name; it runs
        after the shuffle, which then carries no derived text. Missing columns are NULL.
        ``places`` are further arguments of :func:`slice_rows`.
        """
        sliced = shape(slice_rows(rows, order, **places))
        return sliced.select(*[
            F.col(field.name) if field.name in sliced.columns
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in kind.file_schema.fields
        ], csv_files.FILE, "_slice", "_place")

    def stage_rows(self, kind: Kind, rows: DataFrame, order: list[Column],
                   shape: Callable[[DataFrame], DataFrame], source: str,
                   load_time: dt.datetime, **places) -> DataFrame:
        """Stage rows that come from a table; ``order`` stands in for the file position.

        Returns the rows as staged, before cleaning.
        """
        landed = self.scratch.keep(self.ordered_rows(kind, rows, order, shape, **places),
                                   f"landed_{kind.name}")
        self.landed[kind.name] = landed
        numbered = number_stored(landed, "staging_id", self.scratch, self._staged_rows(kind))
        filled = numbered.select("staging_id", *kind.file_schema.fieldNames(), csv_files.FILE)
        raw = csv_files.with_lineage(filled, load_time)
        self._stage(kind, source, raw)
        return raw

    def stage_numbered(self, kind: Kind, rows: DataFrame, source: str, load_time: dt.datetime
                       ) -> None:
        """Stage rows of another warehouse's load again, in their order there. Their numbers are
        dense from 1 on, so they only move behind those staged here."""
        raw = rows.select((F.col("staging_id") + self._staged_rows(kind)).alias("staging_id"),
                          *kind.file_schema.fieldNames(), csv_files.FILE)
        self._stage(kind, source, csv_files.with_lineage(raw, load_time))

    def adopt_staged(self, kind: Kind, path: str) -> None:
        """Take a load that another warehouse staged under the same rules as one of this one,
        without copying it. Its numbers have to lie above those staged here."""
        self._run(kind.process("TRANSFORM"), [path], lambda _: [self._staged_counts(kind, path)])

    def _staged_counts(self, kind: Kind, path: str) -> dict:
        counts = self._read([path], kind.staging_schema).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("processed_flag").alias("valid")
        ).first()
        return {"records_extracted": counts.rows, "records_transformed": counts.valid,
                "output": path}

    def _staged_rows(self, kind: Kind) -> int:
        """Staged rows so far. Numbers are dense, so this is also the last number."""
        return self.ledger.total(kind.process("TRANSFORM"), "records_extracted")

    def _stage(self, kind: Kind, source: str, raw: DataFrame) -> None:
        def work(process_id: int) -> list[dict]:
            path = f"{self.root}/staging/{kind.name}/load-{process_id}"
            cleaned = kind.clean(raw, self.rules)
            cleaned.select(*kind.staging_schema.fieldNames()).write.parquet(path)
            return [self._staged_counts(kind, path)]

        self._run(kind.process("TRANSFORM"), [source], work)

    # -- load ------------------------------------------------------------------------

    def load_dimension(self, dimension: dimensions.Dimension, as_of: dt.date,
                       loads: list[str] | None = None) -> None:
        """Merge staged rows into a dimension; ``loads`` limits the merge to new loads."""
        if dimension is dimensions.CUSTOMER:
            process, kind = LOAD_CUSTOMERS, CUSTOMERS
        else:
            process, kind = LOAD_PRODUCTS, PRODUCTS
        consumed = self._loads(kind) if loads is None else loads
        staged = self.staged(kind, consumed)
        if kind is CUSTOMERS:
            rows = dimensions.customer_rows(staged, self.rules)
        else:
            rows = dimensions.product_rows(staged)
        before = self._parts(process)

        def work(process_id: int) -> list[dict]:
            path = f"{self.root}/dim_{dimension.natural[:-3]}/run-{process_id}"
            step = self.scratch.part("dimension")
            opened = dimension_store.merge(before, rows, dimension, as_of, path, step,
                                           self.dimension_buckets)
            step.clear()
            return [{"records_loaded": opened, "output": path}]

        self._run(process, [None], work, consumed)

    def load_facts(self, loads: list[str] | None = None, first: dt.date | None = None) -> None:
        """Add facts. With ``loads``, read those staged loads and the sales held back by
        the last run, which is all that can add facts; without, read everything staged.
        Sales before the date ``first`` are held back."""
        consumed = self._loads(SALES) if loads is None else loads
        # The duplicate check carries whole rows; give it only what the load reads.
        sales = self.staged(SALES, consumed).select(*facts.SALE_COLUMNS, *facts.STATUS)
        held = self.candidates() if loads is not None else None
        carried = facts.retried(held) if held is not None else None
        if carried is not None and carried.isEmpty():
            carried = None  # nothing that the keys of the new loads have to travel for
        runs = self._runs_with_facts()

        def load(process_id: int) -> list[dict]:
            step = self.scratch.part("facts")
            offered = latest_valid_sales(sales, step).select(*facts.SALE_COLUMNS)
            if carried is not None:
                offered = offered.unionByName(latest_carried(carried, sales))
            # Both the lookups and the search for loaded sales read the offered sales.
            once = step.keep(offered, "offered") if runs else offered
            loaded = self.loaded_keys(once, runs) if runs else None
            candidates = facts.resolve(
                once, self.dimension(dimensions.CUSTOMER), self.dimension(dimensions.PRODUCT),
                self.dates(), loaded, first,
            )
            resolved = f"{self.root}/fact_candidates/run-{process_id}"
            candidates.write.parquet(resolved)
            path = f"{self.root}/fact_sales/load_run={process_id}"
            last = self.ledger.total(LOAD_FACTS, "records_loaded")
            stored = self.spark.read.schema(candidates.schema).parquet(resolved)
            facts.fates(stored).write.parquet(f"{self.root}/sale_fates/load_run={process_id}")
            rows = facts.accepted(stored)
            # Ranges of the whole order: a busy day is cut by order id, and keys depend on
            # the rows alone. The day does not travel, as it follows from its key.
            numbered = with_row_ids(rows.select(*facts.FACT_PARTS).drop("order_date"),
                                    [F.col(name) for name in facts.LOAD_ORDER], "sales_key",
                                    step, last)
            dated = numbered.withColumn("order_date", day_of_key(F.col("date_key")))
            fact = facts.with_month(
                facts.with_measures(dated).select(*S.FACT_SALES.fieldNames()))
            fact.write.partitionBy("order_month").parquet(path)
            count = rows.count()
            keys = rows.select(*loaded_keys.SALE_KEY)
            loaded_keys.write_keys(keys, f"{self.root}/fact_keys/load_run={process_id}")
            loaded_keys.write_filter(keys, count,
                                     f"{self.root}/fact_filters/load_run={process_id}")
            step.clear()
            return [{"records_loaded": count, "output": path}]

        self._run(LOAD_FACTS, [None], load, consumed)

    def _fact_runs(self) -> list[tuple[int, str]]:
        """(number, folder) of the completed fact loads, oldest first."""
        return [(int(path.rsplit("=", 1)[1]), path)
                for _, path in self.ledger.outputs(LOAD_FACTS)]

    def _runs_with_facts(self) -> list[int]:
        """Numbers of the completed fact loads that added facts; others hold no key."""
        rows = self.ledger.completed(LOAD_FACTS).where("records_loaded > 0").select(
            "process_id").orderBy("process_id").collect()
        return [row.process_id for row in rows]

    def loaded_keys(self, sales: DataFrame, runs: list[int], step: Scratch | None = None
                    ) -> DataFrame:
        """Keys that the given fact loads hold, from the buckets that their filters do not rule
        out for the stored ``sales``: no other key of a sale can be loaded. With a scratch folder
        the keys of ``sales`` are stored, and the result has only those of them."""
        def stored(table: str, schema: str, of: list[int]) -> DataFrame:
            base = f"{self.root}/{table}"
            return self.spark.read.schema(schema).option("basePath", base).parquet(
                *[f"{base}/load_run={run}" for run in of])

        keys = loaded_keys.with_key(sales) if step is None else step.keep(
            loaded_keys.keys_of(sales), "offered_keys")
        filters = stored("fact_filters", loaded_keys.FILTER_SCHEMA, runs)
        # Partition names only: a few dozen levels at most.
        levels = [row.level for row in filters.select("level").distinct().collect()]
        places = [(row.load_run, row.bucket) for row in loaded_keys.may_hold(
            keys, filters, levels).collect()] if levels else []
        if not places:
            return keys.limit(0)
        chosen = stored("fact_keys", loaded_keys.KEYS_SCHEMA, sorted({run for run, _ in places}))
        chosen = chosen.where(loaded_keys.selected(places))
        if step is not None:
            return loaded_keys.found(chosen, keys)
        # A sale loads once, so these are distinct.
        return chosen.select(*loaded_keys.SALE_KEY)

    def load_aggregates(self, rebuild: bool = True) -> None:
        """Write the daily aggregates: all of them, or the months with facts that the
        stored table does not cover yet."""
        runs = [path for _, path in self._fact_runs()]
        fresh = self._not_consumed(self.ledger.completed(LOAD_FACTS), LOAD_AGGREGATES)
        rebuild = rebuild or not self.ledger.last_id(LOAD_AGGREGATES)
        fact = self.fact(runs)
        months: dict[str, str] = {}
        if not rebuild:
            if not fresh:
                return
            # Bounded by the months of the calendar; reads partition names only.
            touched = [row.order_month for row in
                       self.fact(fresh).select("order_month").distinct().collect()]
            fact = fact.where(F.col("order_month").isin(touched))

        def work(process_id: int) -> list[dict]:
            path = f"{self.root}/agg_sales_daily/load_run={process_id}"
            step = self.scratch.part("aggregates")
            daily = facts.with_month(with_agg_key(daily_by_slices(fact, step)))
            daily.write.partitionBy("order_month").parquet(path)
            step.clear()
            written = self.spark.read.schema(daily.schema).parquet(path)
            # Bounded by the months of the calendar.
            for row in written.select("order_month").distinct().collect():
                months[str(row.order_month)] = f"{path}/order_month={row.order_month}"
            return [{"output": path}]

        self._run(LOAD_AGGREGATES, [None], work, fresh, lambda: months)

    # -- runs ------------------------------------------------------------------------

    def _ingest(self, folder: str, load_time: dt.datetime) -> None:
        def ingest(kind: Kind) -> Callable[[], None]:
            def steps() -> None:
                self.extract(kind, folder)
                self.transform(kind, load_time)
            return steps

        together(self.spark, ingest(CUSTOMERS), ingest(PRODUCTS), ingest(SALES))

    def run_full(self, folder: str, as_of: dt.date, load_time: dt.datetime | None = None
                 ) -> None:
        """New files through all phases; dimensions and facts offered everything staged."""
        self._ingest(folder, load_time or dt.datetime.now(dt.timezone.utc))
        self.load_staged(as_of)

    def load_staged(self, as_of: dt.date) -> None:
        together(self.spark,
                 lambda: self.load_dimension(dimensions.CUSTOMER, as_of),
                 lambda: self.load_dimension(dimensions.PRODUCT, as_of))
        self.load_facts()
        self.load_aggregates()

    def run_incremental(self, folder: str, as_of: dt.date,
                        load_time: dt.datetime | None = None,
                        date_filter: dt.date | None = None) -> None:
        """New files only. Adds the same rows as a full run, but touches staged history
        only through the sales held back, and rebuilds only months with new facts. Sales
        before ``date_filter`` are held back, for a run with an earlier filter or none."""
        self._ingest(folder, load_time or dt.datetime.now(dt.timezone.utc))
        self.load_new(as_of, date_filter)

    def load_new(self, as_of: dt.date, date_filter: dt.date | None = None) -> None:
        """Load what is staged and not loaded. Sales held back can only be released by new
        dimension rows, or by an earlier date filter."""
        customers = self._unused(CUSTOMERS, LOAD_CUSTOMERS)
        products = self._unused(PRODUCTS, LOAD_PRODUCTS)
        sales = self._unused(SALES, LOAD_FACTS)
        if customers:
            self.load_dimension(dimensions.CUSTOMER, as_of, customers)
        if products:
            self.load_dimension(dimensions.PRODUCT, as_of, products)
        if (customers or products or sales or self._dimensions_ahead()
                or self._filter_releases(date_filter)):
            self.load_facts(sales, date_filter)
        self.load_aggregates(rebuild=False)

    def _filter_releases(self, date_filter: dt.date | None) -> bool:
        """Whether sales held back by a date filter pass this one."""
        held = self.candidates()
        if held is None:
            return False
        waiting = held.where(F.col("reject_reason") == facts.FILTERED)
        if date_filter is not None:
            waiting = waiting.where(F.col("order_date") >= F.lit(date_filter))
        return not waiting.isEmpty()

    def _dimensions_ahead(self) -> bool:
        """Whether a dimension load has completed since facts were loaded, as after a run that
        died in between: it may release sales held back."""
        return max(map(self.ledger.last_id, (LOAD_CUSTOMERS, LOAD_PRODUCTS))
                   ) > self.ledger.last_id(LOAD_FACTS)

    def _unused(self, kind: Kind, process: str) -> list[str]:
        """Staged loads that no completed load process has read."""
        return self._not_consumed(self.ledger.completed(kind.process("TRANSFORM")), process)

    def _not_consumed(self, made: DataFrame, process: str) -> list[str]:
        """Outputs of completed processes that no completed ``process`` has read, in order."""
        read = self.ledger.consumed(process).select(F.col("source_file").alias("output"))
        new = made.select("process_id", "output").join(read, "output", "left_anti")
        return [row.output for row in new.orderBy("process_id").collect()]

    def validate(self) -> DataFrame:
        return checks.validation(self.star())

    def fates(self) -> DataFrame:
        """(staging_id, fate, load_run) of every sale that a completed fact load was offered."""
        base = f"{self.root}/sale_fates"
        runs = [f"{base}/load_run={run}" for run, _ in self._fact_runs()]
        if not runs:
            return self.spark.createDataFrame([], facts.FATE_SCHEMA)
        return self.spark.read.schema(facts.FATE_SCHEMA).option("basePath", base).parquet(*runs)

    def invariants(self) -> DataFrame:
        star = self.star()
        sales = self.staged(SALES).select("staging_id", *KEY, *facts.STATUS)
        fates = self.fates()
        return checks.invariants(star, self.aggregates()).unionByName(
            checks.balances(sales, facts.last_fates(fates), self.ledger.last_id(LOAD_FACTS),
                            self.scratch)
        ).unionByName(checks.fact_balance(star.fact, fates))
