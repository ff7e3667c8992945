"""Process ledger: an append-only log of run events, with snapshots.

A process opens with status RUNNING and closes with COMPLETED and its counts, or FAILED and
a message. The state of a process is its latest event. Tables written by a process count
only once its COMPLETED event, which names their folder, is in the ledger: a run that dies
half-way leaves nothing visible behind. With that event come, in the same file, a CONSUMED
event for each input that the process has read, and a PUBLISHED one for each part that it puts
in the place of an earlier one. One writer at a time is assumed.

Events are appended to ``log/generation=G``. When a generation has ``TAIL`` files, the state
after it is written to ``snapshot/generation=G`` and the next generation begins. Readers take
the newest complete snapshot and the log behind it. Everything is read as a frame; the driver
gets single numbers and the rows that a caller asks for.
"""

from __future__ import annotations

import datetime as dt
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import LEDGER

RUNNING, COMPLETED, FAILED = "RUNNING", "COMPLETED", "FAILED"
CONSUMED, PUBLISHED = "CONSUMED", "PUBLISHED"
_ORDER = ["event_time", "end_time"]
#: Files of a generation after which the ledger is put together.
TAIL = 64


def latest_events(events: DataFrame, process: str, order: list[str]) -> DataFrame:
    """The last event per process; map tasks reduce a busy process before the shuffle."""
    rest = [name for name in events.columns if name != process and name not in order]
    last = F.max(F.struct(*order, *rest)).alias("last")
    return events.groupBy(process).agg(last).select(
        *[F.col(name) if name == process else F.col(f"last.{name}") for name in events.columns]
    )


def pending_files(files: DataFrame, state: DataFrame, process_name: str,
                  name: str = "file_name") -> DataFrame:
    """Files, by base name, without a completed process of the given name."""
    done = state.where((F.col("process_name") == process_name)
                       & (F.col("status") == COMPLETED)).select(F.col("source_file").alias(name))
    return files.join(done, name, "left_anti")


def compacted(events: DataFrame) -> DataFrame:
    """The events that still tell something: the latest of each process, every consumed input,
    and of each published part the last place."""
    part = F.col("status") == PUBLISHED
    used = F.col("status") == CONSUMED
    published = latest_events(events.where(part).withColumn(
        "_part", F.struct("process_name", "source_file")), "_part", ["process_id", "event_time"])
    return latest_events(events.where(~part & ~used), "process_id", _ORDER).unionByName(
        events.where(used)).unionByName(published.drop("_part"))


class Ledger:
    """The log at a path. What is asked for is remembered until the next event."""

    def __init__(self, spark: SparkSession, path: str, tail: int = TAIL):
        self.spark = spark
        self.path = path
        self.tail = tail
        self._lock = RLock()
        self._known: dict[tuple, object] = {}
        self._generation: int | None = None
        self._files = 0
        self._last: int | None = None

    # -- reading ---------------------------------------------------------------------

    def _list(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def _generations(self, folder: str) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in self._list(folder) if "=" in name)

    def _snapshot(self) -> int | None:
        """The newest snapshot that was written to its end."""
        done = [g for g in self._generations("snapshot")
                if "_SUCCESS" in self._list(f"snapshot/generation={g}")]
        return max(done, default=None)

    def events(self) -> DataFrame:
        """The events of the newest snapshot and of the log behind it."""
        snapshot = self._snapshot()
        paths = [f"{self.path}/log/generation={g}" for g in self._generations("log")
                 if snapshot is None or g > snapshot]
        if snapshot is not None:
            paths.append(f"{self.path}/snapshot/generation={snapshot}")
        if not paths:
            return self.spark.createDataFrame([], LEDGER)  # nothing written yet
        return self.spark.read.schema(LEDGER).parquet(*paths)

    def state(self) -> DataFrame:
        """The latest event of every process."""
        steps = self.events().where(~F.col("status").isin(CONSUMED, PUBLISHED))
        return latest_events(steps, "process_id", _ORDER)

    def completed(self, process_name: str) -> DataFrame:
        """Completed processes of a name; a process completes once."""
        return self.events().where((F.col("process_name") == process_name)
                                   & (F.col("status") == COMPLETED))

    def consumed(self, process_name: str) -> DataFrame:
        """(source_file): the inputs that completed processes of a name have read."""
        return self.events().where((F.col("process_name") == process_name)
                                   & (F.col("status") == CONSUMED)).select("source_file").distinct()

    def _remembered(self, key: tuple, find):
        with self._lock:
            if key not in self._known:
                self._known[key] = find()
            return self._known[key]

    def outputs(self, process_name: str) -> list[tuple[str, str]]:
        """(source, output) of completed processes of a name, oldest first."""
        def find():
            rows = self.completed(process_name).select(
                "process_id", "source_file", "output").orderBy("process_id").collect()
            return [(row.source_file, row.output) for row in rows]
        return self._remembered(("outputs", process_name), find)

    def last_output(self, process_name: str) -> str | None:
        def find():
            return self.completed(process_name).agg(F.max_by("output", "process_id")).first()[0]
        return self._remembered(("last", process_name), find)

    def last_id(self, process_name: str) -> int:
        """Number of the last completed process of a name, 0 if there is none."""
        def find():
            return self.completed(process_name).agg(F.max("process_id")).first()[0] or 0
        return self._remembered(("id", process_name), find)

    def published(self, process_name: str) -> dict[str, str]:
        """The last place of every part that processes of a name published."""
        def find():
            parts = self.events().where((F.col("process_name") == process_name)
                                        & (F.col("status") == PUBLISHED))
            rows = parts.groupBy("source_file").agg(
                F.max_by("output", "process_id").alias("output")).collect()
            return {row.source_file: row.output for row in rows}
        return self._remembered(("published", process_name), find)

    def total(self, process_name: str, count: str) -> int:
        """Sum of a count over the completed processes of a name."""
        def find():
            return self.completed(process_name).agg(F.sum(count)).first()[0] or 0
        return self._remembered(("total", process_name, count), find)

    # -- writing ---------------------------------------------------------------------

    def _append(self, rows: list[dict]) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        names = LEDGER.fieldNames()
        data = [tuple({**row, "event_time": now}.get(name) for name in names) for row in rows]
        with self._lock:
            if self._generation is None:
                self._start()
            # One partition: the rows of a step become visible together, as one file.
            rows = self.spark.sparkContext.parallelize(data, 1)
            self.spark.createDataFrame(rows, LEDGER).write.mode("append").parquet(
                f"{self.path}/log/generation={self._generation}")
            self._known.clear()
            self._files += 1
            if self._files >= self.tail:
                self.compact()

    def _start(self) -> None:
        """Go on with the generation that an earlier writer left."""
        snapshot = self._snapshot()
        first = 0 if snapshot is None else snapshot + 1
        self._generation = max([first, *self._generations("log")])
        self._files = sum(name.endswith(".parquet") for name in
                          self._list(f"log/generation={self._generation}"))

    def compact(self) -> None:
        """Write a snapshot of all events so far and begin the next generation. A snapshot that
        is not finished does not count and is written again."""
        with self._lock:
            if self._generation is None:
                self._start()
            compacted(self.events()).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/snapshot/generation={self._generation}")
            self._generation, self._files = self._generation + 1, 0

    def open(self, process_name: str, sources: list[str | None]) -> list[dict]:
        """Open one process per source, in one write."""
        with self._lock:
            if self._last is None:
                self._last = self.events().agg(F.max("process_id")).first()[0] or 0
            started = dt.datetime.now(dt.timezone.utc)
            opened = [
                {"process_id": self._last + place, "process_name": process_name,
                 "source_file": source, "start_time": started, "status": RUNNING}
                for place, source in enumerate(sources, 1)
            ]
            self._append(opened)
            self._last += len(opened)
            return opened

    def close(self, opened: list[dict], results: list[dict], consumed: list[str] = (),
              published: dict[str, str] | None = None) -> None:
        """Complete processes; the first one is named for what was consumed and published."""
        now = dt.datetime.now(dt.timezone.utc)
        rows = [{**row, **result, "status": COMPLETED, "end_time": now}
                for row, result in zip(opened, results, strict=True)]
        named = {name: opened[0][name] for name in ("process_id", "process_name")}
        rows += [{**named, "source_file": source, "status": CONSUMED} for source in consumed]
        rows += [{**named, "source_file": part, "output": place, "status": PUBLISHED}
                 for part, place in (published or {}).items()]
        self._append(rows)

    def fail(self, opened: list[dict], error: Exception) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        self._append([{**row, "status": FAILED, "end_time": now, "error_message": str(error)}
                      for row in opened])
