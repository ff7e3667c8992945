"""A versioned dimension on disk: current versions by key bucket, and an append-only history.

Folders of a load::

    run-N/current/bucket=B   current versions of the buckets it rewrote
    run-N/history            versions it closed
    run-N/manifest           all live parts, those of earlier loads included, and the last key

A load reads the buckets of its keys, and rewrites those in which something changed. The ledger
row of the load names its folder, so the manifest takes effect with it, as a whole; readers of an
older manifest are not disturbed. The manifest has a row per bucket and history part. When there
are ``HISTORY_PARTS`` of the latter, a load writes them together as one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import dimensions as D
from starloom.session import Scratch

BUCKETS = 16
HISTORY_PARTS = 16
_MANIFEST = "bucket int, path string, last_key long, buckets int"


@dataclass
class Parts:
    """Live parts of a dimension: folders of current versions by bucket, and of history."""

    current: dict[int, str] = field(default_factory=dict)
    history: list[str] = field(default_factory=list)
    last_key: int = 0
    buckets: int = BUCKETS

    @property
    def paths(self) -> list[str]:
        return [*self.current.values(), *self.history]


def read_parts(spark: SparkSession, folder: str) -> Parts:
    """The manifest of a load: at most its buckets and ``HISTORY_PARTS`` rows."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").collect()
    found = Parts(last_key=rows[0].last_key, buckets=rows[0].buckets) if rows else Parts()
    for row in sorted(rows, key=lambda r: r.path or ""):
        if row.bucket is not None:
            found.current[row.bucket] = row.path
        elif row.path is not None:
            found.history.append(row.path)
    return found


def write_parts(spark: SparkSession, folder: str, parts: Parts) -> None:
    rows = [*parts.current.items(), *[(None, path) for path in parts.history]] or [(None, None)]
    data = [(bucket, path, parts.last_key, parts.buckets) for bucket, path in rows]
    spark.createDataFrame(data, _MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")


def read_versions(spark: SparkSession, paths: list[str], dimension: D.Dimension) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], dimension.schema)
    return spark.read.schema(dimension.schema).parquet(*paths)


def _write_current(versions: DataFrame, folder: str, dimension: D.Dimension, parts: Parts
                   ) -> None:
    """Write current versions as new parts of their buckets."""
    placed = versions.withColumn("bucket", D.bucket(dimension, parts.buckets))
    path = f"{folder}/current"
    placed.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(path)
    schema = f"{dimension.natural} string, bucket int"
    # Partition names only: at most one per bucket.
    found = versions.sparkSession.read.schema(schema).parquet(path).select("bucket").distinct()
    parts.current.update({row.bucket: f"{path}/bucket={row.bucket}" for row in found.collect()})


def merge(before: Parts | None, rows: DataFrame, dimension: D.Dimension, as_of: dt.date,
          folder: str, scratch: Scratch, buckets: int = BUCKETS) -> int:
    """Merge staged ``rows`` into the stored dimension; ``folder`` becomes its newest load.
    Returns the number of versions opened or overwritten."""
    spark = rows.sparkSession
    if before is None:
        parts = Parts(buckets=buckets)
        versions = scratch.keep(D.first_versions(rows, dimension, as_of, scratch), "versions")
        opened = versions.count()
        parts.last_key = opened
        _write_current(versions, folder, dimension, parts)
        write_parts(spark, folder, parts)
        return opened

    parts = Parts(dict(before.current), list(before.history), before.last_key, before.buckets)
    place = D.bucket(dimension, parts.buckets)

    def current_of(some: DataFrame) -> DataFrame:
        """Current versions in the buckets of some keys; a bucket without any has no part."""
        wanted = [row.b for row in some.where(F.col(dimension.natural).isNotNull())
                  .select(place.alias("b")).distinct().collect()]
        return read_versions(spark, [parts.current[b] for b in wanted if b in parts.current],
                             dimension)

    changes = D.scd2_changes(current_of(rows), rows, dimension, as_of, parts.last_key, scratch)
    counts = changes.agg(F.count_if("is_current"), F.count_if(~F.col("is_current")),
                         F.max(dimension.surrogate)).first()
    opened, closed, last = (n or 0 for n in counts)
    parts.last_key = max(parts.last_key, last)
    if opened:
        _write_current(D.with_changes(current_of(changes), changes, dimension), folder,
                       dimension, parts)
    if closed:
        history = changes.where(~F.col("is_current"))
        if len(parts.history) >= HISTORY_PARTS:
            history = history.unionByName(read_versions(spark, parts.history, dimension))
            parts.history.clear()
        history.write.parquet(f"{folder}/history")
        parts.history.append(f"{folder}/history")
    write_parts(spark, folder, parts)
    return opened
