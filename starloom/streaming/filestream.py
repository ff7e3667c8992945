"""Source folders as file streams.

Each run takes the files that arrived since the last one, in micro-batches, and loads every
batch through the same steps as a batch run. A batch is parsed once, into a landing folder named
by the stream and the number of the batch, so a replay writes the same folder again. Its files are
then read from the landed rows. The stream's checkpoint remembers files it has seen; the ledger,
by base name, and the insert-ignore of facts make a replayed batch harmless.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from starloom.plans.pipeline import CUSTOMERS, PRODUCTS, SALES, Kind, Warehouse
from starloom.sources import csv_files


def file_stream(warehouse: Warehouse, kind: Kind, folder: str,
                files_per_batch: int | None = None) -> DataFrame:
    """New files of one kind, as a stream of rows with their file metadata."""
    reader = (
        warehouse.spark.readStream.schema(csv_files.with_corrupt(kind.file_schema))
        .options(**csv_files.csv_options(warehouse.multi_line)).option("pathGlobFilter", kind.pattern)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder).select("*", "_metadata")


def load_batch(warehouse: Warehouse, kind: Kind, batch: DataFrame, name: str, as_of: dt.date,
               load_time: dt.datetime) -> None:
    """Land, clean and load the rows of one micro-batch. ``name`` is its landing folder."""
    warehouse.land_batch(kind, csv_files.located(batch).drop("_metadata"), name)
    warehouse.transform(kind, load_time)
    warehouse.load_new(as_of)


def start(warehouse: Warehouse, kind: Kind, folder: str, checkpoint: str, as_of: dt.date,
          files_per_batch: int | None = None) -> StreamingQuery:
    """Start a query that drains the waiting files of one kind and stops."""
    place = f"{checkpoint}/{kind.name}"
    stream = uuid.uuid5(uuid.NAMESPACE_URL, place).hex[:12]

    def run(batch: DataFrame, number: int) -> None:
        load_batch(warehouse, kind, batch, f"stream-{stream}-{number}", as_of,
                   dt.datetime.now(dt.timezone.utc))

    return (
        file_stream(warehouse, kind, folder, files_per_batch)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", place)
        .trigger(availableNow=True).start()
    )


def run_available(warehouse: Warehouse, folder: str, checkpoint: str, as_of: dt.date,
                  files_per_batch: int | None = None) -> None:
    """Drain all three folders, dimensions before sales."""
    for kind in (CUSTOMERS, PRODUCTS, SALES):
        start(warehouse, kind, folder, checkpoint, as_of, files_per_batch).awaitTermination()
