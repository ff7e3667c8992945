"""CSV source files: listing, reading with lineage, and staging."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S

CORRUPT = "_corrupt_record"
# Where a row stood: its file, the split of the file, and the running number within a task.
FILE, SPLIT, SPOT = "file_name", "_split_start", "_spot"
# Names of source files end so.
ENDINGS = "*{.csv,.csv.gz}"


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Paths and base names of source files; contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .load(folder).select("path"))
    return files.withColumn(FILE, F.element_at(F.split("path", "/"), -1))


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def csv_options(multi_line: bool = False) -> dict[str, object]:
    """Reader options. ``multi_line`` allows line breaks inside quotes; a file is then read
    by one task, as its rows can no longer be told apart from the middle."""
    return {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
            "enforceSchema": False, "dateFormat": "yyyy-MM-dd", "escape": '"',
            "multiLine": multi_line}


def write_rows(rows: DataFrame, path: str, by: tuple[str, ...] = (), packed: bool = False) -> None:
    """Write rows as CSV files which :func:`read_rows` gives back as they were, in folders by the
    columns ``by``, which the files leave out. With ``packed`` they are gzip files, each of which
    is read by one task: for rows that are dealt out in parts of bounded size."""
    writer = rows.write.partitionBy(*by) if by else rows.write
    writer.options(header=True, dateFormat="yyyy-MM-dd", escape='"',
                   compression="gzip" if packed else "none",
                   ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_in_place(landed: DataFrame, columns: list[str], path: str, packed: bool = False) -> None:
    """Write the rows of a stored frame with ``_slice`` and ``_place`` as CSV files, a folder for
    each slice and split of its file. A split is read by one task, so no row is shuffled."""
    rows = landed.select(*columns, "_slice", "_place",
                         F.col("_metadata.file_block_start").alias(SPLIT))
    ordered = rows.sortWithinPartitions("_slice", SPLIT, "_place")
    write_rows(ordered.drop("_place"), path, ("_slice", SPLIT), packed)


def placed_files(spark: SparkSession, path: str) -> list[str]:
    """The files of :func:`write_in_place` in the order of their rows; few for each slice."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_slice=*/{SPLIT}=*/{ENDINGS}")

    def place(name: str) -> tuple:
        *_, slice_, split, file = name.split("/")
        return int(slice_.split("=")[1]), int(split.split("=")[1]), file

    return sorted(_found(spark, pattern), key=place)


def sorted_files(spark: SparkSession, path: str) -> list[str]:
    """The files of :func:`write_rows`, one for each task, in the order of the tasks."""
    return sorted(_found(spark, spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-{ENDINGS}")))


def _found(spark: SparkSession, pattern) -> list[str]:
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [status.getPath().toString() for status in found]


def located(rows: DataFrame) -> DataFrame:
    """Add file name and position columns to rows read from files.

    A split is read by one task from front to back, so (file, split, running number) is the
    order of the rows in the files.
    """
    return rows.select(
        *rows.columns,
        # Spark gives the name percent-encoded; a plus sign in it stands for itself.
        F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
                     ).alias(FILE),
        F.col("_metadata.file_block_start").alias(SPLIT),
        F.monotonically_increasing_id().alias(SPOT),
    )


def read_rows(spark: SparkSession, paths: list[str], schema: T.StructType,
              multi_line: bool = False) -> DataFrame:
    """Rows of CSV files under a fixed schema. Texts such as phone numbers keep leading
    zeros; a row that does not fit keeps its text in the corrupt column."""
    reader = spark.read.schema(with_corrupt(schema)).options(**csv_options(multi_line))
    return located(reader.csv(paths))


def with_lineage(rows: DataFrame, load_time: dt.datetime, error: Column | None = None
                 ) -> DataFrame:
    """Add load time and an open status; ``error`` marks rows as wrong from the start."""
    return rows.withColumns({
        "load_timestamp": F.lit(load_time).cast("timestamp"),
        "processed_flag": F.lit(False),
        "error_message": error if error is not None else F.lit(None).cast("string"),
    })


def malformed() -> Column:
    return F.when(F.col(CORRUPT).isNotNull(), S.MALFORMED)
