"""CSV files whose quoted texts hold line breaks, read in splits.

A line starts a record if an even number of quotes lies before it in its file. Only lines with an
odd number of quotes change that, so:

1. Lines are stored with their place (file, split, running number) and whether their quotes are
   odd. Odd lines are counted per split, and the counts added up over the splits of a file.
2. A split that starts outside quotes and has no odd and no blank line has a record per line, and
   its lines stay where they are. The lines of other splits are put in order, split by split; a
   running count then tells which of them belong together. Lines between the same two odd ones
   are one record, also across splits, and only such records are gathered.
3. Each record is parsed by itself. It counts as a row of the split where it starts.

As in any such file, quotes stand around whole fields and are doubled inside. After a quote that
is never closed, lines are records of their own; so no record is longer than its quoted texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import Scratch
from starloom.sources.csv_files import (
    FILE,
    SPLIT,
    SPOT,
    csv_options,
    located,
    with_corrupt,
)

_AT = (FILE, SPLIT)


def marked_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Physical lines with their place, an odd-quotes flag and a blank flag."""
    # Only "\n" ends a line here; "\r" in front of it goes with the end of a record.
    lines = located(spark.read.option("lineSep", "\n").text(paths))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.withColumns({
        "_odd": (quotes % 2).cast("int"),
        "_blank": (~F.col("value").rlike(r"[^\x00-\x20]")).cast("int"),
    })


def split_states(lines: DataFrame) -> DataFrame:
    """Per split: the odd lines before it in its file, those of the whole file, and whether
    each of its lines is a record."""
    counted = lines.groupBy(*_AT).agg(F.sum("_odd").alias("_odds"),
                                      F.sum("_blank").alias("_blanks"))
    file = Window.partitionBy(FILE)
    before = F.coalesce(F.sum("_odds").over(
        file.orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counted.select(
        *_AT, before.alias("_before"), F.sum("_odds").over(file).alias("_all"),
        ((before % 2 == 0) & (F.col("_odds") == 0) & (F.col("_blanks") == 0)).alias("_plain"))


def _records_of_split_lines(lines: DataFrame) -> DataFrame:
    """Records of splits in which lines and records differ, numbered within their split."""
    in_split = Window.partitionBy(*_AT).orderBy(SPOT)
    running = F.coalesce(F.sum("_odd").over(
        in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("_count", F.col("_before") + running)
    inside = (F.col("_count") % 2 == 1) | (F.col("_odd") == 1)
    pair = F.floor(F.col("_count") / 2)
    unclosed = (F.col("_all") % 2 == 1) & (pair == F.floor(F.col("_all") / 2))
    whole = lines.where(~inside | unclosed).where("_blank = 0").select(
        FILE, SPLIT, SPOT, F.col("value").alias("_record"))
    parts = lines.where(inside & ~unclosed).groupBy(FILE, pair.alias("_pair")).agg(
        F.sort_array(F.collect_list(F.struct(SPLIT, SPOT, "value"))).alias("_lines"))
    joined = parts.select(
        FILE, F.col("_lines")[0][SPLIT].alias(SPLIT), F.col("_lines")[0][SPOT].alias(SPOT),
        F.array_join(F.col("_lines")["value"], "\n").alias("_record"))
    return whole.unionByName(joined).withColumn(
        SPOT, F.row_number().over(in_split).cast("long"))


def _header(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records without the first one of each file, which has to name the columns."""
    heads = records.where(F.col(SPLIT) == 0).groupBy(*_AT).agg(
        F.min_by("_record", SPOT).alias("_head"), F.min(SPOT).alias("_first"))
    names = F.transform(F.split(_line("_head"), ","),
                        lambda name: F.trim(F.replace(name, F.lit('"'), F.lit(""))))
    wrong = heads.where(names != F.array(*map(F.lit, schema.fieldNames()))).limit(1).collect()
    if wrong:
        raise ValueError(f"header of {wrong[0][FILE]} is not {schema.fieldNames()}: "
                         f"{wrong[0]['_head']}")
    first = heads.select(*_AT, F.col("_first").alias(SPOT))
    return records.join(first, [*_AT, SPOT], "left_anti")


def _line(name: str) -> Column:
    """A line without the end of line that may be left on it."""
    return F.regexp_replace(name, r"\r$", "")


def read_records(spark: SparkSession, paths: list[str], schema: T.StructType, scratch: Scratch
                 ) -> DataFrame:
    """Rows of CSV files under a fixed schema, with file, split and running number, as
    :func:`starloom.sources.csv_files.read_rows` gives them, for texts with line breaks."""
    lines = scratch.keep(marked_lines(spark, paths), "lines")
    states = scratch.keep(split_states(lines), "splits")
    placed = lines.join(states, list(_AT))
    plain = placed.where("_plain").select(FILE, SPLIT, SPOT, F.col("value").alias("_record"))
    records = plain.unionByName(_records_of_split_lines(placed.where("NOT _plain")))
    records = _header(scratch.keep(records, "records"), schema)
    options = {name: str(value) for name, value in csv_options().items()
               if name not in ("header", "enforceSchema", "multiLine")}
    full = with_corrupt(schema)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    row = F.from_csv(_line("_record"), fields, options)
    return records.select(row.alias("_row"), FILE, SPLIT, SPOT).select(
        *[F.col(f"_row.{name}").alias(name) for name in full.fieldNames()], FILE, SPLIT, SPOT)
