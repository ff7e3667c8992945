"""Calendar source: one row per day of a closed range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import date_key


def date_dimension(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """The date dimension. Its size is fixed by the range (366 rows a year at most), which
    is why joins against it may broadcast it. Days of the week count from Monday = 1."""
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date")
    )
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        (weekday >= 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )
