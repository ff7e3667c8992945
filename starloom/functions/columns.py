"""Column expressions shared by cleaning, loading and reports. All run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schemas import PERCENT, Rules


def capitalise_first(col: Column) -> Column:
    """First letter upper, everything after it lower (``initcap`` would raise every word)."""
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 2147483647)))


def date_key(col: Column) -> Column:
    """Calendar date as the integer yyyymmdd."""
    return F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)


def month_of_key(key: Column) -> Column:
    """yyyymm part of a date key."""
    return F.floor(key / 100).cast("int")


def day_of_key(key: Column) -> Column:
    """The day of a date key, yyyymmdd."""
    return F.make_date(F.floor(key / 10000).cast("int"), month_of_key(key) % 100, key % 100)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that is NULL for a zero divisor, also in ANSI mode."""
    return top / F.nullif(bottom, F.lit(0).cast("int"))


def fit(col: Column, kind: T.DecimalType) -> Column:
    """Clip into a decimal type, as a column of that type would hold the value; NULL stays."""
    bound = F.lit("9" * (kind.precision - kind.scale) + "." + "9" * kind.scale).cast(kind)
    return F.when(col > bound, bound).when(col < -bound, -bound).otherwise(col).cast(kind)


def product_margin(cost: Column, msrp: Column) -> Column:
    """Share of the list price that is margin, in percent, halves away from zero."""
    return fit(F.round(ratio(msrp - cost, msrp) * 100, 2), PERCENT)


def sale_margin(profit: Column, total: Column) -> Column:
    """Profit in percent of the total, halves to even; 0 where the total is not positive."""
    share = F.bround(profit / F.when(total > 0, total) * 100, 2)
    return fit(F.when(total > 0, share).otherwise(F.lit(0)), PERCENT)


def customer_segment(country: Column, city: Column, rules: Rules) -> Column:
    return (
        F.when(country.isin(*rules.international), "INTERNATIONAL")
        .when((country == rules.home_country) & city.isin(*rules.major_cities), "MAJOR_CITY")
        .otherwise("OTHER")
    )


def customer_tier(value: Column) -> Column:
    return (
        F.when(value > 10000, "VIP")
        .when(value > 5000, "Premium")
        .when(value > 1000, "Regular")
        .otherwise("Basic")
    )
