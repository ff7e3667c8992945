"""Table schemas, rule bounds and fixed texts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)
PERCENT = T.DecimalType(5, 2)


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DATE, _TIME, _FLAG = T.DateType(), T.TimestampType(), T.BooleanType()

# Columns of the three source files, in file order.
SALES_FILE = _schema(
    ("order_id", _TEXT), ("order_date", _DATE), ("customer_id", _TEXT), ("product_id", _TEXT),
    ("quantity", _INT), ("unit_price", PRICE), ("total_amount", AMOUNT),
)
CUSTOMERS_FILE = _schema(
    ("customer_id", _TEXT), ("customer_name", _TEXT), ("email", _TEXT), ("phone", _TEXT),
    ("address", _TEXT), ("city", _TEXT), ("country", _TEXT), ("registration_date", _DATE),
)
PRODUCTS_FILE = _schema(
    ("product_id", _TEXT), ("product_name", _TEXT), ("category", _TEXT), ("subcategory", _TEXT),
    ("supplier", _TEXT), ("cost_price", PRICE), ("msrp", PRICE),
)

_LINEAGE = (
    ("file_name", _TEXT), ("load_timestamp", _TIME),
    ("processed_flag", _FLAG), ("error_message", _TEXT),
)


def _staging(file_schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("staging_id", _LONG), *file_schema.fields, *_schema(*_LINEAGE).fields]
    )


STAGING_SALES = _staging(SALES_FILE)
STAGING_CUSTOMERS = _staging(CUSTOMERS_FILE)
STAGING_PRODUCTS = _staging(PRODUCTS_FILE)

DIM_CUSTOMER = _schema(
    ("customer_key", _LONG), ("customer_id", _TEXT), ("customer_name", _TEXT), ("email", _TEXT),
    ("phone", _TEXT), ("address", _TEXT), ("city", _TEXT), ("country", _TEXT),
    ("registration_date", _DATE), ("customer_segment", _TEXT),
    ("valid_from", _DATE), ("valid_to", _DATE), ("is_current", _FLAG),
)
DIM_PRODUCT = _schema(
    ("product_key", _LONG), ("product_id", _TEXT), ("product_name", _TEXT), ("category", _TEXT),
    ("subcategory", _TEXT), ("supplier", _TEXT), ("cost_price", PRICE), ("msrp", PRICE),
    ("profit_margin", PERCENT), ("valid_from", _DATE), ("valid_to", _DATE), ("is_current", _FLAG),
)
FACT_SALES = _schema(
    ("sales_key", _LONG), ("date_key", _INT), ("customer_key", _LONG), ("product_key", _LONG),
    ("order_id", _TEXT), ("quantity", _INT), ("unit_price", PRICE), ("total_amount", AMOUNT),
    ("cost_amount", AMOUNT), ("profit_amount", AMOUNT), ("profit_margin", PERCENT),
    ("order_timestamp", _TIME),
)
LEDGER = _schema(
    ("process_id", _LONG), ("process_name", _TEXT), ("source_file", _TEXT),
    ("records_extracted", _LONG), ("records_transformed", _LONG), ("records_loaded", _LONG),
    ("start_time", _TIME), ("end_time", _TIME), ("status", _TEXT), ("error_message", _TEXT),
    ("output", _TEXT), ("event_time", _TIME),
)

# Columns whose change opens a new dimension version.
CUSTOMER_TRACKED = ("customer_name", "email", "phone", "address", "city", "country")
PRODUCT_TRACKED = ("product_name", "category", "subcategory", "supplier", "cost_price", "msrp")

# Error texts of the quality rules.
QUANTITY_LOW = "Quantity below minimum"
QUANTITY_HIGH = "Quantity above maximum"
PRICE_LOW = "Unit price below minimum"
PRICE_HIGH = "Unit price above maximum"
TOTAL_MISMATCH = "Total amount mismatch"
DATE_OUTSIDE = "Order date out of range"
EMAIL_INVALID = "Invalid email format"
COST_INVALID = "Invalid cost price"
MSRP_INVALID = "Invalid MSRP"
MSRP_LOW = "MSRP lower than cost"

# Texts for cases which the quality rules leave open.
MALFORMED = "Malformed record"
MISSING_VALUE = "Missing value"


@dataclass(frozen=True)
class Rules:
    """Bounds of the quality rules and the calendar; defaults are fixed values."""

    min_unit_price: Decimal = Decimal("0.01")
    max_unit_price: Decimal = Decimal("10000.00")
    min_quantity: int = 1
    max_quantity: int = 1000
    start_date: dt.date = dt.date(2020, 1, 1)
    end_date: dt.date = dt.date(2025, 12, 31)
    tolerance: Decimal = Decimal("0.00")
    null_is_error: bool = False
    international: tuple[str, ...] = ("USA", "UK", "Australia")
    home_country: str = "Vietnam"
    major_cities: tuple[str, ...] = ("Hanoi", "Ho Chi Minh")


@dataclass(frozen=True)
class Star:
    """The four tables every report reads."""

    fact: object
    customer: object
    product: object
    date: object
