"""Expressions as SQL text.

Wide projections are built from text and parsed once, which is many times faster on the driver than
chaining column objects. Every function takes and returns text for ``selectExpr``, ``where`` or ``expr``.
"""

from tallyloom.functions.columns import (
    cast_text,
    concat_present,
    exact_sum,
    guarded_ratio,
    month_end,
    plus_month_less_day,
    utc_instant,
    utc_timestamp,
)
from tallyloom.functions.sql import column_of, listed, literal, quoted, record, records
from tallyloom.functions.text import is_castable, is_date_time, is_decimal, is_json, is_key_value

__all__ = [
    "cast_text",
    "column_of",
    "concat_present",
    "exact_sum",
    "guarded_ratio",
    "is_castable",
    "is_date_time",
    "is_decimal",
    "is_json",
    "is_key_value",
    "listed",
    "literal",
    "month_end",
    "plus_month_less_day",
    "quoted",
    "record",
    "records",
    "utc_instant",
    "utc_timestamp",
]
