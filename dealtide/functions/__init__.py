"""Column expressions. All of them are built from Spark's own functions."""

from dealtide.functions.casts import convert
from dealtide.functions.dates import day, local_date, parse_date, parse_ts
from dealtide.functions.keys import source_key, source_name, transliterate
from dealtide.functions.text import blank_to_null, phone_number, row_json

__all__ = [
    "blank_to_null", "convert", "day", "local_date", "parse_date", "parse_ts", "phone_number",
    "row_json", "source_key", "source_name", "transliterate",
]
