"""Conversion of text to the type of a column, failing or reporting on malformed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.functions.dates import parse_date

# Spellings of booleans in the exports' source system that Spark does not know.
# It takes every unambiguous beginning of true / false / yes / no, and on / off.
TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")


def _lenient(text: Column, to: T.DataType) -> Column:
    if isinstance(to, T.BooleanType):
        word = F.lower(F.btrim(text))
        return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(
            word.isin(*FALSE_WORDS), F.lit(False)
        )
    if isinstance(to, T.DateType):
        return parse_date(text)
    return text.try_cast(to)


def convert(text: Column, to: T.DataType, on_error: str = "fail") -> Column:
    """Convert text. On a malformed value ``fail`` raises, ``quarantine`` gives NULL."""
    value = _lenient(text, to)
    if on_error == "quarantine":
        return value
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}")
    message = F.concat(F.lit(f"not a valid {to.simpleString()}: "), text)
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message).cast(to)))
