"""Text values: blanks, phone numbers, a row as JSON."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    """The empty string becomes NULL. Spaces are kept: they are content."""
    return F.nullif(text, F.lit(""))


def phone_number(text: Column) -> Column:
    """``+7XXXXXXXXXX`` for Russian numbers in any spelling; anything else stays as it is."""
    digits = F.regexp_replace(text, r"\D", "")
    national = F.when(
        digits.rlike(r"^[78]\d{10}$"), F.right(digits, F.lit(10))
    ).when(digits.rlike(r"^\d{10}$"), digits)
    return F.coalesce(F.concat(F.lit("+7"), national), blank_to_null(F.btrim(text)))


def row_json(columns: Iterable[str]) -> Column:
    """The given columns as one JSON object. NULL columns stay in it, as ``null``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
