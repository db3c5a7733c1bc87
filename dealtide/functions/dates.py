"""Dates and timestamps in the spellings that the exports use."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Most texts: ISO with seconds, and no zone or one that Spark reads as it stands.
_PLAIN_LOCAL = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?)?$"
_PLAIN_ZONED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)? ?(Z|[+-]\d{2}:\d{2})$"

# Other days and times whose parts stand at fixed places.
_PLAIN_DOTTED = r"^\d{2}\.\d{2}\.\d{4}( \d{2}:\d{2})?\z"
_PLAIN_SLASHED = r"^\d{4}/\d{2}/\d{2}\z"

_DOTTED = r"^(\d{1,2})\.(\d{1,2})\.(\d{4})(?=\D|$)"
_SLASHED = r"^(\d{4})/(\d{1,2})/(\d{1,2})(?=\D|$)"
# A day, and perhaps a time (the seconds may be missing), and perhaps a zone behind the time.
_PARTS = r"^(\d{4}-\d{1,2}-\d{1,2})(?:(?:[Tt]|\s+)(\d{1,2}:\d{2})(:\d{2}(?:\.\d+)?)?\s*(.*))?$"
_OFFSET = r"^([+-])(\d{1,2})(?::?(\d{2}))?$"
_REGION = r"^[A-Za-z]+(?:/[A-Za-z0-9_+-]+)+$"

# Offsets of zone abbreviations.
ABBREVIATIONS = {
    "Z": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "UT": "+00:00", "WET": "+00:00",
    "WEST": "+01:00", "CET": "+01:00", "CEST": "+02:00", "EET": "+02:00", "EEST": "+03:00",
    "MSK": "+03:00", "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00",
    "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}


def _iso(text: Column) -> Column:
    """Trimmed text with a dotted or slashed date rewritten to ISO."""
    trimmed = F.btrim(text)
    return (
        F.when(trimmed.rlike(_DOTTED), F.regexp_replace(trimmed, _DOTTED, "$3-$2-$1"))
        .when(trimmed.rlike(_SLASHED), F.regexp_replace(trimmed, _SLASHED, "$1-$2-$3"))
        .otherwise(trimmed)
    )


def _undotted(text: Column) -> Column:
    """``31.01.2024 10:20`` or its day alone, as ISO."""
    dash, clock = F.lit("-"), F.substring(text, 11, 6)
    iso_day = F.concat(F.substring(text, 7, 4), dash, F.substring(text, 4, 2), dash, F.substring(text, 1, 2))
    return F.concat(iso_day, F.when(clock != "", F.concat(clock, F.lit(":00"))).otherwise(""))


def _part(iso: Column, group: int) -> Column:
    """A group of the parts; NULL if it is empty, or the text is no date at all."""
    return F.nullif(F.regexp_extract(iso, _PARTS, group), F.lit(""))


def _local(iso: Column) -> Column:
    """Day and time as they stand, without the zone; NULL if either is wrong."""
    clock = F.concat(F.lit(" "), _part(iso, 2), F.coalesce(_part(iso, 3), F.lit(":00")))
    return F.concat(_part(iso, 1), F.coalesce(clock, F.lit(""))).try_cast("timestamp_ntz")


def _zone(zone: Column) -> Column:
    """A zone in a spelling that Spark reads: ``none`` if there is none, NULL if it is unknown.

    ``UTC+05:00`` and the like are unknown: systems disagree about the sign.
    """
    minutes = F.coalesce(F.nullif(F.regexp_extract(zone, _OFFSET, 3), F.lit("")), F.lit("00"))
    hours = F.lpad(F.regexp_extract(zone, _OFFSET, 2), 2, "0")
    offset = F.concat(F.regexp_extract(zone, _OFFSET, 1), hours, F.lit(":"), minutes)
    names = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    return (
        F.when(zone.isNull(), F.lit("none"))
        .when(zone.rlike(_OFFSET), offset)
        .when(zone.rlike(_REGION), zone)
        .otherwise(F.try_element_at(names, F.upper(zone)))
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used: else the generated code
    would hold each of its regular expressions many times over."""
    return F.transform(F.array(value), body)[0]


def _any_spelling(text: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the parts of a text: ``local``, day and time, and ``zone``."""
    def parts(iso: Column) -> Column:
        zone = _let(_part(iso, 4), _zone)
        return _let(F.struct(_local(iso).alias("local"), zone.alias("zone")), body)

    return _let(_iso(text), parts)


def _in_zone(local: Column, naive_tz: str) -> Column:
    return F.convert_timezone(F.lit(naive_tz), F.current_timezone(), local).cast("timestamp")


def parse_ts(text: Column, naive_tz: str = "UTC") -> Column:
    """Instant for ISO 8601, ``DD.MM.YYYY [HH:MM[:SS]]`` and ``YYYY/MM/DD``; NULL otherwise.

    A dotted date is always day-first. A time may be followed by an offset, an abbreviation of
    :data:`ABBREVIATIONS` or the name of a region; text with a zone that is not understood is no
    instant. Text without a zone is read in ``naive_tz``, whatever the session's zone is.
    """
    def instant(read: Column) -> Column:
        zoned = F.concat(read["local"].cast("string"), F.lit(" "), read["zone"])
        return F.when(read["zone"] == "none", _in_zone(read["local"], naive_tz)).otherwise(
            zoned.try_cast("timestamp")
        )

    trimmed = F.btrim(text)
    # The usual spellings need no higher-order function, for which Spark generates no code.
    return F.when(
        trimmed != "",
        F.when(trimmed.rlike(_PLAIN_LOCAL), _in_zone(trimmed.try_cast("timestamp_ntz"), naive_tz))
        .when(trimmed.rlike(_PLAIN_ZONED), trimmed.try_cast("timestamp"))
        .when(trimmed.rlike(_PLAIN_DOTTED), _in_zone(_undotted(trimmed).try_cast("timestamp_ntz"), naive_tz))
        .when(trimmed.rlike(_PLAIN_SLASHED),
              _in_zone(F.replace(trimmed, F.lit("/"), F.lit("-")).try_cast("timestamp_ntz"), naive_tz))
        .otherwise(_any_spelling(text, instant)),
    )


def parse_date(text: Column) -> Column:
    """Calendar date as written (an offset does not move it); NULL if it is not a date.

    After the day only a valid time may follow, with a zone that :func:`parse_ts` understands.
    """
    def written(read: Column) -> Column:
        return F.when(read["zone"].isNotNull(), read["local"].cast("date"))

    trimmed = F.btrim(text)
    return F.when(trimmed.rlike(r"^\d{4}-\d{2}-\d{2}$"), trimmed.try_cast("date")).otherwise(
        _any_spelling(text, written)
    )


def local_date(instant: Column, naive_tz: str = "UTC") -> Column:
    """Calendar date of an instant in ``naive_tz``, whatever the session's zone is."""
    local = F.convert_timezone(
        F.current_timezone(), F.lit(naive_tz), instant.cast("timestamp_ntz")
    )
    return local.cast("date")


def day(as_of: datetime.date | str | Column | None) -> Column:
    """The reference day of a report as a date column; today when it is not given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")
