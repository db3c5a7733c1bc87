"""Findings: what is wrong with a row, kept beside the row until accepted and rejected part.

A cleaning step annotates every raw row once, with its typed values, its findings, whether it is
dropped, and its source text. The accepted table and the journal are two filters of that.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.functions import blank_to_null, convert, local_date, parse_ts, row_json
from dealtide.model import TABLES
from dealtide.operators.duplicates import add_id

FINDINGS, DROPPED, KEY, SOURCE = "_findings", "_dropped", "_record_key", "_source_row"
#: Has the row any finding? A plain condition: Spark generates code for it as a filter, and not for lists.
FOUND = "_found"

#: Rules for defects that go unnoticed without this journal; see :func:`journal`.
EXTRA_RULES = (
    "FK_NULL", "SKU_NULL", "TS_UNPARSED", "CAST_FAILED", "SHIPMENT_DEAL_MISSING",
)


@dataclass(frozen=True)
class Finding:
    rule_id: str
    severity: str
    when: Column
    message: Column | str
    drops: bool = False


@dataclass(frozen=True)
class Parsed:
    """A raw text that is to be converted to the type of its column in the model."""

    text: Column
    #: dates that may be written as timestamps are read as an instant first
    as_instant: bool = False


def _any(conditions: Iterable[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def _note(rule_id: str, severity: str, when: Column, message: Column | str) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(
        when,
        F.struct(
            F.lit(rule_id).alias("rule_id"),
            F.lit(severity).alias("severity"),
            F.coalesce(text, F.lit(rule_id)).alias("reason"),
        ),
    )


def annotate(
    rows: DataFrame,
    table: str,
    raw_columns: Iterable[str],
    record_key: Column,
    values: Mapping[str, Column | Parsed],
    findings: Iterable[Finding] = (),
    on_cast_error: str = "fail",
    naive_tz: str = "UTC",
) -> DataFrame:
    """Typed columns of ``table`` plus the five columns of the findings.

    Values are converted only in rows that stay: a malformed number in a dropped row is no
    reason to abort. The steps are columns of their own, so that each value is parsed and each
    condition is tested once per row, however often it is used. Lists are made only of rows with findings.
    """
    spec = TABLES[table]
    findings = list(findings)
    columns = [c for c in spec.columns if c in values]
    seen = {f"_when{i}": F.coalesce(f.when, F.lit(False)) for i, f in enumerate(findings)}
    rows = rows.withColumns(seen)
    rows = rows.withColumn(
        "_lost", _any(F.col(name) for name, f in zip(seen, findings) if f.drops)
    )
    stays = ~F.col("_lost")

    notes = [
        _note(f.rule_id, f.severity, F.col(name), f.message) for name, f in zip(seen, findings)
    ]
    noted = [F.col(name) for name in seen]
    typed: dict[str, Column] = {}
    malformed: list[Column] = []
    for column in columns:
        value, to = values[column], spec.type_of(column)
        result = F.col(f"_to_{column}")
        if not isinstance(value, Parsed):
            typed[column] = value.cast(to)
        elif value.as_instant or isinstance(to, T.TimestampType):
            instant = parse_ts(value.text, naive_tz)
            # The day is that of the zone in which the text was read, not of the session's.
            read = instant if isinstance(to, T.TimestampType) else local_date(instant, naive_tz)
            typed[column] = F.when(stays, read.cast(to))
            unread = stays & result.isNull() & blank_to_null(F.btrim(value.text)).isNotNull()
            text = F.concat(F.lit(f"{column} is not a date: "), value.text)
            noted.append(unread)
            notes.append(_note("TS_UNPARSED", "warning", unread, text))
        else:
            typed[column] = F.when(stays, convert(value.text, to, on_cast_error))
            if on_cast_error == "quarantine":
                wrong = stays & result.isNull() & value.text.isNotNull()
                malformed.append(wrong)
                noted.append(wrong)
                text = F.concat(F.lit(f"{column} is not {to.simpleString()}: "), value.text)
                notes.append(_note("CAST_FAILED", "error", wrong, text))

    rows = rows.withColumns({f"_to_{c}": typed[c] for c in columns})
    rows = rows.withColumns({
        FOUND: F.coalesce(_any(noted), F.lit(False)),
        DROPPED: _any([F.col("_lost"), *malformed]),
    })
    return rows.select(
        *[F.col(f"_to_{c}").alias(c) for c in columns],
        _listed(notes).alias(FINDINGS),
        FOUND,
        DROPPED,
        record_key.alias(KEY),
        F.when(F.col(FOUND), row_json(raw_columns)).alias(SOURCE),
    )


_FINDING_LIST = "array<struct<rule_id:string,severity:string,reason:string>>"


def _listed(notes: Iterable[Column]) -> Column:
    """The notes that are not NULL, as a list; built without a higher-order function, for which Spark generates no
    code."""
    none = F.array().cast(_FINDING_LIST)
    lists = [F.when(note.isNotNull(), F.array(note)).otherwise(none) for note in notes]
    return F.when(F.col(FOUND), F.concat(*lists)).otherwise(none) if lists else none


def accepted(annotated: DataFrame) -> DataFrame:
    """The rows of the typed table."""
    kept = annotated.filter(~F.col(DROPPED))
    return kept.drop(FINDINGS, FOUND, DROPPED, KEY, SOURCE)


def entries(annotated: DataFrame, table: str, extra: bool = True) -> DataFrame:
    """One row per finding. ``extra=False`` leaves out the :data:`EXTRA_RULES`."""
    # No list is empty here. The outer form keeps Spark from testing that on the lists of all rows.
    found = annotated.filter(F.col(FOUND)).select(
        F.explode_outer(FINDINGS).alias("finding"), KEY, SOURCE
    )
    rows = found.select(
        F.col("finding.severity").alias("severity"),
        F.lit(table).alias("source_table"),
        F.col(KEY).alias("record_key"),
        F.col("finding.rule_id").alias("rule_id"),
        F.col("finding.reason").alias("reason"),
        F.col(SOURCE).alias("raw_data"),
    )
    return rows if extra else rows.filter(~F.col("rule_id").isin(*EXTRA_RULES))


def journal(
    entry_rows: DataFrame, run_id: str, logged_at: datetime.datetime | None = None
) -> DataFrame:
    """Journal entries with their id, run and time, in the order of the journal's columns."""
    content = ["severity", "source_table", "record_key", "rule_id", "reason", "raw_data"]
    stamp = F.current_timestamp() if logged_at is None else F.lit(logged_at).cast("timestamp")
    numbered = add_id(entry_rows, "reject_id", content)
    return numbered.withColumn("logged_at", stamp).withColumn("run_id", F.lit(run_id)).select(
        *TABLES["rejects"].columns
    )


def with_fields(entry_rows: DataFrame, fields: Mapping[str, str], raw: Column | None = None) -> DataFrame:
    """Journal entries with fields of their source rows: column name -> field, as text.

    ``raw``: the source row as VARIANT; by default ``raw_data`` is parsed, once for all fields. A field that
    the row lacks, or that is NULL, is NULL, and so are all of an entry without a source row or with text that
    is no JSON. A field's name may hold no double quote, backslash, question mark or line break.
    """
    raw = F.try_parse_json("raw_data") if raw is None else raw
    odd = [field for field in fields.values() if set(field) & set('"\\?\n') or not field]
    if odd:
        raise ValueError(f"no path of a VARIANT can name {odd}")
    return entry_rows.withColumns({
        name: F.try_variant_get(raw, f'$["{field}"]', "string") for name, field in fields.items()
    })


__all__ = [
    "EXTRA_RULES", "Finding", "Parsed", "accepted", "annotate", "entries", "journal", "with_fields",
]
