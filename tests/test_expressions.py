import datetime
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealtide.functions import (
    blank_to_null, convert, local_date, parse_date, parse_ts, phone_number, row_json, source_key,
    source_name,
)
from dealtide.functions.keys import LATIN


def evaluate(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


UTC_TIMES = [
    ("2025-03-01T10:00:00+03:00", "2025-03-01 07:00:00"),
    ("2025-03-01 10:00:00+03", "2025-03-01 07:00:00"),
    ("2025-03-01T10:00:00Z", "2025-03-01 10:00:00"),
    ("2025-03-01 10:00:00 Europe/Riga", "2025-03-01 08:00:00"),
    ("2025-03-01 10:00", "2025-03-01 10:00:00"),
    ("  2025-03-01 ", "2025-03-01 00:00:00"),
    ("14.06.2025 09:20", "2025-06-14 09:20:00"),
    ("05.06.2025 09:20:31", "2025-06-05 09:20:31"),
    ("5.6.2025", "2025-06-05 00:00:00"),
    ("2025/06/15", "2025-06-15 00:00:00"),
    ("31.02.2025", None),
    ("2025-13-01", None),
    ("2025", None),
    ("2025-06", None),
    ("now", None),
    ("soon", None),
    ("", None),
    ("   ", None),
    (None, None),
]


def test_parse_ts(spark):
    got = evaluate(spark, [t for t, _ in UTC_TIMES],
                   F.date_format(parse_ts(F.col("t")), "yyyy-MM-dd HH:mm:ss"))
    assert [g[0] for g in got] == [e for _, e in UTC_TIMES]


ZONES = [
    # text, instant in UTC, the same with naive_tz +05:00
    ("2026-06-01 09:14:58 UTC", "2026-06-01 09:14:58", "2026-06-01 09:14:58"),
    ("2026-06-01 09:14:58 EST", "2026-06-01 14:14:58", "2026-06-01 14:14:58"),
    ("2026-06-01 09:14:58 msk", "2026-06-01 06:14:58", "2026-06-01 06:14:58"),
    ("2026-06-01 09:14:58+05", "2026-06-01 04:14:58", "2026-06-01 04:14:58"),
    ("2026-06-01 09:14:58 +0530", "2026-06-01 03:44:58", "2026-06-01 03:44:58"),
    ("2026-06-01T09:14+05:00", "2026-06-01 04:14:00", "2026-06-01 04:14:00"),
    ("2026-06-01T09:14Z", "2026-06-01 09:14:00", "2026-06-01 09:14:00"),
    ("01.06.2026 09:14 MSK", "2026-06-01 06:14:00", "2026-06-01 06:14:00"),
    ("2026/06/01 09:14:58.25 Europe/Riga", "2026-06-01 06:14:58", "2026-06-01 06:14:58"),
    ("2026-06-01 09:14:58", "2026-06-01 09:14:58", "2026-06-01 04:14:58"),
    ("2026-06-01 9:14", "2026-06-01 09:14:00", "2026-06-01 04:14:00"),
    ("2026-06-01", "2026-06-01 00:00:00", "2026-05-31 19:00:00"),
    # No zone that is understood, or no time at all.
    ("2026-06-01 09:14:58 UTC+05:00", None, None),
    ("2026-06-01 09:14:58 GMT+3", None, None),
    ("2026-06-01 09:14:58 XYZ", None, None),
    ("2026-06-01 09:14:58 No/Where", None, None),
    ("2026-06-01 25:14:58", None, None),
    ("2026-06-01 09:14:58 +05:00 x", None, None),
    ("2026-06-01 garbage", None, None),
    ("2026-06-01Z", None, None),
]


@pytest.mark.parametrize("zone,place", [("UTC", 1), ("+05:00", 2)])
def test_zones_are_never_dropped(spark, zone, place):
    got = evaluate(spark, [t[0] for t in ZONES],
                   F.date_format(parse_ts(F.col("t"), zone), "yyyy-MM-dd HH:mm:ss"))
    assert [g[0] for g in got] == [t[place] for t in ZONES]


DAYS = [
    ("2026-06-01", True), (" 2026-6-1 ", True), ("01.06.2026", True), ("2026/06/01", True),
    ("2026-06-01T23:59:59-11:00", True), ("01.06.2026 09:14", True),
    ("2026-06-01 09:14:58 EST", True), ("2026-06-01 garbage", False),
    ("2026-06-01Tgarbage", False), ("14.06.2026 nonsense", False), ("2026-06-01 24:99", False),
    ("2026-06-01 09:14:58 nonsense", False), ("2026-06-31", False), ("2026-06-012", False),
]


def test_only_a_valid_time_may_follow_a_date(spark):
    got = evaluate(spark, [t for t, _ in DAYS], parse_date(F.col("t")))
    assert [g[0] for g in got] == [datetime.date(2026, 6, 1) if ok else None for _, ok in DAYS]
    for text, ok in DAYS:
        if not ok:
            with pytest.raises(Exception, match="not a valid date"):
                evaluate(spark, [text], convert(F.col("t"), T.DateType()))


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
@pytest.mark.parametrize("zone", ["UTC", "+05:00", "-08:00"])
def test_the_day_of_an_instant_is_that_of_its_zone(spark, session, zone):
    texts = ["2026-06-15", "2026/06/15", "15.06.2026 23:30", "2026-06-15 00:10:00"]
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        got = evaluate(spark, texts, local_date(parse_ts(F.col("t"), zone), zone))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [g[0] for g in got] == [datetime.date(2026, 6, 15)] * 4


def test_naive_text_is_read_in_the_given_zone_and_not_in_that_of_the_session(spark):
    texts = ["14.06.2025 09:20", "2025-06-14T09:20:00Z"]
    expected = [1749874800, 1749892800]  # 04:20 UTC and 09:20 UTC
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = evaluate(spark, texts, F.unix_seconds(parse_ts(F.col("t"), naive_tz="+05:00")))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert [g[0] for g in got] == expected


def test_parse_date_keeps_the_written_day(spark):
    texts = ["2025-03-07T23:30:00-03:00", "05.04.2025 08:30", "2025/1/2", "20250102", None]
    got = evaluate(spark, texts, parse_date(F.col("t")))
    assert [g[0] for g in got] == [
        datetime.date(2025, 3, 7), datetime.date(2025, 4, 5), datetime.date(2025, 1, 2), None, None,
    ]


def test_source_keys(spark):
    spellings = {
        "Market": "market", "MARKET": "market", "Маркет": "market", "trade_fair": "trade_fair",
        "  Trade -- Fair! ": "trade_fair", "Щука и ёж": "schuka_i_ezh", "подъезд": "podezd",
        "Съёмка чая": "semka_chaya", "Юг": "yug", "цех №1": "ceh_1", "": None, "___": None,
        None: None, "№%": None,
    }
    got = evaluate(spark, list(spellings), source_key(F.col("t")))
    assert [g[0] for g in got] == list(spellings.values())


def test_source_name(spark):
    got = evaluate(spark, ["trade_fair", "ceh_1"], source_name(F.col("t")))
    assert got == [("Trade Fair",), ("Ceh 1",)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=20, max_size=40))
def test_source_keys_are_stable_and_well_formed(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    once = evaluate(spark, texts, source_key(F.col("t")), source_key(source_key(F.col("t"))))
    for key, again in once:
        assert key == again
        assert key is None or all(w and w.isascii() and w.isalnum() for w in key.split("_"))


def test_every_russian_letter_has_a_spelling():
    assert "".join(LATIN) == "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"


def test_blank_is_the_empty_string_only(spark):
    got = evaluate(spark, ["", " ", "x", None], blank_to_null(F.col("t")))
    assert got == [(None,), (" ",), ("x",), (None,)]


def test_phone_numbers(spark):
    texts = ["+7 902 555-14-01", "89035550303", "9035550303", "8 (903) 555 03 03", "ext. 12", " ",
             "+44 20 7946 0958", None]
    got = evaluate(spark, texts, phone_number(F.col("t")))
    assert [g[0] for g in got] == [
        "+79025551401", "+79035550303", "+79035550303", "+79035550303", "ext. 12", None,
        "+44 20 7946 0958", None,
    ]


def test_row_json_keeps_nulls(spark):
    df = spark.createDataFrame([("1", None, 'q"')], "a string, b string, c string")
    assert json.loads(df.select(row_json(df.columns)).first()[0]) == {"a": "1", "b": None, "c": 'q"'}


@pytest.mark.parametrize("text,kind,expected", [
    ("1.005", T.DecimalType(14, 2), "1.01"), ("-0.001", T.DecimalType(14, 2), "0.00"),
    ("70000", T.ShortType(), None), ("5.0", T.ShortType(), None), (" 5 ", T.ShortType(), "5"),
    ("on", T.BooleanType(), "True"), ("OFF", T.BooleanType(), "False"),
    (" ye ", T.BooleanType(), "True"), ("o", T.BooleanType(), None),
    ("1e3", T.DecimalType(14, 2), "1000.00"), ("NaN", T.DecimalType(14, 2), None),
    ("9999999999999", T.DecimalType(14, 2), None), ("12.03.2025", T.DateType(), "2025-03-12"),
    (None, T.ShortType(), None),
])
def test_convert(spark, text, kind, expected):
    lenient = evaluate(spark, [text], convert(F.col("t"), kind, "quarantine"))[0][0]
    assert (None if lenient is None else str(lenient)) == expected
    if text is not None and expected is None:
        with pytest.raises(Exception, match="not a valid"):
            evaluate(spark, [text], convert(F.col("t"), kind, "fail"))
    else:
        assert evaluate(spark, [text], convert(F.col("t"), kind, "fail"))[0][0] == lenient


