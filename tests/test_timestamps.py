"""Timestamps against an independent Python reading of the same values."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from curlew.operators.timestamps import normalise_timestamps

ROWS = "project_uid string, source_database_id long, upload_date string, download_date string, field_name string"
CLOCKS = "source_database_id long, time_zone string, numeric_date_order string"


def us(moment: datetime) -> int:
    return (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def local(zone: str, *parts: int) -> int:
    return us(datetime(*parts, tzinfo=ZoneInfo(zone)))


AMS, NYC = "Europe/Amsterdam", "America/New_York"
CASES = [
    (1, "2018-02-03", local(AMS, 2018, 2, 3)),
    (1, "03/02/2018", local(AMS, 2018, 2, 3)),
    (2, "03/02/2018", local(NYC, 2018, 3, 2)),
    (2, "17.04.2020 19:26", local(NYC, 2020, 4, 17, 19, 26)),
    (1, "17 augustus 2020", local(AMS, 2020, 8, 17)),
    (1, "2. März 2021, 07:30", local(AMS, 2021, 3, 2, 7, 30)),
    (1, "1 mei 2013", local(AMS, 2013, 5, 1)),
    (2, "August 15, 2024 22:06", local(NYC, 2024, 8, 15, 22, 6)),
    (2, "17-JAN-2022", local(NYC, 2022, 1, 17)),
    (2, "7/21/2012 9:19:57 PM", local(NYC, 2012, 7, 21, 21, 19, 57)),
    (2, "7/21/2012 12:05:00 AM", local(NYC, 2012, 7, 21, 0, 5)),
    (1, "20110513T174536Z", us(datetime(2011, 5, 13, 17, 45, 36, tzinfo=timezone.utc))),
    (1, "2013-11-16t11:35:40,945368579z", us(datetime(2013, 11, 16, 11, 35, 40, 945368, tzinfo=timezone.utc))),
    (1, "2014-11-27T20:19:31+0100", us(datetime(2014, 11, 27, 19, 19, 31, tzinfo=timezone.utc))),
    (1, "2019-04-07T22:55:47-04:00[America/New_York]", us(datetime(2019, 4, 8, 2, 55, 47, tzinfo=timezone.utc))),
    (1, "2016-08-03 23:35:51 UTC+05:30", us(datetime(2016, 8, 3, 18, 5, 51, tzinfo=timezone.utc))),
    (1, "Thu, 21 Mar 2024 10:18:55 GMT", us(datetime(2024, 3, 21, 10, 18, 55, tzinfo=timezone.utc))),
    (1, "1735585161", 1735585161 * 10**6),
    (1, "1365785327549", 1365785327549 * 1000),
    (1, "1600107919467130", 1600107919467130),
    (1, "1600107919467130123", 1600107919467130),
    # A local time that occurs twice is the earlier one, unless an abbreviation says which.
    (1, "2015-10-25 02:30:00", us(datetime(2015, 10, 25, 0, 30, tzinfo=timezone.utc))),
    (1, "2015-10-25 02:30:00 CET", us(datetime(2015, 10, 25, 1, 30, tzinfo=timezone.utc))),
    (1, "2015-10-25 02:30:00 CEST", us(datetime(2015, 10, 25, 0, 30, tzinfo=timezone.utc))),
    # A skipped one moves forward by the gap.
    (1, "2016-03-27 02:30", us(datetime(2016, 3, 27, 1, 30, tzinfo=timezone.utc))),
    (2, "2016-05-30 11:30:31 EDT", us(datetime(2016, 5, 30, 15, 30, 31, tzinfo=timezone.utc))),
    (1, " 2018-02-03 ", local(AMS, 2018, 2, 3)),
    (3, "1735585161", 1735585161 * 10**6),
]
NONE = [(1, v) for v in ("2019-02-30", "2021-13-05", "31/11/2018", "2020", "2016-04", "March 2018", "ca. 2014", "n.d.", "", " ", "-", "????-??-??", "99999999", "0000-00-00", "29 February 2019", "2018-01-01 25:00", "13/13/2018 1:00:00 PM", "x" * 100_000)]
NONE += [(2, "13/02/2018"), (3, "2018-02-03"), (4, "03/02/2018"), (None, "2018-02-03"), (1, None)]


def run(spark, values):
    rows = [(f"p{i}", s, v, None, "clash") for i, (s, v) in enumerate(values)]
    clocks = [(1, AMS, "DMY"), (2, NYC, "MDY"), (2, NYC, "MDY"), (3, "No/Where", "DMY"), (None, AMS, "DMY")]
    out = normalise_timestamps(spark.createDataFrame(rows, ROWS), spark.createDataFrame(clocks, CLOCKS))
    assert out.columns == ["project_uid", "field_name", "utc_us"]
    return {r[0]: r[2] for r in out.collect()}


def test_values(spark):
    found = run(spark, [c[:2] for c in CASES])
    for i, (source, value, expected) in enumerate(CASES):
        assert found.get(f"p{i}") == expected, (source, value)


def test_values_without_an_instant(spark):
    assert run(spark, NONE) == {}


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_session_zone_has_no_influence(spark, zone):
    before = run(spark, [c[:2] for c in CASES])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert run(spark, [c[:2] for c in CASES]) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_and_repeated_rows(spark):
    clocks = spark.createDataFrame([(1, AMS, "DMY")], CLOCKS)
    assert normalise_timestamps(spark.createDataFrame([], ROWS), clocks).count() == 0
    twice = spark.createDataFrame([("p", 1, "2018-02-03", "2018-02-03", "x")] * 2 + [(None, 1, "2018-02-03", None, "x")], ROWS)
    assert sorted(r[1] for r in normalise_timestamps(twice, clocks).collect()) == ["download_date", "upload_date"]
    assert normalise_timestamps(twice, clocks.limit(0)).count() == 0


def test_dotted_days_may_follow_the_source(spark):
    clocks = spark.createDataFrame([(1, AMS, "MDY")], CLOCKS)
    rows = spark.createDataFrame([("p", 1, "02.03.2018", "2018-02-03", "x"), ("q", 1, "31.01.2018", None, "x")], ROWS)
    day = lambda **options: {(r[0], r[1]): r[2] for r in normalise_timestamps(rows, clocks, **options).collect()}
    assert day()["p", "upload_date"] - day()["p", "download_date"] == 27 * 86_400_000_000 and ("q", "upload_date") in day()
    assert day(dotted_by_source=True)["p", "upload_date"] == day()["p", "download_date"] and ("q", "upload_date") not in day(dotted_by_source=True)
