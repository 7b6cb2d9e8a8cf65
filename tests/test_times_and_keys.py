import datetime as dt

import pytest
from helpers import apply
from pyspark.sql import functions as F

from bugtide.functions import keys, times

MOMENTS = {
    "2024-01-15": dt.datetime(2024, 1, 15),
    " 2024-01-15 10:20:30 ": dt.datetime(2024, 1, 15, 10, 20, 30),
    "2024-01-15T10:20:30.123456": dt.datetime(2024, 1, 15, 10, 20, 30, 123456),
    "2024-01-15T10:20:30Z": dt.datetime(2024, 1, 15, 10, 20, 30),
    "2024-01-15 10:20:30 -08:00": dt.datetime(2024, 1, 15, 18, 20, 30),
    "2013-05-07T12:34:56.000+0200": dt.datetime(2013, 5, 7, 10, 34, 56),
    "15/Jan/24 10:20 PM": dt.datetime(2024, 1, 15, 22, 20),
    "15/Jan/24 22:20": dt.datetime(2024, 1, 15, 22, 20),
    "2024/01/15 10:20:30": dt.datetime(2024, 1, 15, 10, 20, 30),
    "01/15/2024": dt.datetime(2024, 1, 15),
    "junk": None,
    "": None,
    None: None,
    "2024-13-45": None,
    # Neither hour exists twice nor is skipped in UTC.
    "2024-03-31 02:30:00": dt.datetime(2024, 3, 31, 2, 30),
    "2024-10-27 02:30:00": dt.datetime(2024, 10, 27, 2, 30),
}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/Los_Angeles"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert dict(zip(MOMENTS, apply(spark, list(MOMENTS), times.parse_utc))) == MOMENTS
        epochs = {"0": dt.datetime(1970, 1, 1), "1705314030.5": dt.datetime(2024, 1, 15, 10, 20, 30, 500000),
                  "n/a": None, None: None, "NaN": None}
        assert dict(zip(epochs, apply(spark, list(epochs), times.from_epoch_seconds))) == epochs
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_durations_round_down(spark):
    start = dt.datetime(2024, 3, 30, 12)
    hours = [0, 23, 24, 47, -1, -24, -25]
    rows = [(start, start + dt.timedelta(hours=h)) for h in hours] + [(start, None), (None, start)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    found = df.select(times.whole_days(F.col("a"), F.col("b")), times.elapsed_days(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in found] == [0.0, 0.0, 1.0, 1.0, -1.0, -1.0, -2.0, None, None]
    assert [r[1] for r in found] == [h / 24 for h in hours] + [None, None]


def test_durations_across_a_change_to_summer_time(spark):
    start = dt.datetime(2024, 3, 31, 2, 30)  # skipped in Berlin
    df = spark.createDataFrame([(start, start + dt.timedelta(days=1))], "a timestamp_ntz, b timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert df.select(times.elapsed_days(F.col("a"), F.col("b"))).first()[0] == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_split_ids(spark):
    cases = {
        "12": ["12"],
        ' "12" ; 13|,\'14\' ': ["12", "13", "14"],
        "\"'15'\"": ["15"],
        '" 16 "': [" 16 "],
        ";;|": [],
        "": [],
        None: [],
    }
    assert dict(zip(cases, apply(spark, list(cases), keys.split_ids))) == cases


def test_row_digest_tells_rows_apart(spark):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("-", "ab"), ("a", None), ("a", "b")]
    df = spark.createDataFrame(rows, "x string, y string")
    found = [r[0] for r in df.select(keys.row_digest(["x", "y"])).collect()]
    assert len(set(found)) == 6 and found[0] == found[-1]


def test_reports_without_an_id_get_different_keys(spark):
    rows = [("t", "p", None, "one", ""), ("t", "p", None, "two", ""), ("t", "p", "1", "one", ""), ("t", "q", "1", "one", "")]
    df = spark.createDataFrame(rows, "s string, p string, i string, t string, b string")
    found = [r[0] for r in df.select(keys.report_key(*map(F.col, "spitb"))).collect()]
    assert len(set(found)) == 4


def test_parts_of_a_key_do_not_run_together(spark):
    rows = [("t", "x|1", "2", "", ""), ("t", "x", "1|2", "", ""), ("t", None, "1", "", ""), ("t", "", "1", "", "")]
    df = spark.createDataFrame(rows, "s string, p string, i string, t string, b string")
    assert df.select(keys.report_key(*map(F.col, "spitb")).alias("k")).distinct().count() == 4
