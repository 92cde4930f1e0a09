from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from fleetstate.functions import calendar, labels, numeric


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def values(spark, data, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_round_half_up_scales_first(spark):
    got = values(spark, [2.675, 1.005, 0.125, -0.125], "double", lambda c: numeric.round_half_up(c, 2))
    assert got == [2.68, 1.0, 0.13, -0.13]
    assert values(spark, [0.25, 0.35, 2.45, -0.25], "double", lambda c: numeric.round_half_up(c, 1)) == [
        0.3,
        0.4,
        2.5,
        -0.3,
    ]
    assert values(spark, [0.5, 1.5, 2.5, None], "double", lambda c: numeric.round_half_up(c, 0)) == [1, 2, 3, None]


def test_round_half_even(spark):
    assert values(spark, [0.125, 97.445, 0.375], "double", lambda c: numeric.round_half_even(c, 2)) == [
        0.12,
        97.44,
        0.38,
    ]


def test_to_whole_rounds_to_even(spark):
    assert values(spark, [2.5, 3.5, 2.7, -2.5, None], "double", numeric.to_whole) == [2, 4, 3, -2, None]


def test_ratio_and_percent_without_a_whole(spark):
    assert value(spark, numeric.percent(F.lit(1), F.lit(3))) == 100.0 / 3
    assert value(spark, numeric.percent(F.lit(1), F.lit(0))) is None
    assert value(spark, numeric.ratio(F.lit(1), F.lit(0))) is None


def test_exact_mean_does_not_depend_on_order(spark):
    data = [0.1] * 10 + [1e6 + 0.3, 0.7, None]
    forward = spark.createDataFrame([(v,) for v in data], "v double").coalesce(1)
    backward = spark.createDataFrame([(v,) for v in reversed(data)], "v double").coalesce(1)
    means = {df.agg(numeric.exact_mean(F.col("v"), 1)).first()[0] for df in (forward, backward)}
    assert means == {1000002.0 / 12}


def test_calendar(spark):
    days = [dt.datetime(2024, 1, d, 9, 5, 7, 120000) for d in (6, 7, 8)]
    assert values(spark, days, "timestamp_ntz", calendar.day_name) == ["Saturday", "Sunday", "Monday"]
    assert values(spark, days, "timestamp_ntz", calendar.is_weekend) == [True, True, False]
    assert values(spark, days[:1], "timestamp_ntz", calendar.hour_of_day) == [9]
    assert values(spark, days[:1], "timestamp_ntz", calendar.floor_hour) == [dt.datetime(2024, 1, 6, 9)]
    assert values(spark, days[:1], "timestamp_ntz", calendar.floor_second) == [dt.datetime(2024, 1, 6, 9, 5, 7)]
    assert values(spark, days[:1], "timestamp_ntz", calendar.minute_of_day) == [545]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_clock_is_utc_in_every_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Two instants that share one wall-clock time in New York.
        for hour in (5, 6):
            instant = F.lit(f"2024-11-03 0{hour}:30:00Z").cast("timestamp")
            assert value(spark, calendar.utc_wall_clock(instant)) == dt.datetime(2024, 11, 3, hour, 30)
        nanos = F.lit(1_704_067_201_234_567_891)
        assert value(spark, calendar.from_epoch_nanos(nanos)) == dt.datetime(2024, 1, 1, 0, 0, 1, 234567)
        # 02:30 does not exist in New York on that day.
        gap = F.lit("2024-03-10 02:30:59").cast("timestamp_ntz")
        assert value(spark, calendar.floor_hour(gap)) == dt.datetime(2024, 3, 10, 2)
        assert value(spark, calendar.day_name(gap)) == "Sunday"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_severity_bands(spark):
    got = values(spark, [0, 15, 29, 30, 59, 60, 119, 120, 500], "long", labels.severity_band)
    brief, moderate, significant, major = labels.SEVERITY_NAMES
    assert got == [brief] * 3 + [moderate] * 2 + [significant] * 2 + [major] * 2
    assert values(spark, list(labels.SEVERITY_NAMES), "string", labels.severity_rank) == [1, 2, 3, 4]


def test_outage_key(spark):
    key = labels.outage_key(F.lit(7), F.lit("2024-01-06 09:05:07.5").cast("timestamp_ntz"))
    assert value(spark, key) == hashlib.md5(b"7|2024-01-06 09:05:07.5").hexdigest()
    assert value(spark, labels.outage_key(F.lit(None).cast("int"), F.lit(0))) is None
