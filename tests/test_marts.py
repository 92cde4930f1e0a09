from __future__ import annotations

import datetime as dt

from fixtures import TEN, at, built, history, raw, snap
from pyspark.sql import functions as F

from fleetstate.operators.staging import stage_snapshots
from fleetstate.plans import audit


def test_staging(spark):
    rows = [
        snap(at("2024-01-06 08:59"), True),
        snap(at("2024-01-06 09:00"), False, wait=50),
        snap(at("2024-01-06 21:59"), True),
        snap(at("2024-01-06 22:00"), True),
        snap(at("2024-01-08 12:00"), True, wait=20),
        snap(at("2024-01-08 12:15"), None, wait=20),
    ]
    got = stage_snapshots(raw(spark, rows)).orderBy("captured_at").collect()
    assert [r.wait_time_minutes for r in got] == [None, 0, 20, None]
    assert [(r.captured_hour, r.day_name, r.is_weekend) for r in got[:3]] == [
        (9, "Saturday", True),
        (21, "Saturday", True),
        (12, "Monday", False),
    ]
    assert got[0].captured_date == dt.date(2024, 1, 6)
    assert "source_last_updated" not in got[0]


def test_ride_never_down(spark):
    _, _, rides, daily, _ = built(spark, history("O O O", wait=20))
    ride = rides.first()
    assert (ride.uptime_pct, ride.downtime_event_count, ride.total_downtime_minutes) == (100.0, 0, 0)
    assert (ride.avg_downtime_minutes, ride.longest_downtime_minutes, ride.guest_impact_score) == (0.0, 0, 0.0)
    assert (daily.first().downtime_events, daily.first().downtime_minutes) == (0, 0)


def test_ride_never_open(spark):
    _, _, rides, _, parks = built(spark, history("C C C", wait=20))
    ride = rides.first()
    assert (ride.uptime_pct, ride.avg_wait_when_open, ride.guest_impact_score) == (0.0, None, 0.0)
    assert ride.total_downtime_minutes == 45
    assert parks.first().avg_wait_across_rides is None


def test_guest_impact_weighs_downtime_by_demand(spark):
    rows = history("O C C C C", 1, wait=90) + history("O C C C C", 2, wait=10)
    rides = {r.ride_id: r for r in built(spark, rows)[2].collect()}
    assert rides[1].guest_impact_score == 90.0
    assert rides[2].guest_impact_score == 10.0
    assert rides[1].peak_wait_observed == 90


def test_unknown_status_counts_as_closed_in_rollups(spark):
    _, events, rides, daily, _ = built(spark, history("C ? C"))
    assert daily.first().closed_snapshots == 3
    assert daily.first().downtime_events == events.count() == 2
    assert rides.first().uptime_pct == 0.0


def test_outage_over_two_days_is_booked_on_the_first(spark):
    rows = [snap(at("2024-01-03 21:45"), False), snap(at("2024-01-04 09:00"), False)]
    daily = built(spark, rows)[3].orderBy("captured_date").collect()
    assert [(r.closed_snapshots, r.downtime_events, r.downtime_minutes) for r in daily] == [(1, 1, 30), (1, 0, 0)]


def test_waits(spark):
    rows = [
        snap(TEN, False, wait=50),
        snap(TEN + dt.timedelta(minutes=15), True),
        snap(TEN + dt.timedelta(minutes=30), True, wait=20),
    ]
    assert built(spark, rows)[2].first().avg_wait_when_open == 10.0


def test_renamed_ride_takes_the_greatest_name(spark):
    rows = [snap(TEN, True, name="a", land="Z"), snap(TEN + dt.timedelta(minutes=15), True, name="b", land="A")]
    _, _, rides, daily, _ = built(spark, rows)
    for row in (rides.first(), daily.first()):
        assert (row.ride_name, row.land_name) == ("b", "Z")
    assert daily.first().snapshots == rides.first().total_snapshots == 2


def test_ride_without_id_keeps_its_rows_but_joins_no_outage(spark):
    rows = history("O C", None, name="x") + history("O C", 5)
    rides = {r.ride_id: r for r in built(spark, rows)[2].collect()}
    assert rides[5].downtime_event_count == 1
    assert (rides[None].total_snapshots, rides[None].downtime_event_count) == (2, 0)


def test_park_scorecard_counts_distinct_rides(spark):
    rows = history("O C", 1) + history("O O O O", 2) + history("C", None, name="x")
    park = built(spark, rows)[4].first()
    assert (park.rides_tracked, park.rides_with_downtime) == (2, 1)
    assert park.park_uptime_pct == round(100 * 5 / 7, 2)
    assert (park.total_downtime_events, park.total_downtime_minutes, park.total_downtime_hours) == (1, 15, 0.3)


def test_plain_counts_equal_distinct_counts(spark):
    rows = [row for ride in range(8) for row in history("O C O C C", ride, park=f"Park {ride % 2}")]
    daily, parks = built(spark, rows)[3:]
    distinct = daily.groupBy("captured_date", "park_name").agg(
        F.count_distinct("ride_id").alias("rides_tracked"),
        F.count_distinct(F.when(F.col("downtime_events") > 0, F.col("ride_id"))).alias("rides_with_downtime"),
    )
    assert distinct.exceptAll(parks.select(distinct.columns)).isEmpty()


def test_empty_marts_keep_their_schemas(spark):
    for frame in built(spark, []):
        assert frame.columns and frame.collect() == []


def test_column_order_and_types(spark):
    _, events, rides, daily, parks = built(spark, history("O C"))
    kinds = lambda df: [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema]
    assert kinds(events) == [
        "downtime_event_id:string",
        "ride_id:int",
        "ride_name:string",
        "park_name:string",
        "land_name:string",
        "downtime_date:date",
        "downtime_started_at:timestamp_ntz",
        "last_observed_closed_at:timestamp_ntz",
        "closed_snapshot_count:bigint",
        "downtime_minutes:bigint",
        "downtime_hours:double",
        "started_hour:bigint",
        "started_day_name:string",
        "severity_band:string",
    ]
    assert kinds(rides) == [
        "ride_id:int",
        "ride_name:string",
        "park_name:string",
        "land_name:string",
        "uptime_pct:double",
        "downtime_event_count:bigint",
        "total_downtime_minutes:bigint",
        "avg_downtime_minutes:double",
        "longest_downtime_minutes:bigint",
        "avg_wait_when_open:double",
        "peak_wait_observed:int",
        "guest_impact_score:double",
        "total_snapshots:bigint",
        "first_observed_at:timestamp_ntz",
        "last_observed_at:timestamp_ntz",
    ]
    assert kinds(daily) == [
        "captured_date:date",
        "ride_id:int",
        "ride_name:string",
        "park_name:string",
        "land_name:string",
        "day_name:string",
        "is_weekend:boolean",
        "uptime_pct:double",
        "downtime_events:bigint",
        "downtime_minutes:bigint",
        "avg_wait_when_open:double",
        "peak_wait:int",
        "snapshots:bigint",
        "closed_snapshots:bigint",
    ]
    assert kinds(parks) == [
        "captured_date:date",
        "park_name:string",
        "day_name:string",
        "is_weekend:boolean",
        "rides_tracked:bigint",
        "park_uptime_pct:double",
        "total_downtime_events:bigint",
        "total_downtime_minutes:bigint",
        "total_downtime_hours:double",
        "avg_wait_across_rides:double",
        "peak_wait_in_park:int",
        "rides_with_downtime:bigint",
    ]


def test_dataset_profile_of_nothing(spark):
    assert tuple(audit.dataset_profile(raw(spark, [])).first()) == (0, 0, 0, None)


def test_dataset_profile_skips_unknown_status_in_the_rate(spark):
    assert tuple(audit.dataset_profile(raw(spark, history("O C ? O"))).first()) == (4, 1, 1, 2 / 3)
