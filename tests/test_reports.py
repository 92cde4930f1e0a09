from __future__ import annotations

import datetime as dt

import pytest
from fixtures import TEN, at, built, history, snap

from fleetstate import Params, Scope
from fleetstate.operators import rollups
from fleetstate.plans import marts, reports

DAY = dt.date(2024, 1, 10)


@pytest.fixture(scope="module")
def marts_(spark):
    """Two parks over ten days, 2024-01-06 left out; ride 1 fails once a day, ride 2 never."""
    rows = []
    for day in (d for d in range(1, 11) if d != 6):
        start = dt.datetime(2024, 1, day, 10)
        rows += history("O C O O", 1, start, wait=30)
        rows += history("O O O O", 2, start, park="Park B", wait=10)
    return [df.cache() for df in built(spark, rows)]


def scope(first, last, parks=("Park A", "Park B")):
    return Scope(parks, dt.date(2024, 1, first), dt.date(2024, 1, last))


def test_default_range_looks_back_no_further_than_the_data(spark, marts_):
    parks = marts_[4]
    row = reports.default_range(parks).first()
    assert (row.default_start, row.max_date) == (dt.date(2024, 1, 1), DAY)
    assert reports.default_range(parks, Params(lookback_days=2)).first().default_start == dt.date(2024, 1, 8)
    everything = reports.default_scope(parks)
    assert everything == scope(1, 10, None)
    assert reports.in_scope(parks, everything).count() == parks.count()


def test_scope_is_inclusive_and_by_park(marts_):
    daily = marts_[3]
    assert reports.in_scope(daily, scope(2, 3)).count() == 4
    assert reports.in_scope(daily, scope(2, 3, ("Park B",))).count() == 2


def test_kpi_fleet(marts_):
    row = reports.kpi_fleet(marts_[3], marts_[1], scope(1, 2)).first()
    assert tuple(row) == (16, 2, 87.5, 2, 0.5, 15.0)


def test_kpi_fleet_of_nothing(marts_):
    assert tuple(reports.kpi_fleet(marts_[3], marts_[1], scope(6, 6)).first()) == (0, 0, 0.0, 0, 0.0, None)


def test_prior_period(marts_):
    daily = marts_[3]
    row = reports.kpi_prior_delta(daily, scope(3, 4, ("Park A",))).first()
    assert tuple(row) == (75.0, 75.0, 0.0)
    assert tuple(reports.kpi_prior_delta(daily, scope(1, 4)).first()) == (87.5, None, None)
    assert tuple(reports.kpi_prior_delta(daily, scope(6, 6)).first()) == (0.0, 87.5, -87.5)


def test_trend_rolls_over_rows_not_days(spark):
    uptimes = [(day, up) for day, up in zip([1, 2, 3, 4, 5, 7, 8, 9], [10.0, 20, 30, 40, 50, 60, 70, 80], strict=True)]
    rows = [(dt.date(2024, 1, day), "Park A", float(up)) for day, up in uptimes]
    parks = spark.createDataFrame(rows, "captured_date date, park_name string, park_uptime_pct double")
    trend = reports.uptime_trend(parks, scope(1, 10)).orderBy("captured_date").collect()
    assert [r.rolling_7d for r in trend] == [10.0, 15, 20, 25, 30, 35, 40, 50]


def test_scorecard_sorts_by_uptime(marts_):
    rows = [tuple(r) for r in reports.park_scorecard(marts_[4], scope(1, 2)).collect()]
    assert rows == [("Park A", 75.0, 2, 0.6), ("Park B", 100.0, 0, 0.0)]


def test_severity_mix_in_order(spark):
    rows = history("CCCCCCCC O C O CC O C O CCCC")
    mix = reports.severity_mix(built(spark, rows)[1], scope(1, 10)).collect()
    assert [(r.severity_band.split()[0], r["count"]) for r in mix] == [
        ("Brief", 2),
        ("Moderate", 1),
        ("Significant", 1),
        ("Major", 1),
    ]


def test_heatmap_has_every_day_and_hour(marts_):
    heat = reports.outage_heatmap(marts_[1], scope(1, 10))
    assert heat.columns == ["started_day_name"] + [f"h{h}" for h in range(9, 22)]
    rows = heat.collect()
    assert [r.started_day_name for r in rows][0::6] == ["Monday", "Sunday"]
    assert [r.h10 for r in rows] == [2, 2, 2, 1, 1, 0, 1]
    assert sum(sum(r[1:]) for r in rows) == 9


def test_top_rides_ascending_with_ties_by_ride(spark):
    rows = [row for ride in range(5) for row in history("O C", ride, wait=60)]
    rides = built(spark, rows)[2]
    top = reports.top_impact_rides(rides, ["Park A"], Params(top_rides=3)).collect()
    assert [r.ride_id for r in top] == [2, 1, 0]


def test_detail_and_parks(marts_):
    rides = marts_[2]
    assert [r.park_name for r in reports.park_list(rides).collect()] == ["Park A", "Park B"]
    assert [r.ride_name for r in reports.ride_detail(rides, ["Park A", "Park B"]).collect()] == ["Ride 1", "Ride 2"]
    assert reports.ride_detail(rides, ["Park B"]).count() == 1


def test_dim_reports_ignore_dates(spark):
    rides = built(spark, [snap(at("2023-05-01 10:00"), True, wait=5)])[2]
    assert reports.top_impact_rides(rides, ["Park A"]).count() == 1


def test_heatmap_loses_no_outage(spark):
    rows = [snap(at("2024-01-03 07:00"), False, 1), snap(at("2024-01-03 10:00"), False, 2)]
    early = Params(open_hour=7)
    events = built(spark, rows, early)[1]
    days = Scope(None, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    cells = reports.outage_heatmap(events, days, early).drop("started_day_name").collect()
    assert sum(sum(row) for row in cells) == reports.severity_mix(events, days).agg({"count": "sum"}).first()[0] == 2
    with pytest.raises(Exception, match="outside of business hours, at hour 7"):
        reports.outage_heatmap(events, days).collect()


def test_distinct_rides_over_a_range_count_each_once(spark):
    rows = [snap(TEN + dt.timedelta(days=d), not (ride == 40_000 and d == 1), ride) for d in range(3) for ride in (1, 2, 40_000, None)]
    rows += [snap(TEN + dt.timedelta(days=9), True, 7)]
    daily = built(spark, rows)[3]
    kept = marts.agg_park_rides(daily)
    scope = Scope(("Park A",), TEN.date(), TEN.date() + dt.timedelta(days=2))
    assert [tuple(r) for r in reports.distinct_rides(kept, scope).collect()] == [("Park A", 3, 1)]
    # Bitmaps of days are put together like those of all rows.
    whole = {r.bucket: bytes(r.rides) for r in rollups.ride_bitmaps(daily, "park_name").collect()}
    assert whole == {r.bucket: bytes(r.rides) for r in rollups.merge_bitmaps(kept, "park_name").collect()} and len(whole) == 2
