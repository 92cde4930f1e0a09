from __future__ import annotations

import datetime as dt
import random

import pytest
from fixtures import TEN, at, history, raw, snap
from pyspark.sql import functions as F

from fleetstate import Params, schema
from fleetstate.operators import islands
from fleetstate.operators.scan import in_ranges, running
from fleetstate.operators.staging import stage_snapshots
from fleetstate.plans import marts


@pytest.fixture(params=[3, 37])
def many_ranges(spark, request):
    """Ranges that are not joined where they are small."""
    settings = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def outages(spark, rows, p=Params()):
    found = marts.downtime_events(stage_snapshots(raw(spark, rows), p), p)
    return [r.downtime_minutes for r in found.orderBy("ride_id", "downtime_started_at", "ride_name").collect()]


@pytest.mark.parametrize(
    "statuses, expected",
    [
        ("C O", [15]),
        ("O O O", []),
        ("C C C", [45]),
        ("C O C O", [15, 15]),
        ("O C C", [30]),
        ("C ? C", [15, 15]),
        ("? ? C", [15]),
        ("C O CC O CCCC O CCCCCCCC", [15, 30, 60, 120]),
    ],
)
def test_runs_within_a_day(spark, statuses, expected):
    assert outages(spark, history(statuses)) == expected


def test_band_edges(spark):
    staged = stage_snapshots(raw(spark, history("C O CC O CCCC O CCCCCCCC")))
    bands = [r.severity_band for r in marts.downtime_events(staged).orderBy("downtime_started_at").collect()]
    assert bands == ["Brief (<30m)", "Moderate (30-60m)", "Significant (1-2h)", "Major (2h+)"]


def test_overnight_run_is_one_outage_of_its_first_day(spark):
    rows = [snap(at("2024-01-03 21:45"), False), snap(at("2024-01-04 09:00"), False)]
    (event,) = marts.downtime_events(stage_snapshots(raw(spark, rows))).collect()
    assert event.downtime_minutes == 30
    assert event.downtime_date == dt.date(2024, 1, 3)
    assert (event.downtime_started_at, event.last_observed_closed_at) == (rows[0][0], rows[1][0])
    assert (event.started_hour, event.started_day_name) == (21, "Wednesday")


def test_hours_outside_do_not_count(spark):
    assert outages(spark, [snap(at("2024-01-03 22:00"), False), snap(at("2024-01-04 08:45"), False)]) == []
    assert outages(spark, [snap(at("2024-01-03 09:00"), False), snap(at("2024-01-03 21:59"), False)]) == [30]


def test_missing_captures_do_not_end_a_run(spark):
    assert outages(spark, [snap(at("2024-01-03 10:00"), False), snap(at("2024-01-03 13:00"), False)]) == [30]


def test_renaming_splits_a_run(spark):
    names = ["a", "a", "b"]
    rows = [snap(TEN + i * dt.timedelta(minutes=15), False, name=n) for i, n in enumerate(names)]
    assert outages(spark, rows) == [30, 15]


def test_a_name_that_returns_is_the_same_outage(spark, many_ranges):
    """Names only group: a, b, a in one run of closed snapshots is two outages, not three, over days as well."""
    days = ["2024-01-03 20:00", "2024-01-03 21:00", "2024-01-04 10:00", "2024-01-05 10:00"]
    rows = [snap(at(day), False, name=name) for day, name in zip(days, "abab", strict=True)]
    assert outages(spark, rows) == [30, 30]


def test_minimum_duration(spark):
    assert outages(spark, history("C O C C"), Params(min_downtime_minutes=30)) == [30]


def test_rides_do_not_mix_and_missing_ids_are_a_ride(spark):
    rows = history("C C", 1) + history("C O C", 2)
    rows += [snap(when, False, None, name="x") for when in (TEN, at("2024-01-04 11:00"))]
    found = marts.downtime_events(stage_snapshots(raw(spark, rows))).collect()
    assert sorted((r.ride_id or 0, r.downtime_minutes) for r in found) == [(0, 30), (1, 30), (2, 15), (2, 15)]


def test_empty_input_keeps_the_schema(spark):
    staged = stage_snapshots(raw(spark, []))
    assert marts.downtime_events(staged).columns[0] == "downtime_event_id"
    assert marts.downtime_events(staged).collect() == []
    assert islands.status_groups(staged).collect() == []


def random_rows(seed: int):
    """Several rides over a few days, one of them with a third of all rows; unknown statuses and renamings occur."""
    rng = random.Random(seed)
    rows, taken = [], set()
    for _ in range(400):
        ride = 1 if rng.random() < 1 / 3 else rng.choice([2, 3, 4, None])
        # The hot ride has most of its rows within one hour.
        hour = 12 if ride == 1 and rng.random() < 0.7 else rng.randrange(8, 23)
        when = dt.datetime(2024, 1, rng.randrange(1, 5), hour, rng.randrange(60), rng.choice([0, 30]))
        if (ride, when) in taken:
            continue
        taken.add((ride, when))
        status = rng.choice([True, False, False, None]) if rng.random() < 0.3 else when.hour % 2 == 0
        rows.append(snap(when, status, ride, name=rng.choice(["n", "n", "n", "m"])))
    rng.shuffle(rows)
    return rows


def by_hand(rows):
    """(status groups, outages) by one walk over each ride."""
    groups, runs = {}, {}
    inside = sorted((r for r in rows if 9 <= r[0].hour < 22), key=lambda r: (r[4] or 0, r[0]))
    previous = {}
    for row in inside:
        captured_at, ride, name, status = row[0], row[4], row[5], row[6]
        last_status, number = previous.get(ride, (None, 0))
        changed = not (status is not None and status == last_status)
        number += changed
        previous[ride] = (status, number)
        groups[(ride, captured_at)] = (int(changed), number)
        if status is False:
            runs.setdefault((ride, name, number), []).append(captured_at)
    return groups, sorted((ride or 0, name, min(at_), max(at_), len(at_)) for (ride, name, _), at_ in runs.items())


@pytest.mark.parametrize("seed", range(4))
def test_joined_runs_equal_a_walk(spark, many_ranges, seed):
    rows = random_rows(seed)
    groups, runs = by_hand(rows)
    staged = stage_snapshots(raw(spark, rows))
    found = islands.downtime_islands(staged).collect()
    assert runs == sorted(
        (r.ride_id or 0, r.ride_name, r.downtime_started_at, r.last_observed_closed_at, r.closed_snapshot_count)
        for r in found
    )
    assert all(r.downtime_date == r.downtime_started_at.date() for r in found)
    numbered = islands.status_groups(staged).collect()
    assert groups == {(r.ride_id, r.captured_at): (r.is_status_change, r.status_group) for r in numbered}
    assert len(numbered) == len(groups)


def test_all_closed_snapshots_are_in_an_outage(spark):
    staged = stage_snapshots(raw(spark, random_rows(42)))
    closed = staged.filter(~F.col("is_open")).count()
    events = marts.downtime_events(staged, Params(min_downtime_minutes=0))
    assert events.agg(F.sum("closed_snapshot_count")).first()[0] == closed


def test_ties_of_two_sources_are_ordered(spark):
    rows = [
        snap(TEN, False, source="a"),
        snap(TEN, True, source="b"),
        snap(TEN + dt.timedelta(minutes=15), False, source="a"),
    ]
    assert outages(spark, rows) == outages(spark, rows[::-1]) == [15, 15]


@pytest.mark.parametrize("seed", range(3))
def test_copies_and_crowded_seconds_equal_a_walk(spark, many_ranges, seed):
    """A third of all rows is one snapshot many times over, in a second with others and with unknown statuses."""
    rng = random.Random(seed)
    hot = dt.datetime(2024, 1, 2, 12, 30)
    rows = [r for r in random_rows(seed) if r[0] != hot]
    rows += [snap(hot, False, 1)] * 150 + [snap(hot, True, 1, source="synthetic")] * rng.randrange(3)
    for micro in rng.sample(range(1, 10**6), 40):
        rows += [snap(hot.replace(microsecond=micro), rng.choice([True, False, False, None]), 1)] * rng.randrange(1, 5)
    rng.shuffle(rows)
    inside = [r for r in rows if 9 <= r[0].hour < 22]
    inside.sort(key=lambda r: (r[4] or 0, r[0], r[9], -1 if r[6] is None else r[6], r[5]))
    numbers, runs, previous = [], {}, {}
    for row in inside:
        status, number = previous.get(row[4], (None, 0))
        changed = not (row[6] is not None and row[6] == status)
        previous[row[4]] = (row[6], number + changed)
        numbers.append((row[4] or 0, row[0], row[9], str(row[6]), row[5], int(changed), number + changed))
        if row[6] is False:
            runs.setdefault((row[4] or 0, row[5], number + changed), []).append(row[0])
    staged = stage_snapshots(raw(spark, rows))
    found = islands.downtime_islands(staged).collect()
    assert sorted((k[0], k[1], min(v), max(v), len(v)) for k, v in runs.items()) == sorted(
        (r.ride_id or 0, r.ride_name, r.downtime_started_at, r.last_observed_closed_at, r.closed_snapshot_count)
        for r in found
    )
    grouped = islands.status_groups(staged).collect()
    expected = sorted((n[0], n[1], n[3], n[4], n[5], n[6]) for n in numbers)
    assert expected == sorted(
        (r.ride_id or 0, r.captured_at, str(r.is_open), r.ride_name, r.is_status_change, r.status_group) for r in grouped
    )


def test_copies_of_one_snapshot_are_dealt_out(spark, many_ranges):
    """One snapshot 10^5 times over lies in many ranges, is one outage and one group."""
    hot = spark.range(100_000, numPartitions=8).select(*[F.lit(v).alias(f.name) for v, f in zip(snap(TEN, False, 1), schema.SNAPSHOT)])
    staged = stage_snapshots(hot.select([F.col(f.name).cast(f.dataType) for f in schema.SNAPSHOT]).unionByName(raw(spark, history("O C", 2))))
    slim = staged.select(F.col("ride_id").cast("long").alias("ride_key"), *islands.IN_ORDER)
    sizes = [r["count"] for r in in_ranges(slim, "ride_key", *islands.IN_ORDER).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > many_ranges // 2 and max(sizes) < 2 * 100_000 / many_ranges
    assert sorted(r.closed_snapshot_count for r in islands.downtime_islands(staged).collect()) == [1, 100_000]
    spread = islands.status_groups(staged).filter("ride_id = 1")
    assert spread.agg(F.count(F.lit(1)), F.sum("is_status_change"), F.max("status_group")).first() == (100_000, 1, 1)


def test_running_totals_equal_a_walk(spark, many_ranges):
    rng = random.Random(11)
    rows = [(rng.choice([1, 1, 1, 2, 9]), rng.choice([None, *range(40)]), rng.randrange(-5, 50), rng.getrandbits(60)) for _ in range(600)]
    frame = spark.createDataFrame(rows, "k long, o long, v long, x long").repartition(5)
    found = running(frame, "k", ["o", "v", "x"], sums=["v"], xors=["x"]).collect()
    expected, before = [], {}
    for k, o, v, x in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3])):
        total, mixed = before.get(k, (0, 0))
        before[k] = (total + v, mixed ^ x)
        expected.append((k, -1 if o is None else o, v, x, *before[k]))
    assert sorted(expected) == sorted((r.k, -1 if r.o is None else r.o, r.v, r.x, r.v_so_far, r.x_so_far) for r in found)
    assert running(frame.limit(0), "k", ["o"], sums=["v"]).collect() == []
