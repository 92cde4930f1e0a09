"""Hand-made snapshots: a status string per ride, one letter per capture."""

from __future__ import annotations

import datetime as dt

from fleetstate import Params, schema
from fleetstate.operators import rollups
from fleetstate.operators.staging import stage_snapshots
from fleetstate.plans import marts

STATUS = {"O": True, "C": False, "?": None}
TEN = dt.datetime(2024, 1, 3, 10, 0)  # a Wednesday
STEP = dt.timedelta(minutes=15)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def snap(
    captured_at, is_open, ride_id=1, wait=None, name=None, park="Park A", land="Land A", source="queue-times-api"
):
    return (captured_at, 1, park, land, ride_id, name or f"Ride {ride_id}", is_open, wait, str(captured_at), source)


def history(statuses: str, ride_id=1, start=TEN, **kwargs):
    """'O C C' -> three captures, 15 minutes apart."""
    letters = statuses.replace(" ", "")
    return [snap(start + i * STEP, STATUS[letter], ride_id, **kwargs) for i, letter in enumerate(letters)]


def raw(spark, rows):
    return spark.createDataFrame(rows, schema.SNAPSHOT)


def built(spark, rows, p=Params()):
    """Staging and the four marts."""
    staged = stage_snapshots(raw(spark, rows), p)
    totals, events = rollups.ride_day_totals(staged), marts.downtime_events(staged, p)
    daily = marts.agg_ride_daily(totals, events)
    return staged, events, marts.dim_rides(totals, events), daily, marts.agg_park_daily(daily)
