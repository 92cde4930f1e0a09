"""The four marts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstate.functions import calendar, labels
from fleetstate.functions.numeric import exact_mean, percent, round_half_up
from fleetstate.operators.islands import downtime_islands
from fleetstate.operators.rollups import ride_base, ride_bitmaps, ride_day_base, ride_day_outages, ride_downtime_profile
from fleetstate.params import Params


def fct_downtime_events(islands: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per outage that is long enough. Its length is the number of closed snapshots times the interval."""
    minutes, started = F.col("downtime_minutes"), F.col("downtime_started_at")
    return (
        islands.withColumn("downtime_minutes", F.col("closed_snapshot_count") * p.snapshot_interval_minutes)
        .filter(minutes >= p.min_downtime_minutes)
        .select(
            labels.outage_key(F.col("ride_id"), started).alias("downtime_event_id"),
            "ride_id",
            "ride_name",
            "park_name",
            "land_name",
            "downtime_date",
            "downtime_started_at",
            "last_observed_closed_at",
            "closed_snapshot_count",
            "downtime_minutes",
            round_half_up(minutes / F.lit(60.0), 2).alias("downtime_hours"),
            calendar.hour_of_day(started).alias("started_hour"),
            calendar.day_name(started).alias("started_day_name"),
            labels.severity_band(minutes).alias("severity_band"),
        )
    )


def downtime_events(staged: DataFrame, p: Params = Params()) -> DataFrame:
    """Staged snapshots straight to outages."""
    return fct_downtime_events(downtime_islands(staged), p)


def dim_rides(totals: DataFrame, events: DataFrame) -> DataFrame:
    """One row per ride: reliability over the full history, and what its outages cost given the demand for it."""
    joined = ride_base(totals).join(ride_downtime_profile(events), "ride_id", "left")
    zero = F.lit(0)
    lost = F.coalesce("total_downtime_minutes", zero)
    demand = F.coalesce("avg_wait_when_open", F.lit(0.0))
    return joined.select(
        "ride_id",
        "ride_name",
        "park_name",
        "land_name",
        round_half_up(percent(F.col("open_snapshots"), F.col("total_snapshots")), 2).alias("uptime_pct"),
        F.coalesce("downtime_event_count", zero).alias("downtime_event_count"),
        lost.alias("total_downtime_minutes"),
        F.coalesce("avg_downtime_minutes", F.lit(0.0)).alias("avg_downtime_minutes"),
        F.coalesce("longest_downtime_minutes", zero).alias("longest_downtime_minutes"),
        "avg_wait_when_open",
        "peak_wait_observed",
        round_half_up(lost * demand / F.lit(60.0), 0).alias("guest_impact_score"),
        "total_snapshots",
        "first_observed_at",
        "last_observed_at",
    )


def agg_ride_daily(totals: DataFrame, events: DataFrame) -> DataFrame:
    """Ride x date. An outage is booked on the date it began, so a day may have closed snapshots but no outage."""
    joined = ride_day_base(totals).join(ride_day_outages(events), ["captured_date", "ride_id"], "left")
    return joined.select(
        "captured_date",
        "ride_id",
        "ride_name",
        "park_name",
        "land_name",
        "day_name",
        "is_weekend",
        round_half_up(percent(F.col("open_snapshots"), F.col("snapshots")), 2).alias("uptime_pct"),
        F.coalesce("downtime_events", F.lit(0)).alias("downtime_events"),
        F.coalesce("downtime_minutes", F.lit(0)).alias("downtime_minutes"),
        "avg_wait_when_open",
        "peak_wait",
        "snapshots",
        "closed_snapshots",
    )


def agg_park_daily(ride_daily: DataFrame) -> DataFrame:
    """Date x park, weighted by snapshots.

    `ride_daily` has one row per date and ride, so within a date and park the rides are distinct already and a plain
    count does for a distinct one: no row has to be expanded, and a big park is combined before the shuffle.
    """
    snapshots, open_snapshots = F.col("snapshots"), F.col("snapshots") - F.col("closed_snapshots")
    had_outage = F.when(F.col("downtime_events") > 0, F.col("ride_id"))
    minutes, date = F.sum("downtime_minutes"), F.col("captured_date")
    return ride_daily.groupBy("captured_date", "park_name").agg(
        calendar.day_name(date).alias("day_name"),
        calendar.is_weekend(date).alias("is_weekend"),
        F.count("ride_id").alias("rides_tracked"),
        round_half_up(percent(F.sum(open_snapshots), F.sum(snapshots)), 2).alias("park_uptime_pct"),
        F.sum("downtime_events").alias("total_downtime_events"),
        minutes.alias("total_downtime_minutes"),
        round_half_up(minutes / F.lit(60.0), 1).alias("total_downtime_hours"),
        round_half_up(exact_mean(F.col("avg_wait_when_open"), 1), 1).alias("avg_wait_across_rides"),
        F.max("peak_wait").alias("peak_wait_in_park"),
        F.count(had_outage).alias("rides_with_downtime"),
    )


def agg_park_rides(ride_daily: DataFrame) -> DataFrame:
    """Date x park, which rides were seen (`rides`) and which had an outage (`with_downtime`): small enough to be kept for every
    date, and put together for any range of them."""
    return ride_bitmaps(ride_daily, "captured_date", "park_name", with_downtime=F.col("downtime_events") > 0)
