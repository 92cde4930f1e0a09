"""The dashboard's questions as queries over the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetstate.functions.calendar import WEEKDAYS
from fleetstate.functions.labels import severity_rank
from fleetstate.functions.numeric import exact_mean, exact_sum, round_half_even
from fleetstate.operators.rollups import count_rides
from fleetstate.params import Params, Scope


def default_range(park_daily: DataFrame, p: Params = Params()) -> DataFrame:
    """The last `lookback_days` + 1 days of the data, or all of it when there is less."""
    first, last = F.min("captured_date"), F.max("captured_date")
    return park_daily.agg(
        first.alias("min_date"),
        last.alias("max_date"),
        F.greatest(first, F.date_sub(last, p.lookback_days)).alias("default_start"),
    )


def default_scope(park_daily: DataFrame, p: Params = Params()) -> Scope:
    """All parks over the default range."""
    dates = default_range(park_daily, p).first()
    return Scope(None, dates.default_start, dates.max_date)


def park_list(rides: DataFrame) -> DataFrame:
    return rides.select("park_name").distinct().orderBy("park_name")


def in_parks(df: DataFrame, parks: Sequence[str] | None) -> DataFrame:
    park = F.col("park_name")
    return df.filter(park.isNotNull() if parks is None else park.isin(list(parks)))


def in_scope(df: DataFrame, scope: Scope, date: str = "captured_date") -> DataFrame:
    """Rows of the chosen parks within the inclusive date range."""
    return in_parks(df, scope.parks).filter(F.col(date).between(F.lit(scope.start), F.lit(scope.end)))


def kpi_fleet(ride_daily: DataFrame, events: DataFrame, scope: Scope) -> DataFrame:
    """One row: uptime of the fleet, outages, hours lost, average outage (NULL when there was none)."""
    no_long, no_double = F.lit(None).cast("long"), F.lit(None).cast("double")
    days = in_scope(ride_daily, scope).select(
        "snapshots", "closed_snapshots", no_double.alias("downtime_hours"), no_long.alias("downtime_minutes")
    )
    outages = in_scope(events, scope, "downtime_date").select(
        no_long.alias("snapshots"), no_long.alias("closed_snapshots"), "downtime_hours", "downtime_minutes"
    )
    totals = days.unionByName(outages).agg(
        F.coalesce(F.sum("snapshots"), F.lit(0)).alias("total_snapshots"),
        F.coalesce(F.sum("closed_snapshots"), F.lit(0)).alias("closed_snapshots"),
        F.count("downtime_minutes").alias("downtime_events"),
        F.coalesce(exact_sum(F.col("downtime_hours"), 2), F.lit(0.0)).alias("downtime_hours"),
        F.avg("downtime_minutes").alias("avg_outage_minutes"),
    )
    return totals.select(
        "total_snapshots",
        "closed_snapshots",
        _uptime("total_snapshots", "closed_snapshots").alias("fleet_uptime_pct"),
        "downtime_events",
        "downtime_hours",
        "avg_outage_minutes",
    )


def kpi_prior_delta(ride_daily: DataFrame, scope: Scope) -> DataFrame:
    """Fleet uptime now, over the period of equal length before, and the difference (NULL without a prior period)."""
    both = Scope(scope.parks, scope.prior_start, scope.end)
    now = F.col("captured_date") >= F.lit(scope.start)
    totals = in_scope(ride_daily, both).agg(
        *[
            F.coalesce(F.sum(F.when(when, F.col(column))), F.lit(0)).alias(f"{period}_{column}")
            for period, when in (("now", now), ("prior", ~now))
            for column in ("snapshots", "closed_snapshots")
        ],
        F.count(F.when(~now, 1)).alias("prior_rows"),
    )
    had_prior = F.col("prior_rows") > 0
    uptimes = totals.select(
        _uptime("now_snapshots", "now_closed_snapshots").alias("uptime_pct"),
        F.when(had_prior, _uptime("prior_snapshots", "prior_closed_snapshots")).alias("prior_uptime_pct"),
    )
    return uptimes.withColumn("uptime_delta", F.col("uptime_pct") - F.col("prior_uptime_pct"))


def uptime_trend(park_daily: DataFrame, scope: Scope, p: Params = Params()) -> DataFrame:
    """Plain mean of the parks by date, and its mean over the last seven dates that have data."""
    daily = (
        in_scope(park_daily, scope)
        .groupBy("captured_date")
        .agg(exact_mean(F.col("park_uptime_pct"), 2).alias("uptime_pct"))
    )
    # One row per calendar date is left, so the window without a partition stays small for any amount of data.
    last_rows = Window.orderBy("captured_date").rowsBetween(1 - p.rolling_rows, Window.currentRow)
    return daily.withColumn("rolling_7d", F.avg("uptime_pct").over(last_rows))


def park_scorecard(park_daily: DataFrame, scope: Scope) -> DataFrame:
    """Parks over the range, the least available first."""
    return (
        in_scope(park_daily, scope)
        .groupBy("park_name")
        .agg(
            round_half_even(exact_mean(F.col("park_uptime_pct"), 2), 2).alias("uptime_pct"),
            F.sum("total_downtime_events").alias("events"),
            round_half_even(exact_sum(F.col("total_downtime_hours"), 1), 1).alias("hours"),
        )
        .orderBy("uptime_pct", "park_name")
    )


def distinct_rides(park_rides: DataFrame, scope: Scope) -> DataFrame:
    """Rides seen, and rides that had an outage, by park over the whole range: each ride once, on however many dates."""
    counted = count_rides(in_scope(park_rides, scope), "park_name")
    return counted.select("park_name", F.col("rides").alias("rides_tracked"), F.col("with_downtime").alias("rides_with_downtime"))


def severity_mix(events: DataFrame, scope: Scope) -> DataFrame:
    """Outages by severity, in ascending order of severity."""
    return (
        in_scope(events, scope, "downtime_date")
        .filter(F.col("severity_band").isNotNull())
        .groupBy("severity_band")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(severity_rank(F.col("severity_band")))
    )


def outage_day_hour(events: DataFrame, scope: Scope) -> DataFrame:
    """Outages by weekday and hour of their start."""
    return (
        in_scope(events, scope, "downtime_date")
        .groupBy("started_day_name", "started_hour")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def outage_heatmap(events: DataFrame, scope: Scope, p: Params = Params()) -> DataFrame:
    """Weekdays in order, one column `h9`, `h10`, ... per business hour, 0 where nothing happened.

    Fails on an outage that began at another hour: its events were built with other hours than `p` has.
    """
    hours, hour = list(range(p.open_hour, p.close_hour)), F.col("started_hour")
    outside = F.concat(F.lit("an outage began outside of business hours, at hour "), hour.cast("string"))
    counts = (
        outage_day_hour(events, scope)
        .withColumn("started_hour", F.when(hour.isin(hours), hour).otherwise(F.raise_error(outside)))
        .groupBy("started_day_name")
        .pivot("started_hour", hours)
        .agg(F.sum("events"))
        .select("started_day_name", *[F.col(str(h)).alias(f"h{h}") for h in hours])
    )
    week = events.sparkSession.createDataFrame(list(enumerate(WEEKDAYS)), "position int, started_day_name string")
    # Only seven names exist.
    filled = week.join(F.broadcast(counts), "started_day_name", "left").fillna(0)
    return filled.orderBy("position").drop("position")


def top_impact_rides(rides: DataFrame, parks: Sequence[str] | None, p: Params = Params()) -> DataFrame:
    """The rides whose outages cost the most, in ascending order as the chart draws them. Ties go by ride."""
    top = in_parks(rides, parks).orderBy(F.desc("guest_impact_score"), "ride_id").limit(p.top_rides)
    return top.orderBy("guest_impact_score", F.desc("ride_id")).select(
        "ride_id", "ride_name", "guest_impact_score", "uptime_pct", "downtime_event_count", "avg_wait_when_open"
    )


def ride_detail(rides: DataFrame, parks: Sequence[str] | None) -> DataFrame:
    """The table behind the ranking, the costliest ride first."""
    return (
        in_parks(rides, parks)
        .select(
            "ride_name",
            "park_name",
            "land_name",
            "uptime_pct",
            "downtime_event_count",
            "avg_downtime_minutes",
            "longest_downtime_minutes",
            "avg_wait_when_open",
            "guest_impact_score",
        )
        .orderBy(F.desc("guest_impact_score"), "ride_name")
    )


def _uptime(total: str, closed: str):
    """100 * open / total, 0 when there are no snapshots."""
    return F.lit(100.0) * (F.col(total) - F.col(closed)) / F.greatest(F.col(total), F.lit(1))
