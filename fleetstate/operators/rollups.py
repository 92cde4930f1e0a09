"""Snapshots and outages counted by ride and by day.

All of them are plain aggregates: Spark combines them before the shuffle, so a ride or day that holds a large share
of the rows costs one row per task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from fleetstate.functions import calendar
from fleetstate.functions.numeric import ratio, round_half_up

NAMES = ["ride_name", "park_name", "land_name"]


def ride_day_totals(staged: DataFrame) -> DataFrame:
    """Ride x day, kept as sums so that it can be rolled up further. The one pass over the snapshots for all marts.

    A ride has one set of names but for a renaming, so the names are keys in a first step, and the greatest is picked
    from the few rows that leaves: a `max` of text over the snapshots would make Spark sort all of them.
    """
    wait, is_open = F.col("wait_time_minutes"), F.col("is_open")
    by_name = staged.groupBy("captured_date", "ride_id", *NAMES).agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.sum(F.when(is_open, 1).otherwise(0)).alias("open_snapshots"),
        # An unknown status counts as closed here.
        F.sum(F.when(is_open, 0).otherwise(1)).alias("closed_snapshots"),
        F.sum(wait).alias("wait_sum"),
        F.count(wait).alias("wait_count"),
        F.max(wait).alias("peak_wait"),
        F.min("captured_at").alias("first_observed_at"),
        F.max("captured_at").alias("last_observed_at"),
    )
    return _combine(by_name, "captured_date", "ride_id")


def _combine(totals: DataFrame, *keys: str) -> DataFrame:
    """Totals on a coarser grain. Names that are no keys take the greatest."""
    sums = ["snapshots", "open_snapshots", "closed_snapshots", "wait_sum", "wait_count"]
    return totals.groupBy(*keys).agg(
        *[F.max(name).alias(name) for name in NAMES if name not in keys],
        *[F.sum(column).alias(column) for column in sums],
        F.max("peak_wait").alias("peak_wait"),
        F.min("first_observed_at").alias("first_observed_at"),
        F.max("last_observed_at").alias("last_observed_at"),
    )


def ride_day_base(totals: DataFrame) -> DataFrame:
    """Ride x day with the average wait while open."""
    return totals.select(
        "captured_date",
        "ride_id",
        "ride_name",
        "park_name",
        "land_name",
        calendar.is_weekend(F.col("captured_date")).alias("is_weekend"),
        calendar.day_name(F.col("captured_date")).alias("day_name"),
        "snapshots",
        "open_snapshots",
        "closed_snapshots",
        _average_wait(),
        "peak_wait",
    )


def ride_base(totals: DataFrame) -> DataFrame:
    """One row per ride over its full history, rolled up from the days."""
    return _combine(_combine(totals, "ride_id", *NAMES), "ride_id").select(
        "ride_id",
        "ride_name",
        "park_name",
        "land_name",
        F.col("snapshots").alias("total_snapshots"),
        "open_snapshots",
        _average_wait(),
        F.col("peak_wait").alias("peak_wait_observed"),
        "first_observed_at",
        "last_observed_at",
    )


def ride_bitmaps(rows: DataFrame, *keys: str, **conditions: Column) -> DataFrame:
    """Which rides the rows of each group are of, and which of those that meet each condition, as bitmaps: one row for each
    group and stretch of ids (`bucket`), with `rides` and a column by the name of each condition.

    A ride without id is none, as in a distinct count. Unlike counts, bitmaps of many groups can be put together later.
    """
    ride = F.col("ride_id")
    place = F.bitmap_bit_position(ride)
    known = rows.filter(ride.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(ride).alias("bucket"))
    some = [F.bitmap_construct_agg(F.when(met, place)).alias(name) for name, met in conditions.items()]
    return known.agg(F.bitmap_construct_agg(place).alias("rides"), *some)


def merge_bitmaps(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Bitmaps on a coarser grain."""
    sets = [f.name for f in bitmaps.schema if isinstance(f.dataType, BinaryType)]
    return bitmaps.groupBy(*keys, "bucket").agg(*[F.bitmap_or_agg(name).alias(name) for name in sets])


def count_rides(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Distinct rides of each group, by the names of the bitmaps."""
    merged = merge_bitmaps(bitmaps, *keys)
    sets = [f.name for f in merged.schema if isinstance(f.dataType, BinaryType)]
    return merged.groupBy(*keys).agg(*[F.sum(F.bitmap_count(name)).alias(name) for name in sets])


def ride_day_outages(events: DataFrame) -> DataFrame:
    """Outages by ride and the date they began on."""
    return events.groupBy(F.col("downtime_date").alias("captured_date"), "ride_id").agg(
        F.count(F.lit(1)).alias("downtime_events"),
        F.sum("downtime_minutes").alias("downtime_minutes"),
    )


def ride_downtime_profile(events: DataFrame) -> DataFrame:
    """Outages by ride: how many, how long in all, on average and at most."""
    minutes = F.col("downtime_minutes")
    return events.groupBy("ride_id").agg(
        F.count(F.lit(1)).alias("downtime_event_count"),
        F.sum(minutes).alias("total_downtime_minutes"),
        round_half_up(F.avg(minutes), 1).alias("avg_downtime_minutes"),
        F.max(minutes).alias("longest_downtime_minutes"),
    )


def _average_wait() -> Column:
    return round_half_up(ratio(F.col("wait_sum"), F.col("wait_count")), 1).alias("avg_wait_when_open")
