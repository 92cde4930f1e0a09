"""What was loaded or captured: counts, span, provenance."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstate.functions.numeric import ratio


def load_span(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("captured_at").alias("first_captured_at"),
        F.max("captured_at").alias("last_captured_at"),
    )


def load_sources(raw: DataFrame) -> DataFrame:
    """Rows by provenance, the biggest source first."""
    return raw.groupBy("data_source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "data_source")


def capture_summary(captures: DataFrame) -> DataFrame:
    """Rides and open rides per capture and park."""
    return captures.groupBy("captured_at", "park_name").agg(
        F.count(F.lit(1)).alias("rides"),
        F.sum(F.when(F.col("is_open"), 1).otherwise(0)).alias("open_rides"),
    )


def dataset_profile(raw: DataFrame) -> DataFrame:
    """Rows, days, rides and the share of open snapshots. Counted by (day, ride) first, so that the distinct counts
    start from few rows."""
    is_open = F.col("is_open")
    ride_days = raw.groupBy(F.to_date("captured_at").alias("day"), "ride_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(is_open).alias("known"),
        F.sum(F.when(is_open, 1).otherwise(0)).alias("open"),
    )
    return ride_days.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_distinct("day").alias("partitions"),
        F.count_distinct("ride_id").alias("rides"),
        ratio(F.sum("open"), F.sum("known")).alias("open_rate"),
    )
