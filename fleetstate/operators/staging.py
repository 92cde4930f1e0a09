"""Raw snapshots to the cleaned business-hours grain."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstate.functions import calendar
from fleetstate.params import Params


def stage_snapshots(raw: DataFrame, p: Params = Params()) -> DataFrame:
    """Snapshots within business hours, with calendar columns. A closed ride has no wait, an open one at least 0."""
    at, hour = F.col("captured_at"), F.hour("captured_at")
    return raw.filter((hour >= p.open_hour) & (hour < p.close_hour)).select(
        "captured_at",
        F.to_date(at).alias("captured_date"),
        calendar.hour_of_day(at).alias("captured_hour"),
        calendar.day_name(at).alias("day_name"),
        calendar.is_weekend(at).alias("is_weekend"),
        "park_id",
        "park_name",
        "land_name",
        "ride_id",
        "ride_name",
        "is_open",
        "data_source",
        F.when(F.col("is_open"), F.coalesce("wait_time_minutes", F.lit(0))).alias("wait_time_minutes"),
    )
