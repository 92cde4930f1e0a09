"""Engine inputs derived from the given tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstate import Scope
from fleetstate.functions.calendar import floor_hour
from fleetstate.params import LIVE_SOURCE, SEED_SOURCE

SCOPE = Scope(("Park 0", "Park 2"), dt.date(2024, 1, 16), dt.date(2024, 1, 30))
WANTED_PARKS = ("NATION_1", "NATION_7", "NATION_13", "NATION_99")
CAPTURED_AT = "2024-01-31 12:00:00"
BROKEN_REGION = 3
# Rides per landed payload: keeps a payload small however many suppliers there are.
RIDES_PER_PAYLOAD = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as captured status rows, waits still fractional."""
    event, user = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("captured_at"),
        (user % 4).alias("park_id"),
        F.concat(F.lit("Park "), user % 4).alias("park_name"),
        F.concat(F.lit("Land "), user % 7).alias("land_name"),
        user.alias("ride_id"),
        F.concat(F.lit("Ride "), user).alias("ride_name"),
        (~F.col("event_type").isin("error", "signup")).alias("is_open"),
        F.when(event % 10 != 0, F.col("value")).alias("wait_time_minutes"),
        F.col("ts").cast("string").alias("source_last_updated"),
        F.when(event % 5 == 0, SEED_SOURCE).otherwise(LIVE_SOURCE).alias("data_source"),
    )


def dirty_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with unknown statuses, renamed rides, and rows of a third source or of none."""
    event = F.col("event_id")
    return captures(spark, sf_dir).withColumns(
        {
            "is_open": F.when(event % 11 != 0, F.col("is_open")),
            "ride_name": F.when(event % 19 == 0, F.concat(F.lit("New "), "ride_id")).otherwise(F.col("ride_name")),
            "data_source": F.when(event % 7 == 0, F.lit(None)).when(event % 13 == 0, "other").otherwise(F.col("data_source")),
        }
    )


def hourly_captures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stored, incoming) captures whose keys collide: times cut to the hour, split by even and odd event."""
    hourly = captures(spark, sf_dir).withColumn("captured_at", floor_hour(F.col("captured_at")))
    even = F.col("event_id") % 2 == 0
    return hourly.filter(even), hourly.filter(~even)


def landed_payloads(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Suppliers as rides: a region is a park, a nation a land. Several payloads a park, of bounded size each.

    Dirty ones have ids as text, some of which are no number, waits that are no plain number, and the payloads of one
    region are broken off.
    """
    key = F.col("s_suppkey")
    wait = F.when(key % 13 == 0, "n/a").otherwise((key % 90).cast("string"))
    if dirty:
        wait = F.when(key % 17 == 0, "NaN").when(key % 19 == 0, "Infinity").when(key % 23 == 0, "35d").otherwise(wait)
    ride = F.struct(
        (F.when(key % 5 == 0, F.concat(F.lit("x"), key)).otherwise(key.cast("string")) if dirty else key).alias("id"),
        F.col("s_name").alias("name"),
        F.when(key % 11 != 0, F.col("s_acctbal") > 0).alias("is_open"),
        wait.alias("wait_time"),
        F.lit(CAPTURED_AT).alias("last_updated"),
    )
    nations = table(spark, sf_dir, "nation")
    lands = nations.join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    suppliers = table(spark, sf_dir, "supplier")
    listed = suppliers.join(lands, F.expr("s_nationkey = n_nationkey")).select(
        "r_regionkey",
        "r_name",
        "n_name",
        F.call_function("div", key, F.lit(RIDES_PER_PAYLOAD)).alias("part"),
        F.when((key % 7 == 0), ride).alias("top"),
        F.when((key % 7 != 0), ride).alias("nested"),
    )
    # A nation without suppliers is a land without rides.
    seen = suppliers.select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    empty = lands.join(seen, "n_nationkey", "left_anti").select(
        "r_regionkey", "r_name", "n_name", F.lit(0).alias("part")
    )
    listed = listed.unionByName(empty, allowMissingColumns=True)
    by_land = listed.groupBy("r_regionkey", "r_name", "part", "n_name").agg(
        F.collect_list("top").alias("top"), F.collect_list("nested").alias("nested")
    )
    by_park = by_land.groupBy("r_regionkey", "r_name", "part").agg(
        F.flatten(F.collect_list("top")).alias("rides"),
        F.collect_list(F.struct(F.col("n_name").alias("name"), F.col("nested").alias("rides"))).alias("lands"),
    )
    payload = F.to_json(F.struct("rides", "lands"))
    if dirty:
        payload = F.when(F.col("r_regionkey") == BROKEN_REGION, F.left(payload, F.lit(40))).otherwise(payload)
    return by_park.select(
        F.lit(CAPTURED_AT).cast("timestamp_ntz").alias("captured_at"),
        F.col("r_regionkey").cast("int").alias("park_id"),
        F.col("r_name").alias("park_name"),
        payload.alias("payload"),
    )


def hourly_payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(first, second) batch of landed answers: `hourly_captures` by hour, park and land, of bounded size each. A ride is
    listed once for each of its events of the hour, in order of event."""
    ride = F.struct(
        "event_id",
        F.col("ride_id").alias("id"),
        F.col("ride_name").alias("name"),
        "is_open",
        F.col("wait_time_minutes").alias("wait_time"),
        F.col("source_last_updated").alias("last_updated"),
    )

    def answers(captures: DataFrame) -> DataFrame:
        part = F.call_function("div", F.col("ride_id"), F.lit(RIDES_PER_PAYLOAD)).alias("part")
        listed = captures.groupBy("captured_at", "park_id", "park_name", "land_name", part).agg(F.array_sort(F.collect_list(ride)).alias("rides"))
        payload = F.to_json(F.struct(F.array(F.struct(F.col("land_name").alias("name"), "rides")).alias("lands")))
        return listed.select("captured_at", F.col("park_id").cast("int").alias("park_id"), "park_name", payload.alias("payload"))

    first, second = hourly_captures(spark, sf_dir)
    return answers(first), answers(second)


def park_catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as parks with padded names, one payload per region."""
    nations = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(
        F.collect_list(
            F.struct(F.col("n_nationkey").alias("id"), F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("name"))
        ).alias("parks")
    )
    groups = table(spark, sf_dir, "region").join(nations, F.expr("n_regionkey = r_regionkey"))
    return groups.select(F.col("r_regionkey").alias("seq"), F.to_json(F.array(F.struct("parks"))).alias("payload"))
