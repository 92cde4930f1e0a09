"""Landed API answers (JSON text) to snapshot rows and to the park catalogue."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstate import schema
from fleetstate.functions.calendar import floor_second
from fleetstate.functions.numeric import to_number
from fleetstate.params import LIVE_SOURCE, TARGET_PARKS

log = logging.getLogger(__name__)

# Fixed value: the land of a ride that has none.
NO_LAND = "Uncategorized"
# What counts as blank around a park name.
BLANKS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def flatten_rides(landed: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One capture row per ride, from the top level and from under the lands.

    Each payload is parsed and exploded once. `payload_pos` is the place of the ride in its payload, so that a ride
    listed twice can be told apart later; `extra` names columns of `landed` to carry along for the same purpose. Capture
    times are kept to the second. An answer without a capture time, or whose payload cannot be parsed, gives no rows, see
    `bad_payloads`; a ride with an id that is no whole number gives none either, see `bad_rides`.
    """
    rides = _listed_rides(landed, extra)
    return rides.filter(~_bad_id()).select(
        "captured_at",
        "park_id",
        "park_name",
        F.col("at.land_name").alias("land_name"),
        F.col("at.ride.id").try_cast("int").alias("ride_id"),
        F.col("at.ride.name").alias("ride_name"),
        F.coalesce(F.col("at.ride.is_open").try_cast("boolean"), F.lit(False)).alias("is_open"),
        to_number(F.col("at.ride.wait_time")).alias("wait_time_minutes"),
        F.col("at.ride.last_updated").alias("source_last_updated"),
        F.lit(LIVE_SOURCE).alias("data_source"),
        "payload_pos",
        *extra,
    )


def bad_rides(landed: DataFrame) -> DataFrame:
    """Rides of usable answers whose id cannot be one. They would all be the same ride, without an id."""
    return _listed_rides(landed).filter(_bad_id()).select(
        "captured_at", "park_id", "park_name", F.col("at.ride.id").alias("ride_id"), F.col("at.ride.name").alias("ride_name")
    )


def _bad_id() -> Column:
    text = F.col("at.ride.id")
    return text.isNotNull() & text.try_cast("int").isNull()


def _listed_rides(landed: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    parsed = landed.filter(F.col("captured_at").isNotNull()).select(
        floor_second(F.col("captured_at")).alias("captured_at"), "park_id", "park_name", *extra, _parse().alias("queue")
    )
    no_rides = F.from_json(F.lit('{"rides": []}'), schema.QUEUE_PAYLOAD).getField("rides")
    no_lands = F.from_json(F.lit('{"lands": []}'), schema.QUEUE_PAYLOAD).getField("lands")

    def with_land(rides: Column, land_name: Column) -> Column:
        return F.transform(
            F.coalesce(rides, no_rides), lambda ride: F.struct(land_name.alias("land_name"), ride.alias("ride"))
        )

    top_level = with_land(F.col("queue.rides"), F.lit(NO_LAND))
    under_lands = F.flatten(
        F.transform(
            F.coalesce(F.col("queue.lands"), no_lands),
            lambda land: with_land(land["rides"], F.coalesce(land["name"], F.lit(NO_LAND))),
        )
    )
    listed = F.posexplode(F.concat(top_level, under_lands)).alias("payload_pos", "at")
    return parsed.select("captured_at", "park_id", "park_name", *extra, listed)


def bad_payloads(landed: DataFrame) -> DataFrame:
    """The answers that could not be used: they cost their own rows, not the capture."""
    corrupt = F.col("queue").getField(schema.CORRUPT)
    return (
        landed.withColumn("queue", _parse())
        .filter(F.col("captured_at").isNull() | F.col("payload").isNull() | corrupt.isNotNull())
        .select("captured_at", "park_id", "park_name", "payload")
    )


def _parse() -> Column:
    return F.from_json("payload", schema.QUEUE_PAYLOAD, {"columnNameOfCorruptRecord": schema.CORRUPT})


def resolve_parks(catalogues: DataFrame, names: Sequence[str] = TARGET_PARKS) -> DataFrame:
    """(park_name, park_id) of the wanted parks, matched by trimmed name. A name listed twice takes its last id.

    `catalogues` has a `payload` column of park-group lists and a `seq` column that orders the payloads.
    """
    groups = catalogues.select(
        "seq", F.posexplode(F.from_json("payload", schema.PARKS_PAYLOAD)).alias("group_pos", "group")
    )
    parks = groups.select("seq", "group_pos", F.posexplode("group.parks").alias("park_pos", "park"))
    listed = parks.select(
        F.btrim("park.name", F.lit(BLANKS)).alias("park_name"),
        F.col("park.id").alias("park_id"),
        F.struct("seq", "group_pos", "park_pos").alias("place"),
    )
    # The wanted names are an argument, so their number is the caller's: safe to broadcast.
    wanted = F.broadcast(_wanted(catalogues, names))
    return listed.join(wanted, "park_name").groupBy("park_name").agg(F.max_by("park_id", "place").alias("park_id"))


def unresolved_parks(catalogues: DataFrame, names: Sequence[str] = TARGET_PARKS) -> DataFrame:
    """The wanted names the catalogue does not list."""
    return _wanted(catalogues, names).join(resolve_parks(catalogues, names), "park_name", "left_anti")


def require_parks(catalogues: DataFrame, names: Sequence[str] = TARGET_PARKS) -> dict[str, int]:
    """Resolved parks as name -> id, in the order asked for. Names that are not listed are reported; it fails when there is
    none at all."""
    found = {row.park_name: row.park_id for row in resolve_parks(catalogues, names).collect()}
    for name in names:
        if name not in found:
            log.warning("park %r is not in the catalogue, skipped", name)
    if not found:
        raise RuntimeError("no target parks could be resolved from the catalogue")
    return {name: found[name] for name in names if name in found}


def _wanted(catalogues: DataFrame, names: Sequence[str]) -> DataFrame:
    return catalogues.sparkSession.createDataFrame([(name,) for name in dict.fromkeys(names)], "park_name string")
