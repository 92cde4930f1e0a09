"""Full refresh: raw table, staging view, marts; written aside, checked, and published together."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetstate.operators import rollups
from fleetstate.operators.staging import stage_snapshots
from fleetstate.params import LIVE_SOURCE, SEED_SOURCE, Params
from fleetstate.plans import audit, marts, quality
from fleetstate.session import materialize, work_folder
from fleetstate.sources.snapshots import prefer_live, read_snapshots
from fleetstate.sources.tables import Release, by_date, finish

RAW_TABLE = "raw.wait_time_snapshots"
MARTS_SCHEMA = "main_marts"
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadReport:
    """What was loaded, as counted while it was written."""

    row_count: int
    first_captured_at: dt.datetime | None
    last_captured_at: dt.datetime | None
    #: Rows by provenance label (None: no label), the biggest first, then by label.
    sources: dict[str | None, int] = field(default_factory=dict)
    #: Whether there is a seed that was passed over, since there are live rows.
    seed_ignored: bool = False


@dataclass(frozen=True)
class Build:
    """Tables by name, and the report of the load."""

    tables: dict[str, DataFrame]
    load: LoadReport

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


def load_raw(spark: SparkSession, live_path: str, seed_path: str, include_seed: bool, release: Release) -> tuple[DataFrame, LoadReport]:
    """Load the raw table from the live and seed folders, in folders by capture date. No rows at all is an error.

    Rows, span and sources are observed in the write itself, so the input is read once. Only if there are labels other than
    the known ones are they counted, from that one column of the new table.
    """
    live, seed = read_snapshots(spark, live_path), read_snapshots(spark, seed_path)
    label, seen = F.col("data_source"), Observation("load")
    dated = by_date(prefer_live(live, seed, include_seed).withColumn("captured_date", F.to_date("captured_at")), "captured_date")
    known = {"live": LIVE_SOURCE, "seed": SEED_SOURCE, "none": None}
    snapshots = dated.observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        F.min("captured_at").alias("first_captured_at"),
        F.max("captured_at").alias("last_captured_at"),
        *[F.count(F.when(label.eqNullSafe(F.lit(value)), 1)).alias(name) for name, value in known.items()],
    )
    raw = release.save(snapshots, RAW_TABLE, by="captured_date").drop("captured_date")
    release.saved[RAW_TABLE] = raw.columns
    counts = seen.get
    if not counts["row_count"]:
        raise FileNotFoundError(f"no snapshots under {live_path} or {seed_path}")
    sources = {value: counts[name] for name, value in known.items() if counts[name]}
    if sum(sources.values()) < counts["row_count"]:
        sources = {row["data_source"]: row["n"] for row in audit.load_sources(raw).collect()}
    ranked = sorted(sources.items(), key=lambda s: (-s[1], s[0] is not None, s[0] or ""))
    # Without the seed, its rows are missed only where live ones stand in their place.
    ignored = not include_seed and not live.isEmpty() and not seed.isEmpty()
    return raw, LoadReport(counts["row_count"], counts["first_captured_at"], counts["last_captured_at"], dict(ranked), ignored)


def report_load(load: LoadReport) -> None:
    """The report of a load, in the log."""
    if load.seed_ignored:
        log.warning("there are live rows: the seed was not loaded")
    log.info("loaded %d rows, %s to %s", load.row_count, load.first_captured_at, load.last_captured_at)
    for source, rows in load.sources.items():
        log.info("data_source %s: %d rows", source, rows)


def write_marts(raw: DataFrame, p: Params, schema: str, release: Release) -> dict[str, DataFrame]:
    """The four marts and the results of all checks as tables of the release; a failing check is an error.

    The snapshots are read four times, each time only the columns it takes: for the ride x day totals, for the outages,
    and for the checks on raw and on staged rows.
    The totals are written once and shared by all that is built on them.
    """
    staged = stage_snapshots(raw, p)
    with work_folder(raw.sparkSession) as work:
        totals = materialize(rollups.ride_day_totals(staged), f"{work}/ride_day_totals")
        events = by_date(marts.downtime_events(staged, p), "downtime_date")
        events = release.save(events, f"{schema}.fct_downtime_events", by="downtime_date")
        rides = release.save(marts.dim_rides(totals, events), f"{schema}.dim_rides")
        ride_daily = by_date(marts.agg_ride_daily(totals, events), "captured_date")
        # The date is the last column of the table, as that of its folders.
        ride_daily = ride_daily.select(*[c for c in ride_daily.columns if c != "captured_date"], "captured_date")
        ride_daily = release.save(ride_daily, f"{schema}.agg_ride_daily", by="captured_date")
        park_daily = release.save(marts.agg_park_daily(ride_daily), f"{schema}.agg_park_daily")
    tables = {
        "raw_snapshots": raw,
        "stg_snapshots": staged,
        "fct_downtime_events": events,
        "dim_rides": rides,
        "agg_ride_daily": ride_daily,
        "agg_park_daily": park_daily,
    }
    quality.gate(release.save(quality.summary(tables), f"{schema}.dq_summary"))
    return tables


def build_marts(raw: DataFrame, p: Params = Params(), schema: str = MARTS_SCHEMA) -> dict[str, DataFrame]:
    """Write the marts, check them, publish them. If a check fails, the marts of before stay as they are; the tables of the
    failed run, with the results of its checks, lie in its own schema until the next run that passes."""
    finish(raw.sparkSession, schema)
    release = Release(raw.sparkSession)
    tables = write_marts(raw, p, schema, release)
    release.publish()
    return tables


def create_staging_view(spark: SparkSession, p: Params = Params(), raw_table: str = RAW_TABLE) -> None:
    """Staging by name, for queries in SQL: a temporary view, evaluated by whoever reads it."""
    stage_snapshots(spark.table(raw_table), p).createOrReplaceTempView("stg_snapshots")


def build(spark: SparkSession, live_path: str, seed_path: str, include_seed: bool = False, p: Params = Params()) -> Build:
    """Load, transform, check, publish: raw table and marts change together, or not at all."""
    for schema in (RAW_TABLE.split(".")[0], MARTS_SCHEMA):
        finish(spark, schema)
    release = Release(spark)
    try:
        raw, load = load_raw(spark, live_path, seed_path, include_seed, release)
    except FileNotFoundError:
        release.discard()
        raise
    report_load(load)
    tables = write_marts(raw, p, MARTS_SCHEMA, release)
    release.publish()
    create_staging_view(spark, p)
    return Build(tables, load)
