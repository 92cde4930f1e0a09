"""Every query of the engine by name, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstate import Params
from fleetstate.operators import dedupe, islands, rollups
from fleetstate.operators.scan import checkpointed
from fleetstate.operators.staging import stage_snapshots
from fleetstate.plans import audit, marts, quality, reports
from fleetstate.session import work_folder
from fleetstate.sources import payloads
from fleetstate.sources.daystore import compact
from fleetstate.sources.snapshots import conform, prefer_live, read_snapshots, split_by_source
from fleetstate.streaming.captures import land_captures
from workload import mapping
from workload.mapping import SCOPE, WANTED_PARKS


class Frames:
    """The frames a query is made of, each defined once per query. All are lazy: only what is used is run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return conform(mapping.captures(self.spark, self.sf_dir))

    @cached_property
    def staged(self) -> DataFrame:
        return stage_snapshots(self.raw)

    @cached_property
    def totals(self) -> DataFrame:
        return rollups.ride_day_totals(self.staged)

    @cached_property
    def events(self) -> DataFrame:
        return marts.downtime_events(self.staged)

    @cached_property
    def rides(self) -> DataFrame:
        return marts.dim_rides(self.totals, self.events)

    @cached_property
    def ride_daily(self) -> DataFrame:
        return marts.agg_ride_daily(self.totals, self.events)

    @cached_property
    def park_daily(self) -> DataFrame:
        return marts.agg_park_daily(self.ride_daily)

    @cached_property
    def flat_rides(self) -> DataFrame:
        return payloads.flatten_rides(mapping.landed_payloads(self.spark, self.sf_dir)).drop("payload_pos")

    @cached_property
    def catalogues(self) -> DataFrame:
        return mapping.park_catalogues(self.spark, self.sf_dir)

    @cached_property
    def dirty(self) -> DataFrame:
        return conform(mapping.dirty_captures(self.spark, self.sf_dir))

    @cached_property
    def dirty_payloads(self) -> DataFrame:
        return mapping.landed_payloads(self.spark, self.sf_dir, dirty=True)

    def merge_ties(self) -> DataFrame:
        """The first event of an hour arrives last."""
        stored, incoming = (
            side.withColumn("arrival", -F.col("event_id")) for side in mapping.hourly_captures(self.spark, self.sf_dir)
        )
        return conform(dedupe.merge_captures(stored, incoming, order=["arrival"]))

    def merged_captures(self) -> DataFrame:
        stored, incoming = mapping.hourly_captures(self.spark, self.sf_dir)
        return conform(dedupe.merge_captures(stored, incoming, order=["event_id"]))

    def landed_stream(self) -> DataFrame:
        """Two batches of answers land one after the other and are captured by the file stream, each by a run of its own; then
        a stream that has lost its checkpoint captures both again. What the store then holds is kept, the rest goes.

        A spark.checkpoint.dir that is set is one that all executors share, whatever file system its name is of."""
        with work_folder(self.spark, self.spark.conf.get("spark.checkpoint.dir", None)) as work:
            landing, store = f"{work}/landing", f"{work}/store"
            for batch in mapping.hourly_payloads(self.spark, self.sf_dir):
                batch.write.mode("append").json(landing)
                land_captures(self.spark, landing, store, f"{work}/checkpoint").awaitTermination()
            compact(self.spark, store)
            land_captures(self.spark, landing, store, f"{work}/lost").awaitTermination()
            return checkpointed(read_snapshots(self.spark, store))

    def by_table(self) -> dict[str, DataFrame]:
        return {
            "raw_snapshots": self.raw,
            "stg_snapshots": self.staged,
            "fct_downtime_events": self.events,
            "dim_rides": self.rides,
            "agg_ride_daily": self.ride_daily,
            "agg_park_daily": self.park_daily,
        }


QUERIES: dict[str, Callable[[Frames], DataFrame]] = {
    # Loading
    "raw_snapshots": lambda f: f.raw,
    "raw_live_wins": lambda f: prefer_live(*split_by_source(f.raw)),
    "raw_include_seed": lambda f: prefer_live(*split_by_source(f.raw), include_seed=True),
    "load_audit_span": lambda f: audit.load_span(f.raw),
    "load_audit_sources": lambda f: audit.load_sources(f.raw),
    "dataset_profile": lambda f: audit.dataset_profile(f.raw),
    # Capture
    "flatten_rides": lambda f: f.flat_rides,
    "capture_summary": lambda f: audit.capture_summary(f.flat_rides),
    "resolve_parks": lambda f: payloads.resolve_parks(f.catalogues, WANTED_PARKS),
    "unresolved_parks": lambda f: payloads.unresolved_parks(f.catalogues, WANTED_PARKS),
    "ingest_merge": lambda f: f.merged_captures(),
    "landed_stream": lambda f: f.landed_stream(),
    # Staging and outages
    "stg_snapshots": lambda f: f.staged,
    "status_changes": lambda f: islands.status_changes(f.staged),
    "status_groups": lambda f: islands.status_groups(f.staged),
    "downtime_islands": lambda f: islands.downtime_islands(f.staged),
    "fct_downtime_events": lambda f: f.events,
    "fct_min30": lambda f: marts.downtime_events(f.staged, Params(min_downtime_minutes=30)),
    # The same on hard cases: unknown statuses, renamed rides, odd labels, bad ids, waits and answers, ties
    "raw_sources_mixed": lambda f: prefer_live(*split_by_source(f.dirty)),
    "islands_dirty": lambda f: islands.downtime_islands(stage_snapshots(f.dirty)),
    "status_groups_dirty": lambda f: islands.status_groups(stage_snapshots(f.dirty)),
    "flatten_rides_dirty": lambda f: payloads.flatten_rides(f.dirty_payloads).drop("payload_pos"),
    "bad_rides": lambda f: payloads.bad_rides(f.dirty_payloads),
    "bad_payloads": lambda f: payloads.bad_payloads(f.dirty_payloads)
    .groupBy("captured_at", "park_id", "park_name")
    .agg(F.count(F.lit(1)).alias("answers")),
    "merge_ties": lambda f: f.merge_ties(),
    # Rollups
    "ride_day_base": lambda f: rollups.ride_day_base(f.totals),
    "ride_day_outages": lambda f: rollups.ride_day_outages(f.events),
    "agg_ride_daily": lambda f: f.ride_daily,
    "ride_base": lambda f: rollups.ride_base(f.totals),
    "ride_downtime_profile": lambda f: rollups.ride_downtime_profile(f.events),
    "dim_rides": lambda f: f.rides,
    "agg_park_daily": lambda f: f.park_daily,
    # Reports
    "dash_default_range": lambda f: reports.default_range(f.park_daily),
    "dash_filtered_parks": lambda f: reports.in_scope(f.park_daily, SCOPE),
    "dash_filtered_rides": lambda f: reports.in_scope(f.ride_daily, SCOPE),
    "dash_filtered_events": lambda f: reports.in_scope(f.events, SCOPE, "downtime_date"),
    "kpi_fleet": lambda f: reports.kpi_fleet(f.ride_daily, f.events, SCOPE),
    "kpi_prior_delta": lambda f: reports.kpi_prior_delta(f.ride_daily, SCOPE),
    "uptime_trend": lambda f: reports.uptime_trend(f.park_daily, SCOPE),
    "park_scorecard": lambda f: reports.park_scorecard(f.park_daily, SCOPE),
    "distinct_rides": lambda f: reports.distinct_rides(marts.agg_park_rides(f.ride_daily), SCOPE),
    "severity_mix": lambda f: reports.severity_mix(f.events, SCOPE),
    "outage_day_hour": lambda f: reports.outage_day_hour(f.events, SCOPE),
    "outage_heatmap": lambda f: reports.outage_heatmap(f.events, SCOPE),
    "park_list": lambda f: reports.park_list(f.rides),
    "top_impact_rides": lambda f: reports.top_impact_rides(f.rides, SCOPE.parks),
    "ride_detail": lambda f: reports.ride_detail(f.rides, SCOPE.parks),
    # Checks
    "dq_summary": lambda f: quality.summary(f.by_table()),
}


def _over(query: Callable[[Frames], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Frames(spark, sf_dir))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _over(q) for name, q in QUERIES.items()}
