"""What Spark makes of the queries: what is read, shuffled and pushed down."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from fixtures import history, raw

import __spark_entry__ as contract
from fleetstate.operators import dedupe, islands, rollups
from fleetstate.operators.staging import stage_snapshots
from fleetstate.plans import marts, reports
from fleetstate.sources.snapshots import read_snapshots

SF_DIR = "/root/testdata/sf0.001"
SCOPE_DAY = dt.date(2024, 1, 3)


def plan(df) -> str:
    """The physical plan before the runtime re-plans it, or after when it has run."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


@pytest.fixture()
def staged(spark, tmp_path):
    path = str(tmp_path / "snap")
    raw(spark, history("O C C O", 1) + history("C O C C", 2)).write.parquet(path)
    return stage_snapshots(read_snapshots(spark, path))


def columns_read(text: str) -> list[set[str]]:
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


def shuffle_keys(text: str) -> list[str]:
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    return [re.sub(r"#\d+L?", "", k).rsplit(",", 1)[0] for k in keys]


def test_snapshots_are_shuffled_once_by_range_of_ride_and_time(staged):
    events = marts.downtime_events(staged)
    events.collect()
    text = plan(events)
    (ranged,) = re.findall(r"Exchange rangepartitioning\(([^)]*)\)", text)
    assert re.sub(r"#\d+L?", "", ranged).startswith("ride_key ASC NULLS FIRST, captured_at ASC")
    # Runs, no more snapshots: those at an edge of a range meet by ride, the others have groups of their own.
    assert shuffle_keys(text) == ["ride_key, own_slice, own_run"]
    assert text.count("FileScan") == 1 and text.count("Window [") <= 2
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_numbering_joins_one_row_a_range(staged):
    df = islands.status_groups(staged)
    df.collect()
    text = plan(df)
    # The numbered ranges were written once; what they owe each other is two windows over a row each.
    assert "FileScan" not in text and "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert text.count("Exchange hashpartitioning") <= 2 and "rangepartitioning" not in text


def test_only_needed_columns_are_read(staged):
    (read,) = columns_read(plan(marts.downtime_events(staged)))
    assert read == {"captured_at", "ride_id", "ride_name", "park_name", "land_name", "is_open", "data_source"}
    (read,) = columns_read(plan(rollups.ride_day_totals(staged)))
    assert "data_source" not in read and "source_last_updated" not in read


def test_totals_hash_the_snapshots(staged):
    text = plan(rollups.ride_day_totals(staged))
    lowest = [line for line in text.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in lowest and "SortAggregate" not in lowest


def test_dedupe_limits_before_the_shuffle(staged):
    text = plan(dedupe.keep_last(staged, ["captured_at", "ride_id"], ["data_source"]))
    after = text[text.index("Exchange hashpartitioning") :]
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", after)


def test_report_filters_reach_the_mart_files(spark, staged, tmp_path):
    path = str(tmp_path / "daily")
    marts.agg_ride_daily(rollups.ride_day_totals(staged), marts.downtime_events(staged)).write.partitionBy(
        "captured_date"
    ).parquet(path)
    text = plan(reports.in_scope(spark.read.parquet(path), reports.Scope(("Park A",), *[SCOPE_DAY] * 2)))
    assert re.search(r"PartitionFilters: \[[^]]*captured_date", text)
    assert re.search(r"PushedFilters: \[[^]]*park_name", text)


def test_ranking_is_a_top_k(spark):
    assert "TakeOrderedAndProject(limit=12" in plan(contract.queries()["top_impact_rides"](spark, SF_DIR))
