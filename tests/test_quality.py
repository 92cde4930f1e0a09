from __future__ import annotations

import pytest
from fixtures import built, history, raw
from pyspark.sql import functions as F

from fleetstate.plans import quality

TABLES = ["stg_snapshots", "fct_downtime_events", "dim_rides", "agg_ride_daily", "agg_park_daily"]


@pytest.fixture(scope="module")
def tables(spark):
    rows = history("O C O", 1) + history("C O C", 2)
    frames = dict(zip(TABLES, built(spark, rows), strict=True))
    return {"raw_snapshots": raw(spark, rows), **{name: df.cache() for name, df in frames.items()}}


def failing(tables):
    return {r.check_id: r.failing_rows for r in quality.summary(tables).collect()}


def test_sound_tables_pass(tables):
    results = failing(tables)
    assert list(results) == [f"K{i}" for i in range(1, 17)]
    assert set(results.values()) == {0}
    quality.gate(quality.summary(tables))


def broken(df, check):
    """`df` with one row that fails `check`."""
    one = df.limit(1)
    if check.kind == quality.UNIQUE:
        return df.unionByName(one)
    bad = F.lit(None).cast(df.schema[check.column].dataType) if check.kind == quality.NOT_NULL else F.lit("Unheard-of")
    return df.unionByName(one.withColumn(check.column, bad))


@pytest.mark.parametrize("check", quality.CHECKS, ids=lambda c: c.check_id)
def test_each_check_can_fail(tables, check):
    bad = {**tables, check.table: broken(tables[check.table], check)}
    results = quality.summary(bad, [c for c in quality.CHECKS if c.table == check.table])
    assert {r.check_id: r.failing_rows for r in results.collect()}[check.check_id] == 1
    with pytest.raises(quality.QualityError, match=check.check_id):
        quality.gate(results)


def test_failing_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    assert quality.not_null(df, "v").count() == 2
    assert [tuple(r) for r in quality.unique(df, "v").collect()] == [("a", 2)]
    assert [r.v for r in quality.accepted_values(df, "v", ("a",)).collect()] == ["b"]


def test_nulls_are_neither_repeated_nor_unaccepted(spark, tables):
    nothing = tables["fct_downtime_events"].limit(2)
    nothing = nothing.withColumn("downtime_event_id", F.lit(None).cast("string"))
    nothing = nothing.withColumn("severity_band", F.lit(None).cast("string"))
    checks = [c for c in quality.CHECKS if c.table == "fct_downtime_events"]
    results = quality.summary({"fct_downtime_events": nothing}, checks)
    assert {r.check_id: r.failing_rows for r in results.collect()} == {"K7": 0, "K8": 2, "K9": 0, "K10": 0, "K11": 0}


def test_empty_tables_pass(spark, tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert set(failing(empty).values()) == {0}
