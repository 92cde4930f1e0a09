"""Data-quality checks, one aggregate per table, and the gate that fails a run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstate.functions.labels import SEVERITY_NAMES

NOT_NULL, UNIQUE, ACCEPTED_VALUES = "not_null", "unique", "accepted_values"


@dataclass(frozen=True)
class Check:
    check_id: str
    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()


CHECKS = (
    Check("K1", "raw_snapshots", "captured_at", NOT_NULL),
    Check("K2", "raw_snapshots", "ride_id", NOT_NULL),
    Check("K3", "raw_snapshots", "is_open", NOT_NULL),
    Check("K4", "stg_snapshots", "ride_id", NOT_NULL),
    Check("K5", "stg_snapshots", "captured_at", NOT_NULL),
    Check("K6", "stg_snapshots", "is_open", NOT_NULL),
    Check("K7", "fct_downtime_events", "downtime_event_id", UNIQUE),
    Check("K8", "fct_downtime_events", "downtime_event_id", NOT_NULL),
    Check("K9", "fct_downtime_events", "ride_id", NOT_NULL),
    Check("K10", "fct_downtime_events", "downtime_minutes", NOT_NULL),
    Check("K11", "fct_downtime_events", "severity_band", ACCEPTED_VALUES, SEVERITY_NAMES),
    Check("K12", "dim_rides", "ride_id", UNIQUE),
    Check("K13", "dim_rides", "ride_id", NOT_NULL),
    Check("K14", "dim_rides", "uptime_pct", NOT_NULL),
    Check("K15", "agg_ride_daily", "uptime_pct", NOT_NULL),
    Check("K16", "agg_park_daily", "park_uptime_pct", NOT_NULL),
)


class QualityError(RuntimeError):
    """At least one check failed."""


def not_null(df: DataFrame, column: str) -> DataFrame:
    """The rows that fail the check, as for the two others below; it passes when there are none."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """The values that occur more than once, NULL aside, with how often."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)


def accepted_values(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def summary(tables: Mapping[str, DataFrame], checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """One row per check: failing rows, or for `unique` the values that occur more than once."""
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    return reduce(DataFrame.unionByName, [_check_table(tables[t], of_table) for t, of_table in by_table.items()])


def gate(results: DataFrame) -> None:
    """Fail the run when any check does."""
    failed = results.filter(F.col("failing_rows") > 0).orderBy("check_id").collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r.check_id} {r.kind}({r.table}.{r.column}): {r.failing_rows} failing" for r in failed)
        )


def _check_table(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks of a table in one pass. A unique column is the grouping key of a first step, so its values are
    counted and everything else is summed on the way."""
    keys = {c.column for c in checks if c.kind == UNIQUE}
    if len(keys) > 1:
        raise ValueError("a table can have one unique column checked per pass")
    flags = [_failures(c).alias(c.check_id) for c in checks if c.kind != UNIQUE]
    if keys:
        (key,) = keys
        groups = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"), *flags)
        repeated = F.count(F.when((F.col("n") > 1) & F.col("key").isNotNull(), 1))
        totals = groups.agg(*[(repeated if c.kind == UNIQUE else F.sum(c.check_id)).alias(c.check_id) for c in checks])
    else:
        totals = df.agg(*flags)
    results = [
        F.struct(
            F.lit(c.check_id).alias("check_id"),
            F.lit(c.table).alias("table"),
            F.lit(c.column).alias("column"),
            F.lit(c.kind).alias("kind"),
            F.coalesce(c.check_id, F.lit(0)).alias("failing_rows"),
        )
        for c in checks
    ]
    return totals.select(F.inline(F.array(*results)))


def _failures(check: Check) -> Column:
    column = F.col(check.column)
    fails = column.isNull() if check.kind == NOT_NULL else ~column.isin(*check.values)
    return F.count(F.when(fails, 1))
