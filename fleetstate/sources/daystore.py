"""The snapshot store: captures by date, in numbered versions that appear as a whole.

    <store>/version=0000000007-add/captured_date=2024-01-03/*.parquet

A version is written aside and moved in by one rename, so a reader sees all of it or nothing. `all` versions hold the whole
store, those before are dead; `days` versions hold the whole of each day in them; `add` versions hold captures that replace
those of the same (captured_at, ride_id) in earlier ones. A merge so writes what it was given, however big its days are;
`compact` puts days of several versions together. A reader who began before a compaction still finds its files: they go with the
next one. The store takes one writer at a time.

Days that lie in the store's folder itself are of before there were versions, and count as the first.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetstate import schema
from fleetstate.operators.dedupe import CAPTURE_KEY, keep_last
from fleetstate.session import delete_path, hadoop_path, list_files, path_exists

DAY, VERSION = "captured_date", "version"
ALL, DAYS, ADD = "all", "days", "add"
_DAY_FIELD = schema.T.StructField(DAY, schema.T.DateType())
_STORED = schema.T.StructType([*schema.CAPTURE, _DAY_FIELD])
_VERSIONED = schema.T.StructType([*schema.CAPTURE, schema.T.StructField(VERSION, schema.T.StringType()), _DAY_FIELD])


@dataclass(frozen=True)
class Part:
    """The folder of one day in one version."""

    number: int
    kind: str
    day: str
    path: str


def write_days(captures: DataFrame, path: str) -> int:
    """Replace the whole store by `captures`; returns their number. Until they are all written the old store stays."""
    return _publish(captures.sparkSession, _with_day(captures), path, ALL, even_empty=True)


def merge_days(captures: DataFrame, path: str, order: tuple[str, ...] = ()) -> int:
    """Add captures to the store; a (captured_at, ride_id) already there is replaced. Returns the number of captures written,
    one for each key; nothing captured writes nothing.

    `order` names columns of `captures` that say which of two of them for one key comes last. Merging the same captures
    again changes nothing.
    """
    incoming = keep_last(_with_day(captures, order), CAPTURE_KEY, order or [DAY]).select(_STORED.names)
    return _publish(captures.sparkSession, incoming, path, ADD)


def compact(spark: SparkSession, path: str, at_least: int = 2) -> int:
    """Put together each day that lies in `at_least` versions or more; returns how many there were. Folders that were dead
    before go away; those that this makes dead stay for readers who have begun, until the next time."""
    live, dead = _parts(spark, path)
    days = {day: parts for day, parts in live.items() if len(parts) >= at_least}
    if days:
        merged = _merged(_read(spark, path, [p for parts in days.values() for p in parts]))
        _publish(spark, merged.select(_STORED.names), path, DAYS)
    for folder in dead:
        delete_path(spark, folder)
    return len(days)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """All captures of the store, the last of each (captured_at, ride_id). Days of one version are read as they are."""
    live, _ = _parts(spark, path)
    whole = [parts[0] for parts in live.values() if len(parts) == 1]
    several = [p for parts in live.values() if len(parts) > 1 for p in parts]
    found = [_read(spark, path, whole).select(_STORED.names)] if whole else []
    if several:
        found.append(_merged(_read(spark, path, several)).select(_STORED.names))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _STORED)


def is_store(spark: SparkSession, path: str) -> bool:
    return bool(list_files(spark, f"{path.rstrip('/')}/{VERSION}=*"))


def _parts(spark: SparkSession, path: str) -> tuple[dict[str, list[Part]], list[str]]:
    """Folders to read, by day and in order of version; and the dead ones, in the order in which they may go."""
    base = path.rstrip("/")
    if not path_exists(spark, base):
        return {}, []
    versions = [_numbered(folder) for folder in list_files(spark, f"{base}/{VERSION}=*")]
    start = max((v for v in versions if v[1] == ALL), default=(0, ALL))[0]
    parts = [Part(0, ALL, folder.rsplit("=", 1)[1], folder) for folder in list_files(spark, f"{base}/{DAY}=*")]
    for folder in list_files(spark, f"{base}/{VERSION}=*/{DAY}=*"):
        version, day = folder.rsplit("/", 2)[1:]
        parts.append(Part(*_numbered(version), day.split("=", 1)[1], folder))
    # Versions before the last whole store are dead as such; of the others, the days that a later version holds whole.
    dead = [folder for folder in list_files(spark, f"{base}/{VERSION}=*") if _numbered(folder)[0] < start]
    dead += [p.path for p in parts if p.number == 0 < start]
    live: dict[str, list[Part]] = {}
    for part in sorted((p for p in parts if p.number >= start), key=lambda p: p.number):
        if part.kind != ADD:
            dead += [p.path for p in live.pop(part.day, [])]
        live.setdefault(part.day, []).append(part)
    return live, dead


def _numbered(folder: str) -> tuple[int, str]:
    number, kind = folder.rsplit(f"{VERSION}=", 1)[1].split("-")
    return int(number), kind


def _read(spark: SparkSession, path: str, parts: list[Part]) -> DataFrame:
    """Captures of the parts, with their version."""
    base = path.rstrip("/")
    reader = spark.read.option("basePath", base)
    numbered = [p.path for p in parts if p.number]
    found = [reader.schema(_VERSIONED).parquet(*numbered)] if numbered else []
    if first := [p.path for p in parts if not p.number]:
        found.append(reader.schema(_STORED).parquet(*first).withColumn(VERSION, F.lit("0")))
    return reduce(DataFrame.unionByName, found)


def _merged(captures: DataFrame) -> DataFrame:
    return keep_last(captures, CAPTURE_KEY, [VERSION])


def _publish(spark: SparkSession, days: DataFrame, path: str, kind: str, even_empty: bool = False) -> int:
    """Write a version aside and move it in; returns its rows."""
    base = path.rstrip("/")
    new = not path_exists(spark, base)
    delete_path(spark, f"{base}/_staged")  # of a run that died
    staged, seen = f"{base}/_staged/{uuid.uuid4().hex}", Observation()
    # Rebalancing keeps each date in few files, and splits a date that is too big for one task.
    dealt = days.hint("rebalance", F.col(DAY)).observe(seen, F.count(F.lit(1)).alias("n"))
    dealt.write.partitionBy(DAY).parquet(staged)
    rows = seen.get["n"]
    if rows or even_empty:
        numbers = [_numbered(v)[0] for v in list_files(spark, f"{base}/{VERSION}=*")]
        _move_in(spark, staged, f"{base}/{VERSION}={max(numbers, default=0) + 1:010d}-{kind}")
    delete_path(spark, f"{base}/_staged" if rows or even_empty or not new else base)
    return rows


def _move_in(spark: SparkSession, staged: str, version: str) -> None:
    fs, source = hadoop_path(spark, staged)
    if not fs.rename(source, hadoop_path(spark, version)[1]):
        raise OSError(f"could not move {staged} to {version}")


def _with_day(captures: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return captures.select(*schema.CAPTURE.names, *extra).withColumn(DAY, F.to_date("captured_at"))
