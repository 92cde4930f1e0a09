"""Outage islands: unbroken runs of closed snapshots per ride.

The status of a ride has to be compared with its previous one, over its whole history. One window per ride would put
all snapshots of a ride into one task, and a single ride may hold a third of all rows. So the snapshots are dealt out by
ranges of (ride, time): a ride may be cut anywhere, even within copies of one snapshot. Each range is walked once:

* `downtime_islands` folds a range into runs. A run inside its range is whole; only the first and the last run of a range
  may go on in another, and only those meet in a window per ride, two rows for each range the ride lies in.
* `status_groups` numbers the runs of a range from 1. What a range has to add is a sum over the ranges before it, one row each.

That is one shuffle of the snapshots, the same for any data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetstate.operators.scan import checkpointed, in_ranges

NAMES = ["ride_name", "park_name", "land_name"]
# Key of the ride that has no id: beyond any int, so that the key of a ride is never NULL.
NO_RIDE = 1 << 40
# Snapshots of one ride at one time may come from two sources; the rest only makes the order of such ties definite.
IN_ORDER = ["captured_at", "data_source", "is_open", *NAMES]
UNKNOWN = -1

_RUNS = (
    "ride_key bigint, ride_name string, park_name string, land_name string, is_open boolean, started_at timestamp_ntz, "
    "ended_at timestamp_ntz, snapshots bigint, slice int, local_run bigint, at_edge boolean"
)
_NUMBERED = (
    "ride_key bigint, ride_name string, park_name string, land_name string, captured_at timestamp_ntz, captured_date date, "
    "is_open boolean, changed int, number bigint, slice int, head boolean, first boolean, head_ride bigint, head_open boolean"
)


def downtime_islands(staged: DataFrame) -> DataFrame:
    """One row per unbroken run of closed snapshots of a ride. A run also ends where a name changes."""
    slim = staged.select(_ride_key(), *NAMES, "captured_at", "is_open", "data_source")
    return _stitched(in_ranges(slim, "ride_key", *IN_ORDER).mapInArrow(_fold, _RUNS))


def status_groups(staged: DataFrame) -> DataFrame:
    """Each snapshot with a change flag and the number of the run it belongs to, counted per ride from 1.

    The flag is 1 where the status differs from the ride's previous one, or either is unknown, else 0. Copies of a snapshot
    are snapshots: of those with a status only the first may change it; each one without a status is a run of its own. The
    numbered ranges are written once, as their totals and their rows are both read.
    """
    slim = staged.select(_ride_key(), *NAMES, "captured_at", "captured_date", "is_open", "data_source")
    numbered = checkpointed(in_ranges(slim, "ride_key", *IN_ORDER).mapInArrow(_number, _NUMBERED))
    owed = F.broadcast(_owed(numbered.filter(F.col("head_ride").isNotNull())))  # one row for each range
    rows = numbered.filter(F.col("head_ride").isNull()).drop("head_ride", "head_open").join(owed, "slice", "left")
    return rows.select(
        _ride_id(),
        *NAMES,
        "captured_at",
        "captured_date",
        "is_open",
        F.when(F.col("first"), 1 - F.col("joined")).otherwise(F.col("changed")).alias("is_status_change"),
        (F.col("number") + F.when(F.col("head"), F.col("before")).otherwise(0)).alias("status_group"),
    )


def status_changes(staged: DataFrame) -> DataFrame:
    return status_groups(staged).drop("status_group")


def _ride_key() -> Column:
    return F.coalesce(F.col("ride_id").cast("long"), F.lit(NO_RIDE)).alias("ride_key")


def _ride_id() -> Column:
    return F.nullif(F.col("ride_key"), F.lit(NO_RIDE)).cast("int").alias("ride_id")


def _stitched(runs: DataFrame) -> DataFrame:
    """Whole outages from the runs of all ranges."""
    # Runs within a range keep a group of their own; those at an edge share one per ride.
    inner = ~F.col("at_edge")
    grouped = runs.select("*", F.when(inner, F.col("slice")).alias("own_slice"), F.when(inner, F.col("local_run")).alias("own_run"))
    group = ["ride_key", "own_slice", "own_run"]
    order = Window.partitionBy(*group).orderBy("slice", "local_run")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def same_as_before(column: str) -> Column:
        return F.lag(column).over(order) == F.col(column)

    # Rows of one range are one run if they bear the same number (they differ in a name then). Of two ranges, the last
    # run of the earlier and the first of the later are one if the status is the same.
    goes_on = F.when(same_as_before("slice"), same_as_before("local_run")).otherwise(same_as_before("is_open"))
    joined = grouped.withColumn("starts", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("starts").over(so_far))
    return (
        joined.filter(~F.col("is_open"))
        .groupBy(*group, "run", *NAMES)
        .agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"), F.sum("snapshots").alias("snapshots"))
        .select(
            _ride_id(),
            *NAMES,
            F.to_date("started_at").alias("downtime_date"),
            F.col("started_at").alias("downtime_started_at"),
            F.col("ended_at").alias("last_observed_closed_at"),
            F.col("snapshots").alias("closed_snapshot_count"),
        )
    )


def _owed(tails: DataFrame) -> DataFrame:
    """(slice, joined, before): whether the first row of a range carries on the last run of the range before it, and how
    many runs its ride had there, less one if so. There is one row for each range."""
    along = Window.orderBy("slice")
    before = tails.select(
        "*", F.lag("ride_key").over(along).alias("last_ride"), F.lag("is_open").over(along).alias("last_open")
    )
    same_ride = F.col("last_ride") == F.col("head_ride")
    joined = F.when(same_ride & (F.col("last_open") == F.col("head_open")), 1).otherwise(0)
    # A range of one ride alone is a link in its chain.
    added = F.col("number") - F.when(F.col("head_ride") == F.col("ride_key"), F.col("joined")).otherwise(0)
    so_far = Window.partitionBy("ride_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = before.withColumn("joined", joined).withColumn("runs", F.sum(added).over(so_far))
    carried = F.when(same_ride, F.lag("runs").over(along) - F.col("joined")).otherwise(F.lit(0))
    return counted.select("slice", "joined", F.coalesce(carried, F.lit(0)).alias("before"))


def _rides_and_status(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    status = batch.column("is_open").cast(pa.int8()).fill_null(UNKNOWN).to_numpy(zero_copy_only=False)
    return batch.column("ride_key").to_numpy(zero_copy_only=False), status


def _changes(ride: np.ndarray, status: np.ndarray, last: tuple | None) -> np.ndarray:
    """Whether each row starts a run; `last` is ride and status of the row before the first."""
    changed = np.ones(len(ride), dtype=bool)
    changed[1:] = (ride[1:] != ride[:-1]) | (status[1:] != status[:-1]) | (status[1:] == UNKNOWN)
    changed[0] = last is None or (ride[0], status[0]) != last or status[0] == UNKNOWN
    return changed


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range with numbers of runs per ride from 1; after them, a row of the totals of the range."""
    part, last, counted, head = TaskContext.get().partitionId(), None, 0, None
    kept = [*NAMES, "captured_at", "captured_date", "is_open"]
    names = ["ride_key", *kept, "changed", "number", "slice", "head", "first", "head_ride", "head_open"]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ride, status = _rides_and_status(batch)
        changed, total = _changes(ride, status, last), np.zeros(n, dtype=np.int64)
        np.cumsum(changed, out=total)
        new_ride = np.append(last is None or ride[0] != last[0], ride[1:] != ride[:-1])
        start = np.maximum.accumulate(np.where(new_ride, np.arange(n), -1))
        number = total + counted
        number[start >= 0] = (total - total[start] + 1)[start >= 0]
        first = np.zeros(n, dtype=bool)
        if head is None:
            head, types = (int(ride[0]), int(status[0])), [batch.schema.field(c).type for c in kept]
            first[0] = True
        last, counted = (ride[-1], status[-1]), int(number[-1])
        made = [changed.astype(np.int32), number, np.full(n, part, dtype=np.int32), ride == head[0], first]
        nothing = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())]
        yield pa.RecordBatch.from_arrays([pa.array(ride), *(batch.column(c) for c in kept), *(pa.array(m) for m in made), *nothing], names=names)
    if last is not None:
        known = lambda s: pa.array([None if s == UNKNOWN else bool(s)], pa.bool_())
        blank = [pa.nulls(1, t) for t in types[:-1]]
        totals = [pa.nulls(1, pa.int32()), pa.array([counted]), pa.array([part], pa.int32()), pa.nulls(1, pa.bool_()), pa.nulls(1, pa.bool_())]
        yield pa.RecordBatch.from_arrays([pa.array([int(last[0])]), *blank, known(last[1]), *totals, pa.array([head[0]]), known(head[1])], names=names)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of a range, one row for each and set of names. Runs of other status than closed are told only at its edges."""
    part, last, run = TaskContext.get().partitionId(), None, 0
    # The run that is still open, by names: [first time, last time, snapshots]. A ride has few names.
    held: dict[tuple, list[int]] = {}

    def batch_of(rides, names, status, started, ended, count, runs, edge):
        known = pa.array(np.asarray(status, dtype=np.int8) == 1, mask=np.asarray(status, dtype=np.int8) == UNKNOWN)
        times = [pa.array(np.asarray(t, dtype=np.int64)).cast(pa.timestamp("us")) for t in (started, ended)]
        numbers = [pa.array(np.asarray(x, dtype=np.int64)) for x in (count, runs)]
        many = len(runs)
        place = pa.array(np.full(many, part, dtype=np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(rides, dtype=np.int64)), *names, known, *times, numbers[0], place, numbers[1], pa.array(np.asarray(edge, dtype=bool))],
            names=["ride_key", *NAMES, "is_open", "started_at", "ended_at", "snapshots", "slice", "local_run", "at_edge"],
        )

    def flush(edge: bool):
        names = [pa.array(c, pa.string()) for c in zip(*held)]
        started, ended, count = zip(*held.values())
        many = len(held)
        return batch_of([last[0]] * many, names, [last[1]] * many, started, ended, count, [run] * many, [edge] * many)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ride, status = _rides_and_status(batch)
        runs = run + np.cumsum(_changes(ride, status, last))
        codes, kinds = np.zeros(n, dtype=np.int64), 1
        for column in NAMES:
            coded = batch.column(column).dictionary_encode(null_encoding="encode")
            codes = codes * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
            kinds *= len(coded.dictionary)
        if kinds >= 1 << 40:  # never overflows below: codes are numbered anew
            codes = np.unique(codes, return_inverse=True)[1]
            kinds = n
        key = (runs - run) * kinds + codes
        order = np.argsort(key, kind="stable")
        begins = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        first, final = order[begins], order[np.append(begins[1:], n) - 1]
        count, time = np.diff(np.append(begins, n)), batch.column("captured_at").cast(pa.int64()).to_numpy(zero_copy_only=False)
        at = runs[first]

        def hold(some):
            names = zip(*(batch.column(c).take(pa.array(first[some])).to_pylist() for c in NAMES))
            for name, i in zip(names, some):
                if name in held:
                    held[name][1:] = [int(time[final[i]]), held[name][2] + int(count[i])]
                else:
                    held[name] = [int(time[first[i]]), int(time[final[i]]), int(count[i])]

        if last is not None:
            hold(np.flatnonzero(at == run))
        if runs[-1] > run:
            if held and (run == 1 or last[1] == 0):
                yield flush(run == 1)
            between = np.flatnonzero((at > run) & (at < runs[-1]) & ((status[first] == 0) | (at == 1)))
            if len(between):
                rows = pa.array(first[between])
                yield batch_of(
                    ride[first[between]], [batch.column(c).take(rows) for c in NAMES], status[first[between]],
                    time[first[between]], time[final[between]], count[between], at[between], at[between] == 1,
                )
            held.clear()
            run, last = int(runs[-1]), (ride[-1], status[-1])
            hold(np.flatnonzero(at == run))
    if held:
        yield flush(True)
