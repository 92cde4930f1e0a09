"""Running totals within groups of any size.

A window per group would put a whole group into one task. Here rows are dealt out by ranges of (group, order), so that a
group may be cut anywhere; each range is scanned once, and what a range owes to those before it is one row per range.
Rows equal in all of these are kept apart by their place in the input, so that even copies of one row are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

PLACE, SLICE, HEAD, TAIL = "_place", "_slice", "_head", "_tail"


def in_ranges(rows: DataFrame, *keys: str) -> DataFrame:
    """`rows` dealt out by ranges of `keys` and sorted within each. The input must come in a definite order per partition,
    as scans and checkpoints do: the place of a row in it decides between equal ones."""
    placed = rows.withColumn(PLACE, F.monotonically_increasing_id())
    return placed.repartitionByRange(*keys, PLACE).sortWithinPartitions(*keys, PLACE).drop(PLACE)


def group_starts(groups: np.ndarray) -> np.ndarray:
    """For each row of a sorted array, where its group begins."""
    new = np.ones(len(groups), dtype=bool)
    new[1:] = groups[1:] != groups[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(groups)), 0))


def _so_far(values: np.ndarray, starts: np.ndarray, xor: bool) -> np.ndarray:
    if xor:
        total = np.bitwise_xor.accumulate(values)
        return total ^ total[starts] ^ values[starts]
    total = np.cumsum(values)
    return total - total[starts] + values[starts]


def _scan(batches: Iterator[pa.RecordBatch], group: str, columns: Sequence[str], xors: Sequence[bool]) -> Iterator[pa.RecordBatch]:
    """Running totals within this range; after the rows, one with the totals of the last group."""
    number = TaskContext.get().partitionId()
    carried, last, head, kinds = [0] * len(columns), None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        kinds = batch.schema
        groups = batch.column(group).to_numpy(zero_copy_only=False)
        starts = group_starts(groups)
        on = (starts == 0) & (groups[0] == last)
        head = groups[0] if head is None else head
        out = []
        for i, column in enumerate(columns):
            values = batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)
            done = _so_far(values, starts, xors[i])
            done[on] = done[on] ^ carried[i] if xors[i] else done[on] + carried[i]
            carried[i] = int(done[-1])
            out.append(pa.array(done))
        last = groups[-1]
        marks = [pa.array(np.full(len(groups), number, dtype=np.int32)), pa.array(groups == head), pa.array(np.zeros(len(groups), dtype=bool))]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *out, *marks], names=[*kinds.names, *(f"{c}_so_far" for c in columns), SLICE, HEAD, TAIL]
        )
    if kinds is not None:
        nulls = [pa.array([last], f.type) if f.name == group else pa.nulls(1, f.type) for f in kinds]
        marks = [pa.array([number], pa.int32()), pa.array([bool(head == last)]), pa.array([True])]
        yield pa.RecordBatch.from_arrays(
            [*nulls, *(pa.array([v], pa.int64()) for v in carried), *marks],
            names=[*kinds.names, *(f"{c}_so_far" for c in columns), SLICE, HEAD, TAIL],
        )


def running(rows: DataFrame, group: str, order: Sequence[str], sums: Sequence[str] = (), xors: Sequence[str] = ()) -> DataFrame:
    """`rows` with `<c>_so_far` for each column of `sums` (added up) and `xors` (exclusive or), up to and with the row, in
    ascending order of `order` within `group`.

    `group` and the totalled columns are whole numbers without nulls; nulls of `order` come first. No rows give no rows.
    """
    columns = [*sums, *xors]
    kind = [False] * len(sums) + [True] * len(xors)
    names = [f"{c}_so_far" for c in columns]
    schema = StructType([StructField(f.name, f.dataType) for f in rows.schema])
    for name, t in [*((n, LongType()) for n in names), (SLICE, IntegerType()), (HEAD, BooleanType()), (TAIL, BooleanType())]:
        schema = schema.add(name, t)
    ranged = in_ranges(rows, group, *order)
    scanned = checkpointed(ranged.mapInArrow(partial(_scan, group=group, columns=columns, xors=kind), schema))
    # One row for each range: the total that the first group of a range has from the ranges before it.
    owed, before = [], None
    for tail in scanned.filter(TAIL).select(SLICE, HEAD, F.col(group).cast("long").alias("_g"), *names).orderBy(SLICE).collect():
        if before is not None:
            owed.append((tail[SLICE], *before))
        totals = list(tail[3:])
        if before is not None and tail[HEAD] and before[0] == tail["_g"]:
            totals = [a ^ b if x else a + b for a, b, x in zip(before[1:], totals, kind)]
        before = (tail["_g"], *totals)
    body = scanned.filter(~F.col(TAIL))
    if not owed:
        return body.drop(SLICE, HEAD, TAIL)
    fields = "_of int, _g long" + "".join(f", _c{i} long" for i in range(len(columns)))
    carry = F.broadcast(rows.sparkSession.createDataFrame(owed, fields))
    joined = body.join(carry, F.col(SLICE) == F.col("_of"), "left")
    owes = F.coalesce(F.col(HEAD) & (F.col("_g") == F.col(group)), F.lit(False))
    added = {
        n: F.when(owes, F.col(n).bitwiseXOR(F.col(f"_c{i}")) if x else F.col(n) + F.col(f"_c{i}")).otherwise(F.col(n))
        for i, (n, x) in enumerate(zip(names, kind))
    }
    return joined.withColumns(added).select(*rows.columns, *names)


def checkpointed(df: DataFrame) -> DataFrame:
    """Written once to the session's checkpoint folder, partition by partition as it is; lost executors cost nothing."""
    from fleetstate.session import shared_base

    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        conf = spark.conf
        context.setCheckpointDir(shared_base(context.master, None, conf.get("spark.checkpoint.dir", None), conf.get("spark.sql.warehouse.dir")))
    return df.checkpoint()
