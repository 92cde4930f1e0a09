"""Keep-last by key, for captures that arrive twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPTURE_KEY = ("captured_at", "ride_id")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that is last by `order`. NULL keys are equal to each other.

    Spark applies the limit of one row per key before the shuffle too, so a key that a large share of the rows has in
    common sends one row per task.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.desc(column) for column in order])
    return df.withColumn("place", F.row_number().over(latest)).filter(F.col("place") == 1).drop("place")


def merge_captures(stored: DataFrame, incoming: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Stored and incoming captures together, one row per (captured_at, ride_id); incoming wins over stored.

    `order` names columns that say which of two rows of the same side is the later one. A side that lacks one of them
    has NULL there, which sorts first. The result has the columns that both sides share, without `order`.
    """
    both = _numbered(stored, 0).unionByName(_numbered(incoming, 1), allowMissingColumns=True)
    columns = [c for c in incoming.columns if c in stored.columns and c not in order]
    return keep_last(both, CAPTURE_KEY, ["batch", *order]).select(columns)


def _numbered(df: DataFrame, batch: int) -> DataFrame:
    return df.withColumn("batch", F.lit(batch))
