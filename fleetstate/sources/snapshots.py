"""Snapshot parquet in, with the fixed ten-column schema."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstate import schema
from fleetstate.functions.calendar import from_epoch_nanos, utc_wall_clock
from fleetstate.functions.numeric import to_whole
from fleetstate.params import SEED_SOURCE
from fleetstate.session import list_files
from fleetstate.sources import daystore


def conform(df: DataFrame) -> DataFrame:
    """Cast to the snapshot schema. Accepts zoned, zone-free or nanosecond capture times and fractional waits."""
    found = df.schema
    columns = []
    for field in schema.SNAPSHOT:
        column, kind = F.col(field.name), found[field.name].dataType
        if field.name == "captured_at" and isinstance(kind, T.TimestampType):
            column = utc_wall_clock(column)
        elif field.name == "captured_at" and isinstance(kind, T.LongType):
            column = from_epoch_nanos(column)
        elif isinstance(field.dataType, T.IntegerType) and isinstance(kind, T.FractionalType):
            column = to_whole(column)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(columns)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All captures under `path`: a folder with a day store, with `snapshots_<date>.parquet` files, or with both, or a
    glob of files. Empty when there are none."""
    if any(sign in path for sign in "*?[{"):
        files = list_files(spark, path)
        return _read_day_files(spark, files) if files else spark.createDataFrame([], schema.SNAPSHOT)
    files = list_files(spark, f"{path.rstrip('/')}/snapshots_*.parquet")
    days = list_files(spark, f"{path.rstrip('/')}/{daystore.DAY}=*")
    if daystore.is_store(spark, path) or days:
        stored = conform(daystore.read_days(spark, path))
        return _read_day_files(spark, files).unionByName(stored) if files else stored
    if files:
        return _read_day_files(spark, files)
    try:
        return conform(spark.read.parquet(path))
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema.SNAPSHOT)
        raise


def _read_day_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """Files that were each typed by their own content: waits are whole on a day that has them all, else fractional.

    Files of one schema are read together. The loop sees one footer per day file, and only when schemas differ.
    """
    try:
        return conform(spark.read.option("mergeSchema", True).parquet(*files))
    except Py4JJavaError as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error.java_exception):
            raise
    by_schema: dict[str, list[str]] = {}
    for file in files:
        by_schema.setdefault(spark.read.parquet(file).schema.json(), []).append(file)
    return reduce(DataFrame.unionByName, [conform(spark.read.parquet(*same)) for same in by_schema.values()])


def prefer_live(live: DataFrame, seed: DataFrame, include_seed: bool = False) -> DataFrame:
    """Simulated rows never join real ones unless asked for: with any live row present the seed is dropped.

    Whether there is a live row is one `EXISTS` subquery, so the seed is not read at all for its answer.
    """
    if include_seed:
        return live.unionByName(seed)
    return live.unionByName(seed.where(~live.exists()))


def split_by_source(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(live, seed) rows of a store that holds both. Whatever is not labelled as seed is live, so no row is lost."""
    seed = F.col("data_source").eqNullSafe(SEED_SOURCE)
    return snapshots.filter(~seed), snapshots.filter(seed)
