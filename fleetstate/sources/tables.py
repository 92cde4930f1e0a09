"""Named tables, views and CSV. Tables are written aside, checked, and only then put in the place of the old ones."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# View in a run's own schema: its tables and their columns. It is there once all of them are written and checked.
_READY = "release_ready"


class Release:
    """The tables of one run. Each is written into a schema of the run; its public name is a view, which `publish` points
    at it. Until then readers of the public names see the tables of the run before, whole and unchanged.

    A run that fails, or dies, has changed nothing that readers see. One that dies while it publishes has pointed some
    names at its tables; `finish`, or the next run, points the others. The tables of the run before the published one are
    kept for queries that still read them. There is one writer at a time.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.run = f"r{dt.datetime.now(dt.timezone.utc):%Y%m%dt%H%M%S%f}_{uuid.uuid4().hex[:6]}"
        self.saved: dict[str, list[str]] = {}

    def staged(self, name: str) -> str:
        schema, table = name.split(".")
        return f"{schema}__{self.run}.{table}"

    def save(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write the rows of `df` as table `name` of this run, in one folder per value of `by` when given."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.staged(name).split('.')[0]}")
        if by:
            df.write.partitionBy(by).saveAsTable(self.staged(name))
        else:
            df.write.saveAsTable(self.staged(name))
        self.saved[name] = df.columns
        return self.spark.table(self.staged(name)).select(df.columns)

    def publish(self) -> None:
        """Point all public names at the tables of this run: all of them, or, if this dies before all are marked ready, none."""
        by_schema: dict[str, list[str]] = {}
        for name in self.saved:
            by_schema.setdefault(name.split(".")[0], []).append(name)
        together = ",".join(f"{schema}__{self.run}" for schema in by_schema)
        for schema, names in by_schema.items():
            rows = [f"('{together}', '{n.split('.')[1]}', {i}, '{column}')" for n in names for i, column in enumerate(self.saved[n])]
            made = f"SELECT * FROM VALUES {', '.join(rows)} AS t(together, table_name, place, column_name)"
            self.spark.sql(f"CREATE VIEW {schema}__{self.run}.{_READY} AS {made}")
        for schema in by_schema:
            finish(self.spark, schema)

    def discard(self) -> None:
        """Drop what this run has written."""
        for schema in {self.staged(name).split(".")[0] for name in self.saved}:
            self.spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def _runs(spark: SparkSession, schema: str) -> list[str]:
    """Schemas of the runs of `schema`, in order of time."""
    found = (row[0] for row in spark.sql(f"SHOW SCHEMAS LIKE '{schema}__r*'").collect())
    return sorted(s for s in found if re.fullmatch(re.escape(schema) + r"__r\d{8}t\d{12}_[0-9a-f]{6}", s))


def _is_ready(spark: SparkSession, run: str) -> bool:
    """Whether all schemas of a run are marked."""
    if not spark.catalog.tableExists(f"{run}.{_READY}"):
        return False
    together = spark.table(f"{run}.{_READY}").first()["together"].split(",")
    return all(spark.catalog.tableExists(f"{schema}.{_READY}") for schema in together)


def finish(spark: SparkSession, schema: str) -> None:
    """Point the public names of `schema` at the last run that is ready, and drop all but it and the one before."""
    ready = [run for run in _runs(spark, schema) if _is_ready(spark, run)]
    if not ready:
        return
    columns: dict[str, list[str]] = {}
    for row in spark.table(f"{ready[-1]}.{_READY}").orderBy("table_name", "place").collect():
        columns.setdefault(row["table_name"], []).append(f"`{row['column_name']}`")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for table, names in columns.items():
        # A plain table of this name, of before there were releases, makes room first.
        if spark.catalog.tableExists(f"{schema}.{table}") and spark.catalog.getTable(f"{schema}.{table}").tableType != "VIEW":
            spark.sql(f"DROP TABLE {schema}.{table}")
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{table} AS SELECT {', '.join(names)} FROM {ready[-1]}.{table}")
    for run in _runs(spark, schema):
        if run < ready[-1] and run not in ready[-2:]:
            spark.sql(f"DROP SCHEMA IF EXISTS {run} CASCADE")


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """Table `name`, or an empty frame without columns when there is none. Any other error is an error."""
    try:
        return spark.table(name)
    except AnalysisException as error:
        if error.getCondition() not in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
            raise
        return spark.createDataFrame([], "")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. A file set; sorted input stays sorted across its files."""
    df.write.mode("overwrite").option("header", True).csv(path)


def by_date(df: DataFrame, column: str) -> DataFrame:
    """Dealt out for a write by date: few files for each, and a date too big for one task is split."""
    return df.hint("rebalance", F.col(column))
