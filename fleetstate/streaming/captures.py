"""Structured Streaming wrapper around the batch merge.

The stream only says which payloads are new. A late capture needs no watermark: it is added to its own day.
"""

from __future__ import annotations

import logging
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetstate import schema
from fleetstate.sources.daystore import merge_days
from fleetstate.sources.payloads import bad_payloads, bad_rides, flatten_rides

log = logging.getLogger(__name__)

# What says which of two answers arrived last.
ARRIVAL = ("arrived_at", "arrived_in", "block", "line")


def land_captures(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    parks: Collection[int] | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Merge every payload file not seen before into the store, then stop.

    `landing` holds JSON lines of schema.LANDED. Of two answers for one time and ride the last to arrive counts: by the
    file's time, its name, and the line. A merge may be repeated, so a batch that is replayed after a failure does no
    harm. `files_per_batch` splits a big backlog.

    `parks` are the ids to capture (of `require_parks`); answers of others are left out. `rejects` is a folder for what
    could not be used, by batch: `answers` (see `bad_payloads`) and `rides` (see `bad_rides`). A batch that is replayed
    writes its folder anew. With `rejects`, `batches` there has a line for each batch: answers, those that could not be used, and
    captures written. A batch without any usable row writes nothing to the store and is reported in the log.
    """
    reader = spark.readStream.schema(schema.LANDED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    file = F.col("_metadata")
    landed = reader.json(landing).select(
        "*",
        file["file_modification_time"].alias("arrived_at"),
        file["file_path"].alias("arrived_in"),
        file["file_block_start"].alias("block"),
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Lines of a block are read in order.
        answers = batch.withColumn("line", F.monotonically_increasing_id())
        if parks is not None:
            answers = answers.filter(F.col("park_id").isin(list(parks)))
        columns = ["captured_at", "park_id", "park_name", "payload"]
        written = merge_days(flatten_rides(answers, ARRIVAL), store, order=(*ARRIVAL, "payload_pos"))
        if not written:
            log.warning("batch %d has no usable row; nothing written", batch_id)
        if rejects:
            bad = bad_payloads(answers.select(columns))
            bad.write.mode("overwrite").json(f"{rejects}/answers/batch={batch_id}")
            bad_rides(answers.select(columns)).write.mode("overwrite").json(f"{rejects}/rides/batch={batch_id}")
            counts = answers.agg(F.count(F.lit(1)).alias("answers")).crossJoin(bad.agg(F.count(F.lit(1)).alias("unusable")))
            counts.withColumn("captures", F.lit(written)).write.mode("overwrite").json(f"{rejects}/batches/batch={batch_id}")

    return (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
