"""Fixed schemas: stored snapshots and the two API payloads."""

from pyspark.sql import types as T

SNAPSHOT = T.StructType(
    [
        T.StructField("captured_at", T.TimestampNTZType()),
        T.StructField("park_id", T.IntegerType()),
        T.StructField("park_name", T.StringType()),
        T.StructField("land_name", T.StringType()),
        T.StructField("ride_id", T.IntegerType()),
        T.StructField("ride_name", T.StringType()),
        T.StructField("is_open", T.BooleanType()),
        T.StructField("wait_time_minutes", T.IntegerType()),
        T.StructField("source_last_updated", T.StringType()),
        T.StructField("data_source", T.StringType()),
    ]
)

# What a capture writes: waits are not yet cast to whole minutes.
CAPTURE = T.StructType(
    [T.StructField(f.name, T.DoubleType() if f.name == "wait_time_minutes" else f.dataType) for f in SNAPSHOT]
)

# A landed API answer: the payload as text, next to what the request was for. Times are UTC, written without a zone.
LANDED = T.StructType(
    [
        T.StructField("captured_at", T.TimestampNTZType()),
        T.StructField("park_id", T.IntegerType()),
        T.StructField("park_name", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)

CORRUPT = "_corrupt_record"

# id, wait_time and is_open are read as text so that a value of the wrong type costs that value only.
_RIDE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("is_open", T.StringType()),
        T.StructField("wait_time", T.StringType()),
        T.StructField("last_updated", T.StringType()),
    ]
)
_LAND = T.StructType([T.StructField("name", T.StringType()), T.StructField("rides", T.ArrayType(_RIDE))])
QUEUE_PAYLOAD = T.StructType(
    [
        T.StructField("rides", T.ArrayType(_RIDE)),
        T.StructField("lands", T.ArrayType(_LAND)),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

_PARK = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
PARKS_PAYLOAD = T.ArrayType(T.StructType([T.StructField("parks", T.ArrayType(_PARK))]))
