"""Identity and severity of an outage."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The severity bands in ascending order, with the minutes each begins at.
SEVERITY_BANDS = (
    ("Brief (<30m)", 0),
    ("Moderate (30-60m)", 30),
    ("Significant (1-2h)", 60),
    ("Major (2h+)", 120),
)
SEVERITY_NAMES = tuple(name for name, _ in SEVERITY_BANDS)


def severity_band(minutes: Column) -> Column:
    lowest, *higher = SEVERITY_BANDS
    band = F.lit(lowest[0])
    for name, begins_at in higher:
        band = F.when(minutes >= begins_at, name).otherwise(band)
    return band


def severity_rank(band: Column) -> Column:
    """Position of a band in ascending order of severity, for sorting."""
    return F.array_position(F.array(*[F.lit(n) for n in SEVERITY_NAMES]), band)


def outage_key(ride_id: Column, started_at: Column) -> Column:
    """Stable id of an outage: md5 hex of ride and start. NULL when either is."""
    return F.md5(F.concat(ride_id.cast("string"), F.lit("|"), started_at.cast("string")))
