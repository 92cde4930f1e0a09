"""Rounding and averages that do not depend on the engine or on row order."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, places: int) -> Column:
    """Scale, round half away from zero, scale back.

    `F.round(x, n)` works on the shortest decimal text of a double (1.005 -> 1.01); the marts need the rounding of the
    scaled double (1.005 -> 1.0).
    """
    scale = float(10**places)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def round_half_even(value: Column, places: int) -> Column:
    """The same with banker's rounding, as reports show aggregates."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def to_whole(value: Column) -> Column:
    """Fraction to int with half-even rounding (a plain Spark cast would truncate). NULL for what is no int."""
    return F.rint(value.cast("double")).try_cast("int")


def to_number(text: Column) -> Column:
    """Text to double, NULL unless it is a plain finite number (Spark also takes "NaN", "Infinity" and "35d")."""
    plain = F.btrim(text).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    number = F.when(plain, F.btrim(text).try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL when there is nothing to divide by."""
    return part.cast("double") / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL when there is nothing to divide by."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def exact_sum(value: Column, places: int) -> Column:
    """Sum of a double that holds `places` decimals, added as decimals so that the order of rows cannot show."""
    return F.sum(value.cast(f"decimal(18,{places})")).cast("double")


def exact_mean(value: Column, places: int) -> Column:
    return exact_sum(value, places) / F.nullif(F.count(value), F.lit(0))
