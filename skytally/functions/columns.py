"""Column helpers shared by the batch and streaming jobs. All stay in the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit factors; fixed values.
FEET_PER_METRE = 3.280839895
KNOTS_PER_METRE_PER_SECOND = 1.943844

# Band edges in feet, lowest first; fixed values.
BAND_CEILINGS_FT = ((10000, "below_10k"), (24000, "10k_to_24k"), (35000, "24k_to_35k"))


def instant(value: dt.datetime | Column) -> Column:
    """A point in time as a column; naive datetimes are taken as UTC."""
    if isinstance(value, Column):
        return value
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    micros = (value - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def hours_before(moment: Column, hours: int) -> Column:
    return moment - F.make_dt_interval(hours=F.lit(hours))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def grid_snap(coordinate: Column, degrees: float) -> Column:
    """Lower edge of the cell; rounds toward minus infinity for the southern and western half."""
    return F.floor(coordinate / F.lit(degrees)).cast("double") * F.lit(degrees)


def altitude_band(on_ground: Column, altitude_ft: Column) -> Column:
    band = F.when(on_ground, "ground").when(altitude_ft.isNull(), "unknown")
    for ceiling, name in BAND_CEILINGS_FT:
        band = band.when(altitude_ft < ceiling, name)
    return band.otherwise("above_35k")


def heading_part(trig, on_ground: Column, track: Column) -> Column:
    """Sine or cosine of an airborne heading; null where the heading means nothing."""
    return F.when(~on_ground & track.isNotNull(), trig(F.radians(track)))


def mean_bearing(mean_sin: Column, mean_cos: Column) -> Column:
    """Compass bearing of a mean heading vector, one decimal.

    Rounding comes last, so 360.0 is a possible result.
    """
    return F.round((F.degrees(F.atan2(mean_sin, mean_cos)) + 360) % 360, 1)


def resultant_length(mean_sin: Column, mean_cos: Column) -> Column:
    """1 when all headings agree, 0 when they cancel out; three decimals."""
    return F.round(F.sqrt(mean_sin * mean_sin + mean_cos * mean_cos), 3)


def percentage(part: Column, whole: Column, places: int) -> Column:
    """Null, not an error, when there is nothing to take a share of."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), places)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)
