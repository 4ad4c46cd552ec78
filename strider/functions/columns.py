"""Column expressions the operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from strider.config import AIRLINE_CALLSIGN, EARTH_RADIUS_KM


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds(c: Column | str) -> Column:
    """Whole epoch seconds: all gaps and durations are differences of these."""
    return F.unix_timestamp(col(c))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_chord = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * 2 * F.asin(F.sqrt(half_chord))


def signed_turn(now: Column, before: Column) -> Column:
    """The change of heading, in [-180, 180)."""
    return F.pmod(now - before + 180, F.lit(360)) - 180


def over_limit_to_null(c: Column | str, limit: float, absolute: bool = False) -> Column:
    """Null an implausible value; the row stays."""
    c = col(c)
    return F.when((F.abs(c) if absolute else c) > limit, None).otherwise(c)


def airline_of(callsign: Column | str) -> Column:
    """The three letters of an airline-style callsign; null for registrations."""
    c = col(callsign)
    return F.when(c.rlike(AIRLINE_CALLSIGN), F.substring(c, 1, 3))


def flight_id(icao: Column, first_seen: Column) -> Column:
    return F.concat(icao, F.lit("_"), F.date_format(first_seen, "yyyyMMddHHmmss"))


# ---- display -----------------------------------------------------------------------------------------------


def text_or(c: Column | str, fallback: str | Column = "—") -> Column:
    return F.coalesce(col(c).cast("string"), fallback if isinstance(fallback, Column) else F.lit(fallback))


def duration_text(c: Column | str) -> Column:
    """1h 24m, 3m 05s, 9s; a dash for null."""
    s = col(c).cast("long")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return (
        F.when(s.isNull(), "—")
        .when(h > 0, F.format_string("%dh %02dm", h, m))
        .when(m > 0, F.format_string("%dm %02ds", m, s % 60))
        .otherwise(F.format_string("%ds", s))
    )


def clock_text(c: Column | str) -> Column:
    return F.coalesce(F.date_format(col(c), "HH:mm"), F.lit("—"))


# ---- boxes -------------------------------------------------------------------------------------------------

KM_PER_DEGREE = math.pi * EARTH_RADIUS_KM / 180


def box_around(latitude: float, longitude: float, km: float) -> tuple[float, float, float, float]:
    """(south, north, west, east) of a box that holds the circle, a thousandth wider to err outward."""
    reach = km * 1.001 / KM_PER_DEGREE
    side = reach / math.cos(math.radians(latitude))
    west, east = longitude - side, longitude + side
    if west < -180 or east > 180:
        raise ValueError(f"a box around longitude {longitude} crosses the antimeridian")
    return latitude - reach, latitude + reach, west, east


def in_any_box(boxes, latitude: Column, longitude: Column) -> Column:
    if not boxes:
        raise ValueError("no boxes: nothing would pass")
    out = F.lit(False)
    for south, north, west, east in boxes:
        out = out | (latitude.between(south, north) & longitude.between(west, east))
    return out
