"""Flights: one row for each continuous tracking period, with its airports and holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strider.functions.columns import airline_of, seconds


def aggregate_flights(observations: DataFrame) -> DataFrame:
    """Collapse observations by flight. Endpoints keep nulls; the callsign is the first that was reported."""
    t, known = F.col("event_time"), F.col("callsign").isNotNull()
    first = lambda c: F.min_by(c, t)
    last = lambda c: F.max_by(c, t)
    return observations.groupBy("flight_id", "icao").agg(
        F.max("is_icao_address").alias("is_icao_address"),
        F.max("registration").alias("registration"),
        F.max("aircraft_type").alias("aircraft_type"),
        F.max("operator").alias("registered_owner"),
        F.min_by("callsign", F.when(known, t)).alias("callsign"),
        F.count_distinct("callsign").alias("n_callsigns"),
        F.min(t).alias("first_seen_time"),
        F.max(t).alias("last_seen_time"),
        (seconds(F.max(t)) - seconds(F.min(t))).alias("duration_seconds"),
        F.count(F.lit(1)).alias("n_observations"),
        first("latitude").alias("first_latitude"),
        first("longitude").alias("first_longitude"),
        last("latitude").alias("last_latitude"),
        last("longitude").alias("last_longitude"),
        first("on_ground").alias("started_on_ground"),
        last("on_ground").alias("ended_on_ground"),
        first("altitude_ft").alias("first_altitude_ft"),
        last("altitude_ft").alias("last_altitude_ft"),
        F.coalesce(F.max(F.coalesce("on_ground", F.lit(False))), F.lit(False)).alias("saw_ground"),
        F.max("altitude_ft").alias("max_altitude_ft"),
        F.max("ground_speed_kt").alias("max_ground_speed_kt"),
        F.max("release_tag").alias("release_tag"),
        F.max("release_date").alias("release_date"),
    )


ENDS = ("departure", "arrival")
END_FIELDS = (("airport_ident", "ident"), ("airport_iata", "iata_code"), ("airport_name", "airport_name"), ("time", "event_time"), ("distance_km", "distance_km"))


def movement_pivot(movements: DataFrame) -> DataFrame:
    """Movements as departure and arrival columns, one row by flight."""
    at = lambda end, c: F.max(F.when(F.col("movement_type") == end, F.col(c)))
    return movements.groupBy("flight_id").agg(*[at(end, c).alias(f"{end}_{name}") for end in ENDS for name, c in END_FIELDS])


def hold_rollup(holds: DataFrame) -> DataFrame:
    return holds.groupBy("flight_id").agg(F.count(F.lit(1)).alias("n_detected_holds"), F.sum("duration_seconds").alias("total_hold_seconds"))


FLIGHT = (
    "flight_id", "flight_date", "icao", "is_icao_address", "registration", "aircraft_type", "callsign", "n_callsigns", "airline_icao", "registered_owner",
    "first_seen_time", "last_seen_time", "duration_seconds", "n_observations", "first_latitude", "first_longitude", "last_latitude", "last_longitude",
    "first_altitude_ft", "last_altitude_ft", "started_on_ground", "ended_on_ground", "saw_ground", "max_altitude_ft", "max_ground_speed_kt",
    *[f"{end}_{name}" for end in ENDS for name, _ in END_FIELDS], "n_detected_holds", "has_detected_hold", "total_hold_seconds", "release_tag", "release_date",
)


def to_flights(base: DataFrame, pivot: DataFrame, holds: DataFrame) -> DataFrame:
    """The flight table: aggregate, matched airports (null where none) and hold rollups (0 where none)."""
    none = F.lit(0).cast("long")
    df = base.join(pivot, "flight_id", "left").join(hold_rollup(holds), "flight_id", "left")
    return df.withColumns(
        {
            "flight_date": F.to_date("first_seen_time"),
            "airline_icao": airline_of("callsign"),
            "n_detected_holds": F.coalesce("n_detected_holds", none),
            "has_detected_hold": F.coalesce("n_detected_holds", none) > 0,
            "total_hold_seconds": F.coalesce("total_hold_seconds", none),
        }
    ).select(*FLIGHT)


def attribute_coverage(flights: DataFrame, columns=("registration", "aircraft_type", "airline_icao", "callsign", "departure_airport_ident", "arrival_airport_ident")) -> DataFrame:
    """How many percent of flights carry each attribute, and how many have several callsigns."""
    pct = lambda c: F.round(100.0 * F.count(c) / F.count(F.lit(1)), 1)
    return flights.agg(F.count(F.lit(1)).alias("flights"), *[pct(c).alias(f"{c}_pct") for c in columns], F.count_if(F.col("n_callsigns") > 1).alias("several_callsigns"))
