"""Movements: flight endpoints matched to the nearest airport by a grid-indexed radius join, and daily operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.config import DEFAULTS, METRIC_SOURCE, Thresholds
from strider.functions.columns import haversine_km

AIRPORT = ("ident", "iata_code", "name", "type", "iso_country", "latitude_deg", "longitude_deg", "elevation_ft")
BROADCAST_AIRPORTS = 200_000


def airport_cells(airports: DataFrame) -> DataFrame:
    """Each airport in the 3 x 3 one-degree cells around it, so that nearby points meet it by an equi-join."""
    near = F.array(*[F.struct(F.lit(a).alias("dlat"), F.lit(b).alias("dlon")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    df = airports.select(*AIRPORT, F.explode(near).alias("n"))
    return df.select(*AIRPORT, (F.floor("latitude_deg") + F.col("n.dlat")).alias("cell_lat"), (F.floor("longitude_deg") + F.col("n.dlon")).alias("cell_lon"))


def grid_radius_join(points: DataFrame, airports: DataFrame, radius_km: float) -> DataFrame:
    """All pairs of a point (latitude, longitude) and an airport within the radius, with distance_km.

    The airports are a reference table; they are broadcast only where a count proves them few.
    """
    cells = airport_cells(airports)
    if airports.limit(BROADCAST_AIRPORTS + 1).count() <= BROADCAST_AIRPORTS:
        cells = F.broadcast(cells)
    met = points.join(cells, (F.floor(points["latitude"]) == cells["cell_lat"]) & (F.floor(points["longitude"]) == cells["cell_lon"])).drop("cell_lat", "cell_lon")
    km = haversine_km(F.col("latitude"), F.col("longitude"), F.col("latitude_deg"), F.col("longitude_deg"))
    return met.withColumn("distance_km", km).where(F.col("distance_km") <= radius_km)


def endpoints(flights: DataFrame) -> DataFrame:
    """Both ends of every flight that moved; a flight with an unknown end position did not, as far as is known.

    One pass gives both: a union of two selections would make the flights twice, in the same tasks.
    """
    moved = flights.where(~((F.col("first_latitude") == F.col("last_latitude")) & (F.col("first_longitude") == F.col("last_longitude"))))
    about = ("flight_id", "icao", "aircraft_type", "registered_owner", "callsign", "release_tag", "release_date")

    def end(kind: str, side: str) -> Column:
        return F.struct(
            F.lit(kind).alias("movement_type"), F.col(f"{side}_seen_time").alias("event_time"), F.col(f"{side}_latitude").alias("latitude"),
            F.col(f"{side}_longitude").alias("longitude"), F.col(f"{side}_altitude_ft").alias("altitude_ft"),
        )

    ends = F.explode(F.array(end("departure", "first"), end("arrival", "last")))
    return moved.select(*about, ends.alias("end")).select(*about, "end.*")


MOVEMENT = (
    "flight_id", "icao", "aircraft_type", "registered_owner", "callsign", "movement_type", "event_time", "latitude", "longitude", "altitude_ft",
    "ident", "iata_code", "airport_name", "airport_type", "iso_country", "latitude_deg", "longitude_deg", "elevation_ft", "distance_km", "release_tag", "release_date",
)


def airport_movements(flights: DataFrame, airports: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """One row for each endpoint near an airport: the nearest, low enough above its field or on the ground."""
    near = grid_radius_join(endpoints(flights), airports, limits.match_radius_km)
    low = F.col("altitude_ft").isNull() | (F.col("altitude_ft") - F.coalesce("elevation_ft", F.lit(0.0)) <= limits.max_height_ft)
    w = W.partitionBy("flight_id", "movement_type").orderBy("distance_km", "ident")
    best = near.where(low).withColumn("__rank", F.row_number().over(w)).where("__rank = 1")
    return best.withColumnsRenamed({"name": "airport_name", "type": "airport_type"}).select(*MOVEMENT)


OPERATION_KEY = {
    "airport_ident": "ident", "airport_iata": "iata_code", "airport_name": "airport_name", "airport_type": "airport_type", "iso_country": "iso_country",
    "airport_latitude": "latitude_deg", "airport_longitude": "longitude_deg",
}


def to_airport_operations(movements: DataFrame, holds: DataFrame | None = None) -> DataFrame:
    """Daily operations by airport; with holds also how many arrivals held and for how long."""
    keys = [F.to_date("event_time").alias("operations_date"), *[F.col(c).alias(k) for k, c in OPERATION_KEY.items()]]
    is_a = lambda kind: F.count_if(F.col("movement_type") == kind)
    ops = movements.groupBy(*keys).agg(
        is_a("arrival").alias("arrivals"), is_a("departure").alias("departures"), F.count(F.lit(1)).alias("total_operations"),
        F.count_distinct("icao").alias("unique_aircraft"), F.min("event_time").alias("first_operation_time"), F.max("event_time").alias("last_operation_time"),
        F.max("release_tag").alias("release_tag"), F.max("release_date").alias("release_date"),
    ).withColumn("metric_source", F.lit(METRIC_SOURCE))
    if holds is None:
        return ops
    df = ops.join(hold_metrics(holds), ["operations_date", "airport_ident"], "left")
    held = F.coalesce("flights_with_detected_holds", F.lit(0).cast("long"))
    df = df.withColumn("flights_with_detected_holds", held)
    df = df.withColumn("hold_rate", F.when(F.col("arrivals") > 0, F.round(F.col("flights_with_detected_holds") / F.col("arrivals"), 4)))
    return df.select(*ops.columns, "flights_with_detected_holds", "hold_rate", "avg_hold_duration_seconds")


def hold_metrics(holds: DataFrame) -> DataFrame:
    """Holding flights and their mean hold by day and arrival airport."""
    known = holds.where(F.col("arrival_airport_ident").isNotNull())
    return known.groupBy(F.to_date("hold_start").alias("operations_date"), F.col("arrival_airport_ident").alias("airport_ident")).agg(
        F.count_distinct("flight_id").alias("flights_with_detected_holds"), F.round(F.avg("duration_seconds")).alias("avg_hold_duration_seconds")
    )
