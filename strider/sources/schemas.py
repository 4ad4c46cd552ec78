"""Declared schemas of what is read and of what is published."""

from pyspark.sql import types as T


KINDS = {
    "string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "bigint": T.LongType(), "timestamp": T.TimestampType(),
    "date": T.DateType(), "array<array<string>>": T.ArrayType(T.ArrayType(T.StringType())),
}


def struct(spec: str) -> T.StructType:
    """A schema from "name type, name type", without a session."""
    return T.StructType([T.StructField(n, KINDS[k]) for n, k in (x.split() for x in spec.split(","))])


RAW_TRACE = struct("icao string, r string, t string, ownOp string, timestamp double, trace array<array<string>>")
AIRPORTS = struct("ident string, iata_code string, name string, type string, iso_country string, latitude_deg double, longitude_deg double, elevation_ft double")
LEGACY_STATES = struct(", ".join(f"{c} string" for c in "time icao24 lat lon velocity heading vertrate callsign on_ground alert spi squawk baroaltitude geoaltitude lastposupdate lastcontact".split()))

OBSERVATIONS = struct(
    "flight_id string, icao string, is_icao_address boolean, registration string, aircraft_type string, operator string, event_time timestamp, observation_seq int, "
    "latitude double, longitude double, on_ground boolean, altitude_ft double, ground_speed_kt double, track_deg double, vertical_rate_fpm double, callsign string, "
    "release_tag string, release_date date"
)
FLIGHTS = struct(
    "flight_id string, flight_date date, icao string, is_icao_address boolean, registration string, aircraft_type string, callsign string, n_callsigns bigint, airline_icao string, "
    "registered_owner string, first_seen_time timestamp, last_seen_time timestamp, duration_seconds bigint, n_observations bigint, first_latitude double, first_longitude double, "
    "last_latitude double, last_longitude double, first_altitude_ft double, last_altitude_ft double, started_on_ground boolean, ended_on_ground boolean, saw_ground boolean, "
    "max_altitude_ft double, max_ground_speed_kt double, departure_airport_ident string, departure_airport_iata string, departure_airport_name string, departure_time timestamp, "
    "departure_distance_km double, arrival_airport_ident string, arrival_airport_iata string, arrival_airport_name string, arrival_time timestamp, arrival_distance_km double, "
    "n_detected_holds bigint, has_detected_hold boolean, total_hold_seconds bigint, release_tag string, release_date date"
)
MOVEMENTS = struct(
    "flight_id string, icao string, aircraft_type string, registered_owner string, callsign string, movement_type string, event_time timestamp, latitude double, longitude double, "
    "altitude_ft double, ident string, iata_code string, airport_name string, airport_type string, iso_country string, latitude_deg double, longitude_deg double, elevation_ft double, "
    "distance_km double, release_tag string, release_date date"
)
FLIGHT_PHASES = struct(
    "flight_id string, phase_seq int, phase string, start_time timestamp, end_time timestamp, duration_seconds bigint, n_observations bigint, start_altitude_ft double, "
    "end_altitude_ft double, min_altitude_ft double, max_altitude_ft double, avg_ground_speed_kt double, avg_vertical_rate_fpm double, release_date date"
)
FLIGHT_HOLDS = struct(
    "flight_id string, hold_seq int, hold_start timestamp, hold_end timestamp, duration_seconds bigint, n_observations bigint, centroid_latitude double, centroid_longitude double, "
    "span_km double, min_altitude_ft double, max_altitude_ft double, mean_altitude_ft double, turn_degrees double, circuits double, max_sample_gap_seconds bigint, "
    "arrival_airport_ident string, arrival_airport_iata string, distance_to_arrival_airport_km double, release_date date"
)
AIRPORT_DAILY_OPERATIONS = struct(
    "operations_date date, airport_ident string, airport_iata string, airport_name string, airport_type string, iso_country string, airport_latitude double, airport_longitude double, "
    "arrivals bigint, departures bigint, total_operations bigint, unique_aircraft bigint, first_operation_time timestamp, last_operation_time timestamp, release_tag string, "
    "release_date date, metric_source string, flights_with_detected_holds bigint, hold_rate double, avg_hold_duration_seconds double"
)
PUBLISHED = {
    "observations": OBSERVATIONS, "flights": FLIGHTS, "movements": MOVEMENTS, "flight_phases": FLIGHT_PHASES, "flight_holds": FLIGHT_HOLDS,
    "airport_daily_operations": AIRPORT_DAILY_OPERATIONS,
}
