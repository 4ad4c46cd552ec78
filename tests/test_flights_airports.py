import pytest
from pyspark.sql import functions as F

from strider.operators import flights, movements
from strider.sources import schemas

AIRPORTS = [("LSZH", "ZRH", "Zurich", "large_airport", "CH", 47.458056, 8.548056, 1417.0), ("LSZX", None, "Near", "medium_airport", "CH", 47.47, 8.56, None), ("KDEN", "DEN", "Denver", "large_airport", "US", 39.8617, -104.6731, 5431.0)]


@pytest.fixture(scope="module")
def airports(spark):
    return spark.createDataFrame(AIRPORTS, schemas.AIRPORTS)


def flight(spark, *rows):
    """rows: (id, first lat, lon, alt, last lat, lon, alt)"""
    spec = "flight_id string, first_latitude double, first_longitude double, first_altitude_ft double, last_latitude double, last_longitude double, last_altitude_ft double"
    df = spark.createDataFrame(rows, spec)
    return df.select(
        "*", F.col("flight_id").alias("icao"), F.lit("A320").alias("aircraft_type"), F.lit("X").alias("registered_owner"), F.lit("SWR1").alias("callsign"), F.lit("t").alias("release_tag"),
        F.lit("2025-12-30").cast("date").alias("release_date"), F.timestamp("2025-12-30 10:00:00") if hasattr(F, "timestamp") else F.lit("2025-12-30 10:00:00").cast("timestamp").alias("first_seen_time"),
        F.lit("2025-12-30 11:00:00").cast("timestamp").alias("last_seen_time"),
    )


def moves(spark, airports, *rows):
    return {(r.flight_id, r.movement_type): r for r in movements.airport_movements(flight(spark, *rows), airports).collect()}


def test_nearest_airport_wins_at_either_end(spark, airports):
    got = moves(spark, airports, ("a", 47.46, 8.55, None, 39.86, -104.67, 5500.0))
    assert got["a", "departure"].ident == "LSZH" and got["a", "arrival"].ident == "KDEN"
    assert got["a", "departure"].distance_km < 5


def test_height_is_above_the_field(spark, airports):
    got = moves(spark, airports, ("low", 39.86, -104.67, 10431.0, 0.0, 0.0, None), ("high", 39.86, -104.67, 10432.0, 0.0, 0.0, None), ("nofield", 47.471, 8.561, 5000.0, 0.0, 0.0, None))
    assert ("low", "departure") in got and ("high", "departure") not in got and got["nofield", "departure"].ident == "LSZX"


def test_what_never_moved_or_is_far_is_no_movement(spark, airports):
    assert moves(spark, airports, ("still", 47.46, 8.55, None, 47.46, 8.55, None), ("far", 47.6, 8.55, None, 46.0, 8.0, None), ("half", 47.46, 8.55, None, None, None, None)) == {}


def test_daily_operations(spark, airports):
    m = movements.airport_movements(flight(spark, ("a", 47.46, 8.55, None, 39.86, -104.67, 5500.0), ("b", 39.86, -104.67, None, 47.46, 8.55, None)), airports)
    holds = spark.createDataFrame([("b", "LSZH", 300), ("b", "LSZH", 500), ("x", None, 9)], "flight_id string, arrival_airport_ident string, duration_seconds long").withColumn("hold_start", F.lit("2025-12-30 10:30:00").cast("timestamp"))
    got = {r.airport_ident: r for r in movements.to_airport_operations(m, holds).collect()}
    assert (got["LSZH"].arrivals, got["LSZH"].departures, got["LSZH"].total_operations, got["LSZH"].unique_aircraft) == (1, 1, 2, 2)
    assert got["LSZH"].flights_with_detected_holds == 1 and got["LSZH"].hold_rate == 1.0 and got["LSZH"].avg_hold_duration_seconds == 400
    assert got["KDEN"].flights_with_detected_holds == 0 and got["KDEN"].hold_rate == 0.0
    only = movements.to_airport_operations(m.where("movement_type = 'departure'"), holds).collect()
    assert all(r.hold_rate is None for r in only) and "hold_rate" not in movements.to_airport_operations(m).columns


def observations(spark, rows):
    spec = "sec long, latitude double, callsign string, on_ground boolean, altitude_ft double"
    df = spark.createDataFrame(rows, spec)
    names = {"flight_id": "f", "icao": "i", "registration": "R", "aircraft_type": "T", "operator": "O", "release_tag": "t"}
    df = df.select("*", *[F.lit(v).alias(k) for k, v in names.items()])
    return df.withColumns({"is_icao_address": F.lit(True), "longitude": F.lit(1.0), "ground_speed_kt": F.lit(5.0), "event_time": F.timestamp_seconds(F.col("sec") + 1767052800), "release_date": F.lit("2025-12-30").cast("date")})


def test_aggregate_keeps_endpoint_nulls_and_first_callsign(spark):
    r = flights.aggregate_flights(observations(spark, [(9, 3.0, "B", False, None), (0, None, None, None, 10.0), (4, 2.0, "A", True, 20.0)])).first()
    assert r.callsign == "A" and r.n_callsigns == 2 and r.first_latitude is None and r.last_latitude == 3.0
    assert r.duration_seconds == 9 and r.started_on_ground is None and r.saw_ground and r.last_altitude_ft is None and r.max_altitude_ft == 20.0


@pytest.mark.parametrize("callsign,airline", [("SWR123", "SWR"), ("RYR4KL", "RYR"), ("N884GA", None), ("D-EABC", None), ("SWR", None), (None, None)])
def test_airline(spark, callsign, airline):
    from strider.functions.columns import airline_of

    assert spark.createDataFrame([(callsign,)], "c string").select(airline_of("c").alias("a")).first().a == airline


def test_flights_without_matches_and_holds(spark, airports):
    base = flights.aggregate_flights(observations(spark, [(0, 1.0, "SWR1", False, 1.0), (5, 2.0, "SWR1", False, 1.0)]))
    pivot = flights.movement_pivot(movements.airport_movements(base, airports))
    none = spark.createDataFrame([], "flight_id string, duration_seconds long")
    r = flights.to_flights(base, pivot, none).first()
    assert r.n_detected_holds == 0 and not r.has_detected_hold and r.total_hold_seconds == 0 and r.arrival_airport_ident is None
    some = spark.createDataFrame([("f", 300), ("f", 240)], "flight_id string, duration_seconds long")
    r = flights.to_flights(base, pivot, some).first()
    assert (r.n_detected_holds, r.has_detected_hold, r.total_hold_seconds) == (2, True, 540)
    assert r.asDict().keys() == {f.name: 1 for f in schemas.FLIGHTS}.keys()
