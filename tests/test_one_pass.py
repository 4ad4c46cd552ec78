import re

from pyspark.sql import functions as F

from strider.operators import decode, flights, movements

T0 = 1767052800
ROWS = "icao string, sec double, latitude double, longitude double"


def frame(spark, rows):
    df = spark.createDataFrame(rows, ROWS).withColumn("event_time", F.timestamp_micros((F.col("sec") * 1_000_000).cast("long")))
    text = {c: F.lit(None).cast("string") for c in ("registration", "aircraft_type", "operator", "callsign", "release_tag")}
    number = {c: F.lit(1.0) for c in ("altitude_ft", "ground_speed_kt", "track_deg", "vertical_rate_fpm")}
    return df.withColumns(text | number | {"on_ground": F.lit(False), "is_icao_address": F.lit(True), "release_date": F.to_date("event_time")})


def operators(df, name):
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return len(re.findall(rf"^[ :+*-]*(?:\(\d+\) )?{name}\b", plan, re.M))


def test_observations_are_sorted_once(spark):
    df = decode.assign_flights(frame(spark, [("a", float(T0), 1.0, 2.0)]))
    assert operators(df, "Sort") == 1 and operators(df, "Exchange") == 1


def test_both_ends_come_from_one_pass_over_the_flights(spark):
    df = movements.endpoints(flights.aggregate_flights(decode.assign_flights(frame(spark, [("a", float(T0), 1.0, 2.0), ("a", T0 + 9.0, 1.5, 2.0)]))))
    assert operators(df, "Union") == 0 and operators(df, "Exchange") == 1
    got = sorted((r.movement_type, r.event_time.timestamp() - T0, r.latitude) for r in df.select("movement_type", "event_time", "latitude").collect())
    assert [(k, at) for k, _, at in got] == [("arrival", 1.5), ("departure", 1.0)] and got[0][1] - got[1][1] == 9


def test_flights_and_places_with_equal_times_gaps_and_unknown_positions(spark):
    rows = [("b", T0 + 5000.0, 4.0, 1.0), ("a", T0 + 0.0, 3.0, 1.0), ("a", T0 + 0.0, None, 1.0), ("a", T0 + 0.0, 3.0, 0.5), ("a", T0 + 900.0, 1.0, 1.0), ("a", T0 + 1801.0, 9.0, 1.0), ("a", T0 + 1801.0, 8.0, 1.0), ("a", T0 + 2000.5, 0.0, 1.0)]
    got = decode.assign_flights(frame(spark, rows).repartition(4)).orderBy("flight_id", "observation_seq").collect()
    a, later, b = "a_20251230000000", "a_20251230003001", "b_20251230012320"
    assert [(r.flight_id, r.observation_seq, r.latitude, r.longitude) for r in got] == [
        (a, 1, None, 1.0), (a, 2, 3.0, 0.5), (a, 3, 3.0, 1.0), (a, 4, 1.0, 1.0), (later, 1, 8.0, 1.0), (later, 2, 9.0, 1.0), (later, 3, 0.0, 1.0), (b, 1, 4.0, 1.0),
    ]


def test_observations_without_a_time_have_no_flight(spark):
    got = decode.assign_flights(frame(spark, [("a", None, 1.0, 1.0), ("a", None, 2.0, 1.0), ("a", float(T0), 3.0, 1.0)])).orderBy("latitude").collect()
    assert [(r.flight_id, r.observation_seq) for r in got] == [(None, 1), (None, 1), ("a_20251230000000", 1)]
