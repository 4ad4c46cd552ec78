import math

import pytest
from pyspark.sql import functions as F

from strider.config import DEFAULTS
from strider.operators import holds, phases

T0 = 1767052800


def frame(spark, rows):
    """rows: (second, altitude, on_ground, rate)"""
    data = [("f", T0 + s, i + 1, None if a is None else float(a), g, 100.0, None if r is None else float(r)) for i, (s, a, g, r) in enumerate(rows)]
    df = spark.createDataFrame(data, "flight_id string, sec long, observation_seq int, altitude_ft double, on_ground boolean, ground_speed_kt double, vertical_rate_fpm double")
    return df.withColumn("event_time", F.timestamp_seconds("sec")).withColumn("release_date", F.to_date("event_time"))


def leg(start, n, rate, ground=False, step=10):
    return [(start + i * step, None if ground else 1000 + i, ground, rate) for i in range(n)]


def labels(df):
    return [r.phase for r in phases.to_flight_phases(df).orderBy("phase_seq").collect()]


def test_a_whole_flight(spark):
    rows = leg(0, 6, None, True) + leg(60, 20, 1500) + leg(260, 20, 0) + leg(460, 20, -1500) + leg(660, 6, None, True)
    assert labels(frame(spark, rows)) == ["taxi_out", "climb", "cruise", "descent", "taxi_in"]


def test_ground_only_between_and_unknown(spark):
    assert labels(frame(spark, leg(0, 3, None, True))) == ["taxi"]
    assert labels(frame(spark, leg(0, 3, 900) + leg(30, 3, None, True) + leg(60, 3, 900)))[1] == "taxi"
    assert labels(frame(spark, leg(0, 3, None, None))) == ["unknown"]
    assert labels(frame(spark, leg(0, 3, None, False))) == ["unknown"]


def test_a_spike_is_smoothed_away_and_the_band_is_strict(spark):
    rows = leg(0, 30, 0)
    rows[15] = (150, 1000, False, 1500)
    assert labels(frame(spark, rows)) == ["cruise"]
    assert labels(frame(spark, leg(0, 5, 300))) == ["cruise"] and labels(frame(spark, leg(0, 5, 301))) == ["climb"]


def test_runs_tile_the_flight(spark):
    rows = [(i * 7, 1000, i % 5 == 0, (i * 37) % 2000 - 1000) for i in range(60)]
    got = phases.to_flight_phases(frame(spark, rows)).orderBy("phase_seq").collect()
    assert sum(r.n_observations for r in got) == 60 and [r.phase_seq for r in got] == list(range(1, len(got) + 1))
    assert all(a.end_time < b.start_time and a.phase != b.phase for a, b in zip(got, got[1:]))


def turning(spark, turns, step=5, altitude=5000.0, at=(47.0, 8.0), km=6.0):
    lat, lon, track, rows = at[0], at[1], 0.0, []
    for i, t in enumerate(turns):
        track = (track + t) % 360
        move = math.radians(abs(t)) * km if t else 0.5
        lat += move * math.cos(math.radians(track)) / 111.2
        lon += move * math.sin(math.radians(track)) / (111.2 * math.cos(math.radians(lat)))
        rows.append(("f", T0 + i * step, i + 1, lat, lon, altitude, False, track))
    df = spark.createDataFrame(rows, "flight_id string, sec long, observation_seq int, latitude double, longitude double, altitude_ft double, on_ground boolean, track_deg double")
    return df.withColumn("event_time", F.timestamp_seconds("sec")).withColumn("release_date", F.to_date("event_time"))


def found(spark, df):
    ends = spark.createDataFrame([("f", "LSZH", "ZRH")], "flight_id string, arrival_airport_ident string, arrival_airport_iata string")
    fields = spark.createDataFrame([("LSZH", 47.458056, 8.548056)], "ident string, latitude_deg double, longitude_deg double")
    return holds.to_flight_holds(df, ends, fields).collect()


def test_a_racetrack_is_a_hold(spark):
    (r,) = found(spark, turning(spark, [3 * 5] * 120))
    assert r.hold_seq == 1 and r.circuits >= 1 and r.turn_degrees > 0 and r.duration_seconds >= 240 and r.arrival_airport_iata == "ZRH"
    assert 0 < r.distance_to_arrival_airport_km < 100
    (left,) = found(spark, turning(spark, [-15] * 120))
    assert left.turn_degrees < 0


@pytest.mark.parametrize("turns", [[0] * 120, [0] * 40 + [9] * 10 + [0] * 60, [0] * 40 + [27] * 10 + [0] * 60, [9] * 20 + [-9] * 20 + [9] * 20, [15] * 24], ids=["straight", "90", "270", "s-bend", "one short circle"])
def test_what_is_no_hold(spark, turns):
    assert found(spark, turning(spark, turns)) == []


def test_a_gap_breaks_the_turn_and_limits_hold(spark):
    assert found(spark, turning(spark, [20] * 60, step=61)) == []
    assert found(spark, turning(spark, [15] * 120, km=40.0)) == []
    df = turning(spark, [15] * 120).withColumn("altitude_ft", F.col("observation_seq") * 100.0)
    assert found(spark, df) == []


def test_turns_wrap(spark):
    df = turning(spark, [0, 359, 2, -2])
    got = [r.step_turn_degrees for r in holds.turn_in_window(df).orderBy("observation_seq").collect()]
    assert got[1:] == [-1.0, 2.0, -2.0] and DEFAULTS.max_step_gap_seconds == 60
