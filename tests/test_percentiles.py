import random

from pyspark.sql import functions as F

from strider.operators import holds, phases

N = 60_000
HOLDS = "duration_seconds long, span_km double, circuits double, mean_altitude_ft double, arrival_airport_ident string"


def disc(values, percent):
    values = sorted(v for v in values if v is not None)
    return values[-(-len(values) * percent // 100) - 1]


def test_the_shape_of_many_different_holds_is_exact(spark):
    pick = random.Random(7)
    rows = [(pick.randrange(10**6), pick.randrange(10**6) / 100, pick.randrange(10**5) / 10, None if i % 7 == 0 else float(pick.randrange(10**5)), "A001" if i % 4 == 0 else None) for i in range(N)]
    r = holds.hold_shape(spark.createDataFrame(rows, HOLDS).repartition(16)).first()
    for at, name in enumerate(("duration", "span", "circuits", "altitude")):
        assert r[name] == [disc([x[at] for x in rows], p) for p in (50, 90)], name
    assert r.holds == N and r.with_arrival_pct == 25.0


def test_the_shape_of_no_and_of_unknown_holds(spark):
    r = holds.hold_shape(spark.createDataFrame([], HOLDS)).first()
    assert r.holds == 0 and r.duration == [None, None] and r.with_arrival_pct is None
    r = holds.hold_shape(spark.createDataFrame([(240, 1.5, 1.0, None, "A001"), (None, 1.5, 2.0, None, None)], HOLDS)).first()
    assert r.holds == 2 and r.duration == [240, 240] and r.circuits == [1.0, 2.0] and r.altitude == [None, None] and r.with_arrival_pct == 50.0


def test_the_median_of_many_different_phases_is_exact(spark):
    pick = random.Random(8)
    rows = [(f"f{i // 3}", ("climb", "cruise")[i % 3 > 0], i, pick.randrange(10**7), i % 5) for i in range(N)]
    df = spark.createDataFrame(rows, "flight_id string, phase string, start_time int, duration_seconds long, n_observations long").repartition(16)
    for r in phases.phase_mix(df).collect():
        own = [x for x in rows if x[1] == r.phase]
        assert r.median_seconds == disc([x[3] for x in own], 50)
        assert (r.intervals, r.flights, r.avg_observations) == (len(own), N // 3, round(sum(x[4] for x in own) / len(own), 1))


def test_how_many_phases_flights_fall_into_is_exact(spark):
    df = spark.range(0, 200, 1, 8).select(F.format_string("f%d", "id").alias("flight_id"), F.explode(F.sequence(F.lit(0), F.col("id"))).alias("phase_seq"))
    r = phases.fragmentation(df).first()
    assert (r.p50, r.p90, r.p99, r.most) == (100, 180, 198, 200)
    assert tuple(phases.fragmentation(df.where("false")).first()) == (None,) * 4
