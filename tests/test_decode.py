import gzip
import json

import pytest
from pyspark.sql import functions as F

from strider.config import DEFAULTS
from strider.operators import decode
from strider.sources import readers

AT = 1767052800.0  # 2025-12-30T00:00:00Z
TAG = "v2025.12.30-planes-readsb-prod-0"


def point(offset, lat=47.0, lon=8.0, alt=1000, gs=100, track=90, rate=0, callsign="SWR1  "):
    return [offset, lat, lon, alt, gs, track, 0, rate, {"type": "adsb_icao", "flight": callsign} if callsign is not None else None, "adsb", None, None, None, None]


def write(root, icao, trace, **more):
    path = root / TAG / "traces" / icao[-2:] / f"trace_full_{icao}.json.gz"
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        json.dump({"icao": icao, "r": "VH-VFY", "t": "A320", "ownOp": "X", "timestamp": AT, "trace": trace} | more, f)
    (root / TAG / "manifest.json").write_text("{}")


@pytest.fixture
def decoded(spark, tmp_path):
    def go(*traces):
        for i, t in enumerate(traces):
            write(tmp_path, f"7c6b{i:02d}", t)
        return decode.decode(readers.read_aircraft(spark, str(tmp_path)))

    return go


def test_reads_files_and_path(decoded):
    rows = decoded([point(0), point(10.19)]).orderBy("event_time").collect()
    assert [r.callsign for r in rows] == ["SWR1", "SWR1"]
    assert rows[0].release_tag == TAG and str(rows[0].release_date) == "2025-12-30"
    assert rows[1].event_time.microsecond == 190000 and rows[0].is_icao_address


def test_fuller_point_wins_and_ranks_on_raw_values(decoded):
    rows = decoded([point(5, lat=1.0, alt=None, callsign=None), point(5, lat=9.0)]).collect()
    assert [r.latitude for r in rows] == [9.0]
    # 1800 kt is implausible and is nulled, but it counted when the points were ranked
    rows = decoded([point(5, lat=2.0, gs=1800), point(5, lat=1.0, gs=None)]).collect()
    assert [(r.latitude, r.ground_speed_kt) for r in rows] == [(2.0, None)]


def test_ties_go_by_position_then_order(decoded):
    assert decoded([point(5, lat=3.0), point(5, lat=2.0), point(5, lat=4.0)]).first().latitude == 2.0
    rows = decoded([point(5, track=1), point(5, track=2), point(5.5)]).orderBy("event_time").collect()
    assert len(rows) == 2 and rows[0].track_deg == 1


def test_ground_short_and_blank_values(decoded):
    rows = decoded([point(0, alt="ground", callsign="   "), [1, 47.0, 8.0], point(2, alt=None, rate=-30000)]).orderBy("event_time").collect()
    assert rows[0].on_ground is True and rows[0].altitude_ft is None and rows[0].callsign is None
    assert rows[1].on_ground is None and rows[1].ground_speed_kt is None
    assert rows[2].on_ground is None and rows[2].vertical_rate_fpm is None


def test_empty_trace_gives_nothing_and_no_shuffle(decoded):
    df = decoded([])
    assert df.count() == 0
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def obs(spark, times, icao="a"):
    rows = [(icao, float(t), 1.0, 2.0) for t in times]
    names = ("is_icao_address", "registration", "aircraft_type", "operator", "on_ground", "altitude_ft", "ground_speed_kt", "track_deg", "vertical_rate_fpm", "callsign", "release_tag", "release_date")
    df = spark.createDataFrame(rows, "icao string, s double, latitude double, longitude double")
    return df.select("*", F.timestamp_micros((F.lit(AT) * 1e6 + F.col("s") * 1e6).cast("long")).alias("event_time"), *[F.lit(None).cast("string").alias(n) for n in names])


def test_gap_of_exactly_the_threshold_stays_together(spark):
    df = decode.assign_flights(obs(spark, [0, 900, 1801]))
    got = {r.flight_id: r.n for r in df.groupBy("flight_id").agg(F.count("*").alias("n")).collect()}
    assert got == {"a_20251230000000": 2, "a_20251230003001": 1}
    # gaps are whole seconds: 900.4 s is 900
    assert decode.assign_flights(obs(spark, [0, 900.4])).select("flight_id").distinct().count() == 1
    assert DEFAULTS.gap_seconds == 900


def test_segmentation_does_not_depend_on_order(spark):
    a = decode.assign_flights(obs(spark, [5, 1, 4000, 3])).orderBy("flight_id", "observation_seq").collect()
    b = decode.assign_flights(obs(spark, [4000, 3, 5, 1])).orderBy("flight_id", "observation_seq").collect()
    assert a == b and [r.observation_seq for r in a] == [1, 2, 3, 1]
