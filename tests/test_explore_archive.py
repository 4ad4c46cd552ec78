import io
import tarfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strider.operators import explore, legacy, timewin
from strider.sources import archive, readers


@pytest.fixture(scope="module")
def board(spark):
    rows = [
        ("f1", "SWR123", "4b1", "2025-12-24", "LSZH", "EDDL", "ZRH", "DUS", "SWR", "A320", 5040), ("f2", "DLH4K", "3c1", "2025-12-24", "EDDL", "LSZH", "DUS", "ZRH", "DLH", "A20N", 185),
        ("f3", None, "4b9.*", "2025-12-25", None, None, None, None, None, None, 9), ("f4", "SWR9", "4b2", "2025-12-25", "LSZH", "LFPG", "ZRH", "CDG", "SWR", "A320", None),
    ]
    spec = "flight_id string, callsign string, icao string, flight_date string, departure_airport_ident string, arrival_airport_ident string, departure_airport_iata string, arrival_airport_iata string, airline_icao string, aircraft_type string, duration_seconds long"
    df = spark.createDataFrame(rows, spec)
    at = F.timestamp_seconds(F.lit(1766534400) + F.monotonically_increasing_id() % 7 * 3600)
    return df.withColumns({"flight_date": F.to_date("flight_date"), "first_seen_time": at, "departure_time": F.when(F.col("departure_airport_iata").isNotNull(), F.lit("2025-12-24 07:15:00").cast("timestamp")), "arrival_time": F.lit(None).cast("timestamp"), "n_detected_holds": F.lit(0)})


@pytest.mark.parametrize("choice,want", [({}, "f1 f2 f3 f4"), ({"departure": "LSZH"}, "f1 f4"), ({"departure": "LSZH", "arrival": "EDDL"}, "f1"), ({"airline": "SWR", "date": "2025-12-25"}, "f4"), ({"callsign": " swr "}, "f1 f4"), ({"callsign": "9.*"}, "f3"), ({"callsign": "4B"}, "f1 f3 f4"), ({"aircraft_type": "B738"}, "")])
def test_filters(board, choice, want):
    assert sorted(r.flight_id for r in explore.select_flights(board, **choice).collect()) == want.split()


def test_options_and_display(board):
    assert [r.value for r in explore.airport_options(board, "arrival_airport_ident").collect()] == ["LSZH", "EDDL", "LFPG"]
    t = {r.flight_id: r for r in explore.flight_table(board).collect()}
    assert t["f1"].Duration == "1h 24m" and t["f2"].Duration == "3m 05s" and t["f3"].Duration == "9s" and t["f4"].Duration == "—"
    assert t["f3"].Callsign == "4b9.*" and t["f3"].From == "—" and t["f1"].Dep == "07:15" and t["f1"].Arr == "—" and t["f1"].Date == "Wed 24 Dec"
    assert board.where("flight_id = 'f3'").select(explore.flight_label().alias("l")).first().l == "4b9.*  ·  ??? → ???"
    assert board.select(explore.airport_label("departure_airport_ident").alias("l")).first().l == "LSZH · ZRH"


def test_hours_and_distribution(board):
    hours = explore.hourly_traffic(board, "ZRH").collect()
    assert len(hours) == 24 and hours[7].departures == 2 and sum(r.arrivals for r in hours) == 0
    got = [(r.value, r.flights) for r in explore.distribution(board, "airline_icao", 1).collect()]
    assert got == [("SWR", 2), ("Other (1)", 1)]
    assert explore.distribution(board, "airline_icao", 8).count() == 2 and explore.airport_flights(board, "ZRH").count() == 3


def test_phase_lookup_and_holds(spark):
    t = lambda c: F.timestamp_seconds(c)
    points = spark.createDataFrame([("f", s) for s in (0, 10, 15, 20, 25, 99)] + [("g", 10)], "flight_id string, s long").withColumn("event_time", t("s"))
    phases = spark.createDataFrame([("f", 10, 15, "climb"), ("f", 20, 30, "cruise")], "flight_id string, a long, b long, phase string").select("flight_id", t("a").alias("start_time"), t("b").alias("end_time"), "phase")
    got = {(r.flight_id, r.s): r.phase for r in explore.label_points_with_phase(points, phases).collect()}
    assert got == {("f", 0): "unknown", ("f", 10): "climb", ("f", 15): "climb", ("f", 20): "cruise", ("f", 25): "cruise", ("f", 99): "unknown", ("g", 10): "unknown"}
    holds = phases.select("flight_id", F.col("start_time").alias("hold_start"), F.col("end_time").alias("hold_end"))
    inside = explore.points_in_holds(points, holds.unionByName(holds))
    assert sorted(r.s for r in inside.collect()) == [10, 15, 20, 25]


def test_legacy(spark, tmp_path):
    rows = ["time,icao24,lat,lon,velocity,heading,vertrate,callsign,on_ground,alert,spi,squawk,baroaltitude,geoaltitude,lastposupdate,lastcontact"]
    rows += [f"{1000 + i * 10},abc,{47.4 + i * 0.001},{8.5},100,0,{20 if i else 0},swr1 ,False,,,,{1000 + i * 10},,," for i in range(5)]
    rows += ["1000,abc,47,8,100,0,0,12A,False,,,,1000,,,", "1000,abc,,8,100,0,0,SWR2,False,,,,1000,,,"]
    (tmp_path / "s.csv").write_text("\n".join(rows))
    df = legacy.to_states(legacy.read_states(spark, str(tmp_path / "s.csv")))
    assert df.count() == 5 and df.first().airline == "SWR" and abs(df.agg(F.max("groundspeed")).first()[0] - 194.384) < 1e-6
    phases = legacy.detect_phases(df)
    assert {r.phase for r in phases.collect()} == {"LEVEL_OFF", "CLIMB"}
    assert legacy.load_data(spark, str(tmp_path / "missing")).count() == 0
    assert legacy.classify_direction(df, (47.39, 8.0, 47.402, 9.0)).first().direction == "DEPARTURE"


def test_airport_reduction(spark):
    cols = "ident iata_code name type iso_country latitude_deg longitude_deg elevation_ft extra".split()
    rows = [("A", "", "n", "large_airport", "CH", "1", "2", "", "x"), ("B", "", "n", "heliport", "CH", "1", "2", "", "x"), ("C", "", "n", "medium_airport", "CH", "", "2", "", "x")]
    got = readers.filter_airports(spark.createDataFrame(rows, cols))
    assert [r.ident for r in got.collect()] == ["A"] and len(got.columns) == 8


def tar(*members, kind=tarfile.PAX_FORMAT):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=kind) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def test_archive(tmp_path):
    long = "./traces/3e/" + "deep/" * 25 + "trace_full_c.json"
    data = tar(("./heatmap/x", b"h" * 700), ("./README.txt", b"r"), ("./traces/1c/trace_full_a.json", b"A" * 600), ("./traces/../../evil.json", b"e"), (long, b"C"), ("./traces/2d/trace_full_b.json", b"B" * 5000))
    found = list(archive.members(archive.in_memory(data)))
    assert [m.name for m in found][1:4:2] == ["./README.txt", "./traces/../../evil.json"] and long in [m.name for m in found]
    assert [m.name for m in archive.members(archive.in_memory(tar((long, b"C"), kind=tarfile.GNU_FORMAT)))] == [long]
    assert all(len(data[m.start : m.start + m.size]) == m.size and m.regular for m in found)
    tag = "v2025.12.30-planes-readsb-prod-0"
    release, read = archive.Release(tag, (("u", len(data)), ("v", 1000))), archive.in_memory(data)
    at = release.traces_at(read)
    assert data[at:].startswith(b"./traces/1c") and release.size == len(data) + 1000
    cut = found[-1].start + 1500  # inside the last member
    assert [p.name for p in archive.unpack(data[at:cut], tmp_path / "t")] == ["trace_full_a.json.gz", "trace_full_c.json.gz"]
    assert (tmp_path / "t/1c/trace_full_a.json.gz").read_bytes() == b"A" * 600 and not [*tmp_path.parent.glob("evil*")]
    assert archive.unpack(data[at : at + 100], tmp_path / "t") == [] == archive.unpack(b"x" * 2000, tmp_path / "t")
    with pytest.raises(ValueError):
        release.traces_at(archive.in_memory(tar(("./README.txt", b"r"))))
    sizes = {archive.asset_url("t", s): n for s, n in ((".tar.aa", 5), (".tar.ab", 3))}
    assert [n for _, n in archive.Release.find("t", sizes.get).parts] == [5, 3]
    assert [n for _, n in archive.Release.find("t", {archive.asset_url("t", ".tar"): 9}.get).parts] == [9]
    with pytest.raises(ValueError):
        archive.Release.find("t", {}.get)
    with pytest.raises(ValueError):
        archive.sample(release, tmp_path / "d", share=1.5, read=read)
    said = archive.sample(release, tmp_path / "d", share=0.5, read=read)
    assert said["release_date"] == "2025-12-30" and (tmp_path / "d" / tag / "manifest.json").exists() and said["trace_files"] >= 1
    put = []
    keys = archive.upload_raw(lambda p, k: put.append(k), tmp_path / "d", "raw", tag)
    assert sorted(put) == sorted(keys) and f"raw/{tag}/manifest.json" in keys


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(times=st.lists(st.integers(0, 5000), min_size=1, max_size=40, unique=True), gap=st.integers(1, 900))
def test_segments_partition_and_split_only_at_gaps(spark, times, gap):
    df = spark.createDataFrame([("a", t) for t in times], "k string, s long").withColumn("t", F.timestamp_seconds("s"))
    rows = timewin.segment_by_gap(df, "k", "t", gap).orderBy("s").collect()
    want, n, before = [], 0, None
    for t in sorted(times):
        n += before is None or t - before > gap
        want.append(n)
        before = t
    assert [r.segment_no for r in rows] == want
