import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strider.operators import explore
from strider.plans import pipeline
from strider.sources import readers, storage
from strider.streaming import landing
from tests.test_decode import point, write


def days(spark, *rows):
    return spark.createDataFrame(rows, "icao string, value long, d string").select("icao", "value", F.to_date("d").alias("release_date"))


def files(path, day):
    return sorted(p.name for p in Path(path, f"release_date={day}").glob("*.parquet"))


def test_a_day_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.write_table(days(spark, ("a", 1, "2025-12-30"), ("b", 2, "2025-12-31"), ("c", 3, "2025-12-31")), path, full_rebuild=True)
    before = files(path, "2025-12-30")
    for _ in range(2):
        storage.write_table(days(spark, ("b", 9, "2025-12-31")), path, day="2025-12-31")
    assert files(path, "2025-12-30") == before and len(files(path, "2025-12-31")) == 1
    assert sorted(r.value for r in spark.read.parquet(path).collect()) == [1, 9]
    assert storage.live_files(spark, path)[0] == 2


def test_guards(spark, tmp_path):
    path = str(tmp_path / "t")
    df = days(spark, ("a", 1, "2025-12-30"))
    for wrong in ({}, {"day": "2025-12-30", "full_rebuild": True}, {"day": "30.12.2025"}, {"day": "2025-12-31"}):
        with pytest.raises(ValueError):
            storage.write_table(df, path, **wrong)
    storage.write_table(df, path, day="2025-12-30")
    with pytest.raises(storage.WrongDay):
        storage.write_table(days(spark, ("a", 7, "2025-12-30"), ("b", 8, "2025-12-31")), path, day="2025-12-30", files_per_day=2)
    storage.write_table(df.limit(0), path, day="2025-12-30")
    assert [r.value for r in spark.read.parquet(path).collect()] == [1] and os.listdir(tmp_path) == ["t"]
    with pytest.raises(ValueError, match="schema"):
        storage.write_table(df.withColumn("more", F.lit(1)), path, day="2025-12-30")
    storage.write_table(df.withColumn("more", F.lit(1)), path, full_rebuild=True)
    assert "more" in spark.read.parquet(path).columns


def test_day_reads_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    storage.write_table(days(spark, ("a", 1, "2025-12-30"), ("b", 2, "2025-12-31")), path, full_rebuild=True)
    df = spark.read.parquet(path).where(F.col("release_date") == storage.day_literal("2025-12-31"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(release_date" in plan and df.count() == 1


def test_single_file_export(spark, tmp_path):
    name, rows, size = storage.export_single_file(days(spark, ("a", 1, "2025-12-30"), ("b", 2, "2025-12-31")).repartition(3), str(tmp_path), "out")
    assert (name, rows) == ("out", 2) and size == os.path.getsize(tmp_path / "out.parquet") and sorted(os.listdir(tmp_path)) in (["out.parquet"], [".out.parquet.crc", "out.parquet"], ["..part.crc", "out.parquet"]) or (tmp_path / "out.parquet").is_file()


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    climb = [point(i * 10, lat=47.458 + i * 0.01, lon=8.548, alt="ground" if i < 3 else i * 100, rate=None if i < 3 else 1500) for i in range(40)]
    write(root, "7c6b1c", climb)
    write(root, "7c6b2d", [point(i * 10, lat=10 + i * 0.01, lon=10) for i in range(5)])
    return root


@pytest.fixture
def fields(spark):
    return spark.createDataFrame([("LSZH", "ZRH", "Zurich", "large_airport", "CH", 47.458056, 8.548056, 1417.0)], readers.schemas.AIRPORTS)


def test_a_day_end_to_end(spark, tmp_path, raw, fields):
    own = pipeline.scope.Scope(airports=("LSZH",))
    root = str(tmp_path / "tables")
    for _ in range(2):
        said = pipeline.process_day(spark, readers.read_aircraft(spark, str(raw)), fields, root, "2025-12-30", own)
        assert (said.aircraft, said.points, said.candidates) == (1, 40, 40)
    assert pipeline.cross_checks(spark, root).where("failures > 0").count() == 0
    f = readers.read_table(spark, root, "flights", ["2025-12-30"]).collect()
    assert [(r.icao, r.departure_airport_ident, r.arrival_airport_ident) for r in f] == [("7c6b1c", "LSZH", None)]
    phases = readers.read_table(spark, root, "flight_phases").orderBy("phase_seq").collect()
    assert [r.phase for r in phases] == ["taxi_out", "climb"]
    assert readers.read_table(spark, root, "airport_daily_operations").first().departures == 1
    o = readers.read_table(spark, root, "observations")
    assert readers.load_trajectory(o, f[0].flight_id, "2025-12-30").count() == 40
    assert readers.load_trajectories(o, [], None).count() == 0
    assert storage.vacuum(spark, root)[0][0] == "observations"


def test_without_scope_everything_is_kept(spark, tmp_path, raw, fields):
    said = pipeline.process_day(spark, readers.read_aircraft(spark, str(raw)), fields, str(tmp_path / "t"), "2025-12-30", full_rebuild=True)
    assert said.aircraft == 2 and said.candidates == 45


def test_stream_lands_what_batch_decodes(spark, tmp_path, raw):
    q = landing.land(landing.decoded_stream(spark, str(raw)), str(tmp_path / "landed"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "landed")).count() == 45


def test_dates():
    from datetime import date, datetime

    assert readers.as_dates(["2025-12-31", date(2025, 12, 30), datetime(2025, 12, 30, 5), None, float("nan")]) == [date(2025, 12, 30), date(2025, 12, 31)]


def test_table_diff(spark):
    a = spark.createDataFrame([(1, 1.00001, "x"), (2, 2.0, None), (3, 3.0, "z")], "k long, v double, s string")
    b = spark.createDataFrame([(1, 1.00002, "x"), (2, 2.5, None), (4, 3.0, "z")], "k long, v double, s string")
    got = {r.k: (r.side, r.columns) for r in explore.table_diff(a, b, ["k"]).collect()}
    assert got == {2: ("both", ["v"]), 3: ("left", None), 4: ("right", None)}
