"""The daily build: raw traces of one release to the six published tables, validated as they are written."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.config import DEFAULTS, Thresholds
from strider.operators import decode, flights, holds, movements, phases, quality, scope
from strider.sources import readers, storage


@dataclass
class Volumes:
    """What a day's build saw and wrote."""

    aircraft: int = 0
    points: int = 0
    candidates: int = 0
    tables: dict = field(default_factory=dict)
    seconds: dict = field(default_factory=dict)


def build_tables(candidates: DataFrame, airports: DataFrame, own: scope.Scope | None, limits: Thresholds = DEFAULTS) -> dict[str, DataFrame]:
    """The published tables from segmented observations; without a scope, of everything."""
    base = flights.aggregate_flights(candidates)
    moved = movements.airport_movements(base, airports, limits)
    observations, reported = candidates, moved
    if own is not None:
        ids = scope.scope_flight_ids(moved, own)
        observations, base = scope.restrict_to_flights(candidates, ids), scope.restrict_to_flights(base, ids)
        moved = scope.restrict_to_flights(moved, ids)
        reported = scope.at_study_airports(moved, own)
    pivot = flights.movement_pivot(moved)
    held = holds.to_flight_holds(observations, pivot, airports, limits)
    return {
        "observations": observations,
        "movements": reported,
        "flight_phases": phases.to_flight_phases(observations, limits),
        "flight_holds": held,
        "flights": flights.to_flights(base, pivot, held),
        "airport_daily_operations": movements.to_airport_operations(reported, held),
    }


def process_day(spark: SparkSession, raw: DataFrame, airports: DataFrame, root: str, day: str, own: scope.Scope | None = None, full_rebuild: bool = False, limits: Thresholds = DEFAULTS) -> Volumes:
    """Decode, segment and publish one day. The raw rows are read once: what comes near is landed as Parquet beside the
    tables first (re-runs with other thresholds need no JSON), and what was seen is counted in that pass."""
    said = Volumes()

    def timed(name: str, f):
        began = time.monotonic()
        out = f()
        said.seconds[name] = time.monotonic() - began
        return out

    near = raw if own is None else scope.near_scope(raw, scope.airport_boxes(airports, own))
    landed = f"{root}/_landed/{day}"
    decoded = near.select("*", F.col("_metadata.file_path").alias("path")) if "path" not in near.columns else near
    timed("land", lambda: decoded.write.mode("overwrite").parquet(landed))
    there = spark.read.parquet(landed)
    counts = there.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.size("trace"), F.lit(0)))).first()
    said.aircraft, said.points = counts[0], int(counts[1] or 0)
    candidates = decode.assign_flights(decode.decode(there, limits, F.col("path")), limits.gap_seconds).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        how = {"full_rebuild": True} if full_rebuild else {"day": day}
        for name, df in build_tables(candidates, airports, own, limits).items():
            timed(name, lambda name=name, df=df: storage.publish(name, df, root, **how))
            said.tables[name] = quality.require(quality.of_table(name, readers.read_table(spark, root, name, [day])))
        said.candidates = candidates.count()
    finally:
        candidates.unpersist()
    return said


def cross_checks(spark: SparkSession, root: str) -> DataFrame:
    """Findings between the published tables."""
    return quality.between_tables({name: readers.read_table(spark, root, name) for name in ("observations", "flights", "movements", "flight_phases", "flight_holds")})


def run(spark: SparkSession, raw_root: str, airports: DataFrame, root: str, own: scope.Scope) -> dict[str, Volumes]:
    """All days of a scope; only the first may replace the tables whole."""
    out = {}
    for i, (tag, day) in enumerate(own.releases):
        out[day] = process_day(spark, readers.read_aircraft(spark, f"{raw_root}/{tag}"), airports, root, day, own, full_rebuild=i == 0)
    quality.require(cross_checks(spark, root))
    storage.vacuum(spark, root)
    return out
