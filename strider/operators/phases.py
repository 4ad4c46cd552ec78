"""Operational phases: each observation's label from smoothed climb and ground state, and the runs of equal labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.config import DEFAULTS, Thresholds
from strider.functions.columns import seconds
from strider.operators.percentiles import percentile, ranked
from strider.operators.timewin import around, number_runs


def label_observations(observations: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Add event_epoch, the smoothed climb, the airborne stretch's ends and the phase."""
    flight = W.partitionBy("flight_id")
    airborne = F.when(~F.col("on_ground"), F.col("observation_seq"))
    names = ("flight_id", "event_time", "observation_seq", "release_date", "altitude_ft", "on_ground", "ground_speed_kt", "vertical_rate_fpm")
    df = observations.select(*names, seconds("event_time").alias("event_epoch")).withColumns(
        {
            "smoothed_vertical_rate_fpm": F.avg("vertical_rate_fpm").over(around("flight_id", "event_epoch", limits.smoothing_seconds // 2)),
            "first_airborne_seq": F.min(airborne).over(flight),
            "last_airborne_seq": F.max(airborne).over(flight),
        }
    )
    ground, climb, seq = F.col("on_ground"), F.col("smoothed_vertical_rate_fpm"), F.col("observation_seq")
    on_ground = F.when(seq < F.col("first_airborne_seq"), "taxi_out").when(seq > F.col("last_airborne_seq"), "taxi_in").otherwise("taxi")
    aloft = F.when(climb.isNull(), "unknown").when(climb > limits.level_band_fpm, "climb").when(climb < -limits.level_band_fpm, "descent").otherwise("cruise")
    return df.withColumn("phase", F.when(ground.isNull(), "unknown").when(ground, on_ground).otherwise(aloft))


def to_flight_phases(observations: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """One row for each run of one phase."""
    runs = number_runs(label_observations(observations, limits), "flight_id", "observation_seq", "phase")
    t = F.col("event_time")
    df = runs.groupBy("flight_id", "run_no").agg(
        F.max("phase").alias("phase"), F.min(t).alias("start_time"), F.max(t).alias("end_time"), (seconds(F.max(t)) - seconds(F.min(t))).alias("duration_seconds"),
        F.count(F.lit(1)).alias("n_observations"), F.min_by("altitude_ft", t).alias("start_altitude_ft"), F.max_by("altitude_ft", t).alias("end_altitude_ft"),
        F.min("altitude_ft").alias("min_altitude_ft"), F.max("altitude_ft").alias("max_altitude_ft"), F.round(F.avg("ground_speed_kt"), 1).alias("avg_ground_speed_kt"),
        F.round(F.avg("smoothed_vertical_rate_fpm"), 1).alias("avg_vertical_rate_fpm"), F.max("release_date").alias("release_date"),
    )
    seq = F.row_number().over(W.partitionBy("flight_id").orderBy("start_time", "run_no"))
    return df.select("flight_id", seq.alias("phase_seq"), *[c for c in df.columns if c not in ("flight_id", "run_no")])


def phase_mix(phases: DataFrame) -> DataFrame:
    """Phases in numbers; a flight counts at its first interval of a phase, so that counts by duration add up to all of it."""
    first = F.row_number().over(W.partitionBy("flight_id", "phase").orderBy("start_time")) == 1
    counted = phases.withColumn("__first", first).groupBy("phase", "duration_seconds").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__first") & F.col("flight_id").isNotNull()).alias("flights"),
        F.sum("n_observations").alias("observations"), F.count("n_observations").alias("counts"),
    )
    return ranked(counted, "phase", "duration_seconds").groupBy("phase").agg(
        F.sum("n").alias("intervals"), F.sum("flights").alias("flights"), percentile("duration_seconds", 50).alias("median_seconds"),
        F.round(F.sum("observations") / F.nullif(F.sum("counts"), F.lit(0)), 1).alias("avg_observations"),
    )


def fragmentation(phases: DataFrame) -> DataFrame:
    """How many phases flights fall into."""
    sizes = phases.groupBy("flight_id").agg(F.count(F.lit(1)).alias("phases"))
    df = ranked(sizes.groupBy("phases").agg(F.count(F.lit(1)).alias("n")), F.lit(0), "phases")
    return df.agg(*[percentile("phases", p).alias(f"p{p}") for p in (50, 90, 99)], F.max("phases").alias("most"))
