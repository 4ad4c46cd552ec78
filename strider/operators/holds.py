"""Holds: stretches of sustained circling, kept where they are long, confined and level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.config import DEFAULTS, HOLD_KM_PER_DEGREE, Thresholds
from strider.functions.columns import haversine_km, seconds, signed_turn
from strider.operators.percentiles import percentile, ranked
from strider.operators.timewin import around, number_runs


def turn_in_window(observations: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Airborne observations with the signed turn within the window around each; turns across long steps do not count."""
    w = W.partitionBy("flight_id").orderBy("observation_seq")
    names = ("flight_id", "event_time", "observation_seq", "release_date", "latitude", "longitude", "altitude_ft", "track_deg")
    df = observations.where(~F.col("on_ground") & F.col("track_deg").isNotNull()).select(*names, seconds("event_time").alias("event_epoch"))
    df = df.withColumns(
        {"step_seconds": F.col("event_epoch") - F.lag("event_epoch").over(w), "step_turn_degrees": signed_turn(F.col("track_deg"), F.lag("track_deg").over(w))}
    )
    df = df.withColumn("counted_turn", F.when(F.col("step_seconds").between(1, limits.max_step_gap_seconds), F.col("step_turn_degrees")).otherwise(0.0))
    return df.withColumn("turn_in_window_degrees", F.sum("counted_turn").over(around("flight_id", "event_epoch", limits.turn_window_seconds // 2)))


def detect_hold_candidates(observations: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Runs of observations whose window turns through a full circle or more."""
    turn = F.col("turn_in_window_degrees")
    df = turn_in_window(observations, limits).withColumn("circling", (F.abs(turn) >= limits.min_turn_degrees).cast("int"))
    df = number_runs(df, "flight_id", "observation_seq", "circling").where("circling = 1")
    t, lat, lon = F.col("event_time"), F.col("latitude"), F.col("longitude")
    north = (F.max(lat) - F.min(lat)) * HOLD_KM_PER_DEGREE
    east = (F.max(lon) - F.min(lon)) * HOLD_KM_PER_DEGREE * F.cos(F.radians(F.avg(lat)))
    return df.groupBy("flight_id", "run_no").agg(
        F.min(t).alias("hold_start"), F.max(t).alias("hold_end"), (seconds(F.max(t)) - seconds(F.min(t))).alias("duration_seconds"), F.count(F.lit(1)).alias("n_observations"),
        F.round(F.avg(lat), 5).alias("centroid_latitude"), F.round(F.avg(lon), 5).alias("centroid_longitude"), F.round(F.sqrt(north * north + east * east), 2).alias("span_km"),
        F.min("altitude_ft").alias("min_altitude_ft"), F.max("altitude_ft").alias("max_altitude_ft"), F.round(F.avg("altitude_ft")).alias("mean_altitude_ft"),
        F.round(F.max_by(turn, F.struct(F.abs(turn), turn)), 1).alias("turn_degrees"), F.round(F.max(F.abs(turn)) / 360.0, 1).alias("circuits"),
        F.max("step_seconds").alias("max_sample_gap_seconds"), F.max("release_date").alias("release_date"),
    ).drop("run_no")


HOLD = (
    "flight_id", "hold_seq", "hold_start", "hold_end", "duration_seconds", "n_observations", "centroid_latitude", "centroid_longitude", "span_km", "min_altitude_ft", "max_altitude_ft",
    "mean_altitude_ft", "turn_degrees", "circuits", "max_sample_gap_seconds", "arrival_airport_ident", "arrival_airport_iata", "distance_to_arrival_airport_km", "release_date",
)


def to_flight_holds(observations: DataFrame, flights: DataFrame, airports: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Holds with the airport their flight arrived at. flights: flight_id, arrival_airport_ident, arrival_airport_iata."""
    level = F.col("max_altitude_ft") - F.col("min_altitude_ft") <= limits.max_altitude_range_ft
    found = detect_hold_candidates(observations, limits).where((F.col("duration_seconds") >= limits.min_hold_seconds) & (F.col("span_km") <= limits.max_span_km) & level)
    ends = flights.select("flight_id", "arrival_airport_ident", "arrival_airport_iata")
    fields = airports.select(F.col("ident").alias("arrival_airport_ident"), "latitude_deg", "longitude_deg")
    df = found.join(ends, "flight_id", "left").join(fields, "arrival_airport_ident", "left")
    km = haversine_km(F.col("centroid_latitude"), F.col("centroid_longitude"), F.col("latitude_deg"), F.col("longitude_deg"))
    seq = F.row_number().over(W.partitionBy("flight_id").orderBy("hold_start"))
    return df.withColumns({"hold_seq": seq, "distance_to_arrival_airport_km": F.round(km, 1)}).select(*HOLD)


SHAPE = {"duration": "duration_seconds", "span": "span_km", "circuits": "circuits", "altitude": "mean_altitude_ft"}


def hold_shape(holds: DataFrame) -> DataFrame:
    """Percentiles of what holds look like: each hold gives its four values, and each value once is counted and ranked."""
    shape = F.array(*[F.struct(F.lit(k).alias("name"), *[(F.col(c) if c == own else F.lit(None).cast(holds.schema[c].dataType)).alias(c) for c in SHAPE.values()]) for k, own in SHAPE.items()])
    values = holds.select("arrival_airport_ident", F.explode(shape).alias("v")).select("arrival_airport_ident", "v.*")
    counted = values.groupBy("name", *SHAPE.values()).agg(F.count(F.lit(1)).alias("n"), F.count("arrival_airport_ident").alias("arrived"))
    df = ranked(counted, "name", F.coalesce(*[F.col(c).cast("double") for c in SHAPE.values()]))
    of = lambda k, c: F.when(F.col("name") == k, F.col(c))
    whole = lambda c: F.coalesce(F.sum(of("duration", c)), F.lit(0).cast("long"))
    q = lambda k, c: F.array(*[percentile(of(k, c), p) for p in (50, 90)]).alias(k)
    pct = F.round(100.0 * whole("arrived") / F.nullif(whole("n"), F.lit(0)), 1)
    return df.agg(whole("n").alias("holds"), *[q(k, c) for k, c in SHAPE.items()], pct.alias("with_arrival_pct"))


def hold_distance_buckets(holds: DataFrame) -> DataFrame:
    d = F.col("distance_to_arrival_airport_km")
    where = F.when(d.isNull(), "airport unknown").when(d < 50, "terminal area (<50 km)").when(d < 150, "near (50-150 km)").otherwise("en route (>150 km)")
    return holds.groupBy(where.alias("where_held")).agg(F.count(F.lit(1)).alias("holds"))
