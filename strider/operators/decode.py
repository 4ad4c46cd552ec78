"""Raw trace rows to observations, without a shuffle: points are typed, ranked and thinned inside their array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.config import DEFAULTS, Thresholds
from strider.functions.columns import flight_id, over_limit_to_null
from strider.operators.timewin import running, segment_by_gap


def number_at(point: Column, i: int) -> Column:
    return F.get(point, F.lit(i)).try_cast("double")


def typed_point(point: Column, place: Column, epoch: Column) -> Column:
    """A point as a struct whose field order is its rank among receptions of one instant: fuller points first (counted on
    raw values), then by position, then as they came."""
    third = F.get(point, F.lit(3))
    altitude = F.when(third != "ground", third.try_cast("double"))
    callsign = F.trim(F.get_json_object(F.get(point, F.lit(8)), "$.flight"))
    ground_speed, track, climb = number_at(point, 4), number_at(point, 5), number_at(point, 7)
    full = sum((c.isNotNull().cast("int") for c in (ground_speed, track, climb, callsign)), altitude.isNotNull().cast("int"))
    return F.struct(
        F.timestamp_micros(F.round((epoch + number_at(point, 0)) * 1_000_000).cast("long")).alias("event_time"),
        (-full).alias("emptiness"),
        number_at(point, 1).alias("latitude"),
        number_at(point, 2).alias("longitude"),
        place.alias("place"),
        (third == "ground").alias("on_ground"),
        altitude.alias("altitude_ft"),
        ground_speed.alias("ground_speed_kt"),
        track.alias("track_deg"),
        climb.alias("vertical_rate_fpm"),
        callsign.alias("callsign"),
    )


def release_of(path: Column) -> tuple[Column, Column]:
    """Release tag and day from the path of a trace file."""
    tag = F.regexp_extract(path, r"([^/]+)/traces/", 1)
    return tag, F.try_to_date(F.nullif(F.regexp_extract(tag, r"^v(\d{4}\.\d{2}\.\d{2})", 1), F.lit("")), "yyyy.MM.dd")


def decode(aircraft: DataFrame, limits: Thresholds = DEFAULTS, path: Column | None = None) -> DataFrame:
    """One row for each aircraft and instant. The points are sorted once; each is then seen beside its predecessor's time,
    so that no lambda reaches back into the sorted array."""
    tag, day = release_of(F.col("_metadata.file_path") if path is None else path)
    about = (F.col("icao"), F.col("r").alias("registration"), F.col("t").alias("aircraft_type"), F.col("ownOp").alias("operator"))
    points = F.sort_array(F.transform("trace", lambda p, i: typed_point(p, i, F.col("timestamp"))))
    df = aircraft.select(*about, tag.alias("release_tag"), day.alias("release_date"), points.alias("points"))
    names = ("icao", "registration", "aircraft_type", "operator", "release_tag", "release_date")
    times = F.transform("points", lambda x: x["event_time"])
    before = F.concat(F.array(F.lit(None).cast("timestamp")), F.slice(times, 1, F.greatest(F.size("points") - 1, F.lit(0))))
    df = df.select(*names, "points", before.alias("before"))
    kept = F.filter(F.arrays_zip("points", "before"), lambda z: ~z["before"].eqNullSafe(z["points"]["event_time"]))
    p = df.select(*names, F.explode(kept).alias("z")).select(*names, F.col("z.points.*"))
    return clean(p, limits).select(
        "icao", "is_icao_address", "registration", "aircraft_type", "operator", "event_time", "latitude", "longitude", "on_ground", "altitude_ft",
        "ground_speed_kt", "track_deg", "vertical_rate_fpm", "callsign", "release_tag", "release_date",
    )


def clean(points: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Null implausible values and blank callsigns; mark real addresses (a tilde leads the others)."""
    return points.withColumns(
        {
            "is_icao_address": ~F.col("icao").startswith("~"),
            "ground_speed_kt": over_limit_to_null("ground_speed_kt", limits.max_ground_speed_kt),
            "vertical_rate_fpm": over_limit_to_null("vertical_rate_fpm", limits.max_vertical_rate_fpm, absolute=True),
            "callsign": F.nullif(F.col("callsign"), F.lit("")),
        }
    )


OBSERVATION = (
    "flight_id", "icao", "is_icao_address", "registration", "aircraft_type", "operator", "event_time", "observation_seq", "latitude", "longitude",
    "on_ground", "altitude_ft", "ground_speed_kt", "track_deg", "vertical_rate_fpm", "callsign", "release_tag", "release_date",
)


def assign_flights(observations: DataFrame, gap_seconds: int = DEFAULTS.gap_seconds) -> DataFrame:
    """Stamp each observation with its flight and its place in it; one exchange, by aircraft, and one sort, by time.

    A flight's first time and row are carried forward from where it starts: a window of the flight would sort all rows again.
    """
    ties = ("latitude", "longitude")
    w = W.partitionBy("icao").orderBy("event_time", *ties)
    carried = lambda c: F.max(F.when(F.col("__starts"), F.col(c))).over(running("icao", ["event_time", *ties]))
    df = segment_by_gap(observations, "icao", "event_time", gap_seconds, ties=ties)
    df = df.withColumns({"__starts": ~F.col("segment_no").eqNullSafe(F.lag("segment_no").over(w)), "__row": F.row_number().over(w)})
    df = df.withColumns({"flight_id": flight_id(F.col("icao"), carried("event_time")), "observation_seq": F.col("__row") - carried("__row") + 1})
    return df.select(*OBSERVATION)


def to_observations(aircraft: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    return decode(aircraft, limits).transform(assign_flights, limits.gap_seconds)
