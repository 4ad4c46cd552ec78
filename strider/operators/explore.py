"""Explorer and report queries over the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.config import TRACK_DATA_SOURCE, DEFAULTS
from strider.functions.columns import clock_text, duration_text, text_or
from strider.operators.timewin import asof_interval, thin_by_bucket, within_intervals

STUDY_AIRPORTS = {"LSZH": "ZRH", "EDDL": "DUS"}


def select_flights(flights: DataFrame, date=None, departure=None, arrival=None, airline=None, aircraft_type=None, callsign: str = "") -> DataFrame:
    """The flights that meet every choice; None means any. callsign finds part of a callsign or address, in any case."""
    wanted = {"departure_airport_ident": departure, "arrival_airport_ident": arrival, "airline_icao": airline, "aircraft_type": aircraft_type}
    for column, value in wanted.items():
        if value:
            flights = flights.where(F.col(column) == value)
    if date is not None:
        flights = flights.where(F.to_date("flight_date") == F.lit(str(date)).cast("date"))
    if text := (callsign or "").strip().upper():
        has = lambda c: F.upper(F.coalesce(c, F.lit(""))).contains(text)
        flights = flights.where(has("callsign") | has("icao"))
    return flights


def options_for(flights: DataFrame, column: str, leading=()) -> DataFrame:
    """A filter's values: distinct, known, sorted, the leading ones first."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in leading]), F.col("value")) if leading else F.lit(0), F.lit(0))
    values = flights.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    return values.withColumn("rank", F.when(rank == 0, len(leading) + 1).otherwise(rank).cast("int")).orderBy("rank", "value")


def airport_options(flights: DataFrame, column: str) -> DataFrame:
    return options_for(flights, column, tuple(STUDY_AIRPORTS))


def airport_label(ident):
    """LSZH · ZRH for the airports known by both codes."""
    out = F.col(ident)
    for icao, iata in STUDY_AIRPORTS.items():
        out = F.when(F.col(ident) == icao, f"{icao} · {iata}").otherwise(out)
    return out


def flight_table(flights: DataFrame) -> DataFrame:
    """The board of flights as it is shown, in order of first sight."""
    shown = flights.orderBy("first_seen_time")
    return shown.select(
        "flight_id", text_or("callsign", F.col("icao")).alias("Callsign"), F.date_format("flight_date", "EEE dd MMM").alias("Date"),
        text_or("departure_airport_iata").alias("From"), text_or("arrival_airport_iata").alias("To"), text_or("airline_icao").alias("Airline"),
        text_or("aircraft_type").alias("Aircraft"), clock_text("departure_time").alias("Dep"), clock_text("arrival_time").alias("Arr"),
        duration_text("duration_seconds").alias("Duration"), F.col("n_detected_holds").alias("Holds"),
    )


def flight_label():
    """Callsign and route, as legends show them."""
    return F.concat(text_or("callsign", F.col("icao")), F.lit("  ·  "), text_or("departure_airport_iata", "???"), F.lit(" → "), text_or("arrival_airport_iata", "???"))


def label_points_with_phase(points: DataFrame, phases: DataFrame) -> DataFrame:
    return asof_interval(points, phases, "flight_id")


def points_in_holds(points: DataFrame, holds: DataFrame) -> DataFrame:
    return within_intervals(points, holds, "flight_id", "event_time", "hold_start", "hold_end")


def hourly_traffic(flights: DataFrame, iata: str) -> DataFrame:
    """Departures and arrivals at one airport by hour of day; every hour has a row."""
    ends = [flights.where(F.col(f"{end}_airport_iata") == iata).select(F.lit(end).alias("end"), F.hour(f"{end}_time").alias("hour")) for end in ("departure", "arrival")]
    counts = ends[0].unionByName(ends[1]).where("hour IS NOT NULL").groupBy("hour").agg(F.count_if(F.col("end") == "departure").alias("departures"), F.count_if(F.col("end") == "arrival").alias("arrivals"))
    hours = flights.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return hours.join(F.broadcast(counts), "hour", "left").fillna(0, ["departures", "arrivals"]).orderBy("hour")


def distribution(flights: DataFrame, column: str, top: int = 8) -> DataFrame:
    """The `top` commonest values, and one row that stands for the rest, so that the total stays."""
    counts = flights.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("flights"))
    # The head is a bounded top-k; everything else folds by aggregation, never through one task.
    head = counts.orderBy(F.desc("flights"), "value").limit(top)
    rest = counts.join(F.broadcast(head.select("value")), "value", "left_anti").agg(F.count(F.lit(1)).alias("k"), F.sum("flights").alias("flights")).where("k > 0")
    return head.unionByName(rest.select(F.concat(F.lit("Other ("), F.col("k").cast("string"), F.lit(")")).alias("value"), "flights"))


def airport_flights(flights: DataFrame, iata: str) -> DataFrame:
    return flights.where((F.col("departure_airport_iata") == iata) | (F.col("arrival_airport_iata") == iata))


def explorer_kpis(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.count(F.lit(1)).alias("flights"), F.count_distinct("icao").alias("aircraft"), F.count_distinct("airline_icao").alias("airlines"),
        F.count_distinct("aircraft_type").alias("aircraft_types"), F.count_if(F.col("has_detected_hold")).alias("with_holds"),
    )


def airport_kpis(operations: DataFrame, ident: str) -> DataFrame:
    """Sums over an airport's days; the mean hold is the mean of daily means."""
    return operations.where(F.col("airport_ident") == ident).agg(
        F.sum("total_operations").alias("operations"), F.sum("arrivals").alias("arrivals"), F.sum("departures").alias("departures"), F.sum("flights_with_detected_holds").alias("holding_flights"),
        F.round(F.try_divide(F.sum("flights_with_detected_holds"), F.sum("arrivals")), 6).alias("hold_share"), F.round(F.avg("avg_hold_duration_seconds"), 6).alias("mean_hold_seconds"),
    )


def map_frame(points: DataFrame) -> DataFrame:
    """The extent and centre of what is drawn."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return points.agg(F.min(lat).alias("south"), F.max(lat).alias("north"), F.min(lon).alias("west"), F.max(lon).alias("east"), ((F.min(lat) + F.max(lat)) / 2).alias("mid_latitude"), ((F.min(lon) + F.max(lon)) / 2).alias("mid_longitude"))


# ---- reports -----------------------------------------------------------------------------------------------


def report_movements(movements: DataFrame) -> DataFrame:
    """Movements narrowed to what a report shows."""
    return movements.select(
        "flight_id", "movement_type", F.col("event_time").alias("movement_time"), F.col("ident").alias("airport_ident"), F.col("iata_code").alias("airport_iata"),
        "airport_name", "iso_country", F.round("distance_km", 2).alias("distance_km"), "release_date",
    )


def track_sample(points: DataFrame, holds: DataFrame, every_seconds: int = DEFAULTS.track_sample_seconds) -> DataFrame:
    """A point for each bucket of time, of the flights that held."""
    names = ("flight_id", "event_time", "observation_seq", "latitude", "longitude", "altitude_ft", "ground_speed_kt", "track_deg", "release_date")
    held = points.join(holds.select("flight_id"), "flight_id", "left_semi").select(*names)
    return thin_by_bucket(held, "flight_id", "event_time", "observation_seq", every_seconds)


def with_source(df: DataFrame) -> DataFrame:
    return df.withColumn("data_source", F.lit(TRACK_DATA_SOURCE))


def measures(movements: DataFrame, flights: DataFrame, holds: DataFrame) -> DataFrame:
    """The report's measures in one row; a rate without arrivals is null."""
    m = movements.agg(F.count(F.lit(1)).alias("operations"), F.count_if(F.col("movement_type") == "arrival").alias("arrivals"), F.count_if(F.col("movement_type") == "departure").alias("departures"))
    f = flights.agg(F.count_distinct("icao").alias("unique_aircraft"), F.count(F.lit(1)).alias("flights"))
    h = holds.agg(
        F.count(F.lit(1)).alias("detected_holds"), F.count_distinct("flight_id").alias("flights_with_holds"), F.round(F.avg("duration_seconds"), 6).alias("avg_hold_seconds"),
        F.sum("duration_seconds").alias("total_hold_seconds"), F.round(F.avg("circuits"), 6).alias("avg_circuits"),
    )
    one = m.withColumn("k", F.lit(1)).join(f.withColumn("k", F.lit(1)), "k").join(h.withColumn("k", F.lit(1)), "k").drop("k")
    return one.withColumn("hold_rate", F.round(F.try_divide("flights_with_holds", "arrivals"), 6))


def hourly_by_direction(movements: DataFrame) -> DataFrame:
    return movements.groupBy(F.hour("event_time").alias("hour")).pivot("movement_type", ["departure", "arrival"]).count().fillna(0)


def airline_top(flights: DataFrame, n: int = 15) -> DataFrame:
    return flights.where("airline_icao IS NOT NULL").groupBy("airline_icao").agg(F.count(F.lit(1)).alias("flights")).orderBy(F.desc("flights"), "airline_icao").limit(n)


def airline_type_matrix(flights: DataFrame) -> DataFrame:
    return flights.where("airline_icao IS NOT NULL AND aircraft_type IS NOT NULL").groupBy("airline_icao", "aircraft_type").agg(F.count(F.lit(1)).alias("flights"))


def aircraft_usage(flights: DataFrame) -> DataFrame:
    return flights.groupBy("aircraft_type").agg(F.count(F.lit(1)).alias("flights"), F.count_distinct("icao").alias("aircraft"), F.sum("duration_seconds").alias("seconds"))


def duration_histogram(holds: DataFrame, width_seconds: int = 120) -> DataFrame:
    return holds.groupBy((F.floor(F.col("duration_seconds") / width_seconds) * width_seconds).alias("from_seconds")).agg(F.count(F.lit(1)).alias("holds"))


def circuits_by_airport(holds: DataFrame) -> DataFrame:
    return holds.groupBy("arrival_airport_ident").agg(F.count(F.lit(1)).alias("holds"), F.round(F.avg("circuits"), 6).alias("avg_circuits"), F.round(F.avg("duration_seconds"), 6).alias("avg_seconds"))


# ---- profiles of the raw observations ----------------------------------------------------------------------


def profile_totals(observations: DataFrame) -> DataFrame:
    return observations.agg(F.count_distinct("icao").alias("aircraft"), F.count_distinct("callsign").alias("callsigns"), F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"))


def profile_by_ground(observations: DataFrame) -> DataFrame:
    return observations.groupBy("on_ground").agg(F.count(F.lit(1)).alias("reports"), F.round(F.avg("altitude_ft"), 0).alias("avg_altitude_ft")).orderBy("on_ground")


def profile_by_type(observations: DataFrame, n: int = 10) -> DataFrame:
    by = observations.groupBy("aircraft_type").agg(F.count(F.lit(1)).alias("reports"), F.count_distinct("icao").alias("aircraft"), F.round(F.max("altitude_ft"), 0).alias("max_altitude_ft"))
    return by.orderBy(F.desc("reports"), "aircraft_type").limit(n)


def fastest(observations: DataFrame, n: int = 5) -> DataFrame:
    return observations.where(~F.col("on_ground")).orderBy(F.desc("ground_speed_kt"), "icao", "event_time").select("icao", "callsign", "aircraft_type", "event_time", "ground_speed_kt", "altitude_ft").limit(n)


def table_diff(left: DataFrame, right: DataFrame, keys, places: int = 4) -> DataFrame:
    """Rows that two tables do not share, with the columns that differ; doubles are compared to `places`."""
    keys = list(keys)
    same = lambda c: F.round(c, places) if dict(left.dtypes)[c.split(".")[-1].strip("`")] in ("double", "float") else F.col(c)
    others = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.struct(*[same(c).alias(c) for c in others]).alias("l"), F.lit(True).alias("in_l"))
    b = right.select(*keys, F.struct(*[same(c).alias(c) for c in others]).alias("r"), F.lit(True).alias("in_r"))
    both = a.join(b, keys, "full_outer")
    differ = F.filter(F.array(*[F.when(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")), c) for c in others]), lambda x: x.isNotNull())
    where = F.when(F.col("in_l").isNull(), "right").when(F.col("in_r").isNull(), "left").otherwise("both")
    return both.select(*keys, where.alias("side"), F.when(where == "both", differ).alias("columns")).where((F.col("side") != "both") | (F.size("columns") > 0))
