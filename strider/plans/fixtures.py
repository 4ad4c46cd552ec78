"""A deterministic trajectory view over the event table, so that the real operators run on it with exact arithmetic."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.config import Thresholds
from strider.operators import decode

#: The events are hours apart, so the windows are wide; every other threshold is the default.
WIDE = Thresholds(gap_seconds=86_400, smoothing_seconds=43_200, turn_window_seconds=86_400, max_step_gap_seconds=86_400, max_span_km=1e6, max_altitude_range_ft=1e9)

#: The same with limits that some of the events' holds exceed.
NARROW = replace(WIDE, max_span_km=9.0, max_altitude_range_ft=5000.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded observations, before segmentation (and before implausible values are nulled)."""
    u, kind = F.col("user_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    field = (u % 25).cast("double") * 0.5 + k * 0.001
    ground = kind == "signup"
    callsign = F.when(kind == "click", F.concat(F.lit("SWR"), (u % 900 + 100).cast("string"))).when(kind == "view", F.concat(F.lit("RYR"), (u % 7 + 1).cast("string"), F.lit("K"))).when(kind == "error", "D-EABC").when(kind == "purchase", "")
    day = F.to_date("ts")
    return table(spark, sf_dir, "events").select(
        F.concat(F.when(u % 10 == 0, "~").otherwise(""), F.lit("u"), u.cast("string")).alias("icao"),
        F.concat(F.lit("R"), (u % 50).cast("string")).alias("registration"),
        F.concat(F.lit("T"), (u % 5).cast("string")).alias("aircraft_type"),
        F.concat(F.lit("OWNER"), (u % 7).cast("string")).alias("operator"),
        F.col("ts").alias("event_time"),
        (40 + field).alias("latitude"),
        (5 + field).alias("longitude"),
        F.when(~((kind == "error") & (k % 17 == 0)), ground).alias("on_ground"),
        F.when(~ground, F.floor(F.col("value") * 100).cast("double")).alias("altitude_ft"),
        F.when(k % 50 == 49, 800.0).otherwise((k * 7 % 500).cast("double")).alias("ground_speed_kt"),
        ((k * 37) % 360).cast("double").alias("track_deg"),
        F.when(kind != "error", (k * 40 - 2000 + F.when(k == 98, 25_000).otherwise(0)).cast("double")).alias("vertical_rate_fpm"),
        callsign.alias("callsign"),
        F.concat(F.lit("v"), F.date_format("ts", "yyyy.MM.dd"), F.lit("-planes-readsb-prod-0")).alias("release_tag"),
        day.alias("release_date"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.clean(points(spark, sf_dir))


def observations(spark: SparkSession, sf_dir: str, gap_seconds: int = WIDE.gap_seconds) -> DataFrame:
    return decode.assign_flights(cleaned(spark, sf_dir), gap_seconds)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("A"), F.lpad(n.cast("string"), 3, "0")).alias("ident"),
        F.when(n % 6 != 0, F.upper(F.substring("n_name", 1, 3))).alias("iata_code"),
        F.col("n_name").alias("name"),
        F.when(n % 2 == 0, "large_airport").otherwise("medium_airport").alias("type"),
        F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("iso_country"),
        (40 + n * 0.5).cast("double").alias("latitude_deg"),
        (5 + n * 0.5).cast("double").alias("longitude_deg"),
        F.when(n % 4 != 0, n.cast("double") * 10).alias("elevation_ft"),
    )


#: The same view in SQL, as common table expressions that build on one another.
POINTS_SQL = """
raw AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
points AS (SELECT
  CASE WHEN user_id % 10 = 0 THEN '~' ELSE '' END || 'u' || user_id AS icao,
  'R' || (user_id % 50) AS registration, 'T' || (user_id % 5) AS aircraft_type, 'OWNER' || (user_id % 7) AS operator,
  ts AS event_time,
  CAST(40 AS DOUBLE) + (CAST(user_id % 25 AS DOUBLE) * CAST(0.5 AS DOUBLE) + k * CAST(0.001 AS DOUBLE)) AS latitude,
  CAST(5 AS DOUBLE) + (CAST(user_id % 25 AS DOUBLE) * CAST(0.5 AS DOUBLE) + k * CAST(0.001 AS DOUBLE)) AS longitude,
  CASE WHEN NOT (event_type = 'error' AND k % 17 = 0) THEN event_type = 'signup' END AS on_ground,
  CASE WHEN event_type <> 'signup' THEN CAST(floor(value * 100) AS DOUBLE) END AS altitude_ft,
  CASE WHEN k % 50 = 49 THEN CAST(800 AS DOUBLE) ELSE CAST(k * 7 % 500 AS DOUBLE) END AS raw_speed,
  CAST((k * 37) % 360 AS DOUBLE) AS track_deg,
  CASE WHEN event_type <> 'error' THEN CAST(k * 40 - 2000 + CASE WHEN k = 98 THEN 25000 ELSE 0 END AS DOUBLE) END AS raw_rate,
  CASE event_type WHEN 'click' THEN 'SWR' || (user_id % 900 + 100) WHEN 'view' THEN 'RYR' || (user_id % 7 + 1) || 'K' WHEN 'error' THEN 'D-EABC' WHEN 'purchase' THEN '' END AS raw_callsign,
  'v' || strftime(ts, '%Y.%m.%d') || '-planes-readsb-prod-0' AS release_tag, CAST(ts AS DATE) AS release_date
  FROM raw),
cleaned AS (SELECT *, icao NOT LIKE '~%' AS is_icao_address,
  CASE WHEN raw_speed > 700 THEN NULL ELSE raw_speed END AS ground_speed_kt,
  CASE WHEN abs(raw_rate) > 20000 THEN NULL ELSE raw_rate END AS vertical_rate_fpm,
  NULLIF(raw_callsign, '') AS callsign FROM points)"""


def observations_sql(gap: int = WIDE.gap_seconds) -> str:
    return f"""{POINTS_SQL},
gaps AS (SELECT *, CAST(floor(epoch(event_time)) AS BIGINT) AS sec,
  CAST(floor(epoch(event_time)) AS BIGINT) - CAST(floor(epoch(LAG(event_time) OVER (PARTITION BY icao ORDER BY event_time))) AS BIGINT) AS gap FROM cleaned),
numbered AS (SELECT *, SUM(CASE WHEN gap IS NULL OR gap > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY icao ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS segment_no FROM gaps),
obs AS (SELECT icao || '_' || strftime(MIN(event_time) OVER (PARTITION BY icao, segment_no), '%Y%m%d%H%M%S') AS flight_id, *,
  CAST(ROW_NUMBER() OVER (PARTITION BY icao, segment_no ORDER BY event_time, latitude, longitude) AS INTEGER) AS observation_seq FROM numbered)"""


OBS_SQL = observations_sql()

BASE_SQL = f"""{OBS_SQL},
base AS (SELECT flight_id, icao, MAX(is_icao_address) AS is_icao_address, MAX(registration) AS registration, MAX(aircraft_type) AS aircraft_type, MAX(operator) AS registered_owner,
  arg_min(callsign, event_time) FILTER (WHERE callsign IS NOT NULL) AS callsign, COUNT(DISTINCT callsign) AS n_callsigns,
  MIN(event_time) AS first_seen_time, MAX(event_time) AS last_seen_time, MAX(sec) - MIN(sec) AS duration_seconds, COUNT(*) AS n_observations,
  arg_min_null(latitude, event_time) AS first_latitude, arg_min_null(longitude, event_time) AS first_longitude,
  arg_max_null(latitude, event_time) AS last_latitude, arg_max_null(longitude, event_time) AS last_longitude,
  arg_min_null(on_ground, event_time) AS started_on_ground, arg_max_null(on_ground, event_time) AS ended_on_ground,
  arg_min_null(altitude_ft, event_time) AS first_altitude_ft, arg_max_null(altitude_ft, event_time) AS last_altitude_ft,
  MAX(CASE WHEN on_ground THEN 1 ELSE 0 END) = 1 AS saw_ground, MAX(altitude_ft) AS max_altitude_ft, MAX(ground_speed_kt) AS max_ground_speed_kt,
  MAX(release_tag) AS release_tag, MAX(release_date) AS release_date FROM obs GROUP BY 1, 2)"""

AIRPORTS_SQL = """
airports AS (SELECT 'A' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS ident, CASE WHEN n_nationkey % 6 <> 0 THEN upper(n_name[1:3]) END AS iata_code, n_name AS name,
  CASE WHEN n_nationkey % 2 = 0 THEN 'large_airport' ELSE 'medium_airport' END AS type, 'C' || n_regionkey AS iso_country,
  40 + n_nationkey * CAST(0.5 AS DOUBLE) AS latitude_deg, 5 + n_nationkey * CAST(0.5 AS DOUBLE) AS longitude_deg,
  CASE WHEN n_nationkey % 4 <> 0 THEN CAST(n_nationkey AS DOUBLE) * 10 END AS elevation_ft FROM nation)"""


def km_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"6371.0::DOUBLE * 2 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))"


MOVES_SQL = f"""{BASE_SQL}, {AIRPORTS_SQL},
moving AS (SELECT * FROM base WHERE NOT (first_latitude = last_latitude AND first_longitude = last_longitude)),
ends AS (
  SELECT flight_id, icao, aircraft_type, registered_owner, callsign, release_tag, release_date, 'departure' AS movement_type, first_seen_time AS event_time, first_latitude AS latitude, first_longitude AS longitude, first_altitude_ft AS altitude_ft FROM moving
  UNION ALL SELECT flight_id, icao, aircraft_type, registered_owner, callsign, release_tag, release_date, 'arrival', last_seen_time, last_latitude, last_longitude, last_altitude_ft FROM moving),
met AS (SELECT e.*, a.ident, a.iata_code, a.name AS airport_name, a.type AS airport_type, a.iso_country, a.latitude_deg, a.longitude_deg, a.elevation_ft,
  {km_sql("e.latitude", "e.longitude", "a.latitude_deg", "a.longitude_deg")} AS distance_km FROM ends e, airports a),
moves AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY flight_id, movement_type ORDER BY distance_km, ident) AS r FROM met
  WHERE distance_km <= 5 AND (altitude_ft IS NULL OR altitude_ft - COALESCE(elevation_ft, 0) <= 5000)) WHERE r = 1),
pivoted AS (SELECT flight_id,
  {", ".join(f"MAX(CASE WHEN movement_type = '{e}' THEN {c} END) AS {e}_{n}" for e in ("departure", "arrival") for n, c in (("airport_ident", "ident"), ("airport_iata", "iata_code"), ("airport_name", "airport_name"), ("time", "event_time"), ("distance_km", "distance_km")))}
  FROM moves GROUP BY 1)"""

PHASES_SQL = f"""{OBS_SQL},
smooth AS (SELECT flight_id, event_time, sec, observation_seq, release_date, altitude_ft, on_ground, ground_speed_kt, vertical_rate_fpm,
  AVG(vertical_rate_fpm) OVER (PARTITION BY flight_id ORDER BY sec RANGE BETWEEN {WIDE.smoothing_seconds // 2} PRECEDING AND {WIDE.smoothing_seconds // 2} FOLLOWING) AS climb,
  MIN(CASE WHEN NOT on_ground THEN observation_seq END) OVER (PARTITION BY flight_id) AS first_air, MAX(CASE WHEN NOT on_ground THEN observation_seq END) OVER (PARTITION BY flight_id) AS last_air FROM obs),
labelled AS (SELECT *, CASE WHEN on_ground IS NULL THEN 'unknown' WHEN on_ground AND observation_seq < first_air THEN 'taxi_out' WHEN on_ground AND observation_seq > last_air THEN 'taxi_in' WHEN on_ground THEN 'taxi'
  WHEN climb IS NULL THEN 'unknown' WHEN climb > 300 THEN 'climb' WHEN climb < -300 THEN 'descent' ELSE 'cruise' END AS phase FROM smooth),
changes AS (SELECT *, CASE WHEN phase = LAG(phase) OVER (PARTITION BY flight_id ORDER BY observation_seq) THEN 0 ELSE 1 END AS fresh FROM labelled),
runs AS (SELECT *, SUM(fresh) OVER (PARTITION BY flight_id ORDER BY observation_seq ROWS UNBOUNDED PRECEDING) AS run_no FROM changes),
phases AS (SELECT flight_id, run_no, MAX(phase) AS phase, MIN(event_time) AS start_time, MAX(event_time) AS end_time, MAX(sec) - MIN(sec) AS duration_seconds, COUNT(*) AS n_observations,
  arg_min_null(altitude_ft, event_time) AS start_altitude_ft, arg_max_null(altitude_ft, event_time) AS end_altitude_ft, MIN(altitude_ft) AS min_altitude_ft, MAX(altitude_ft) AS max_altitude_ft,
  round(AVG(ground_speed_kt), 1) AS avg_ground_speed_kt, round(AVG(climb), 1) AS avg_vertical_rate_fpm, MAX(release_date) AS release_date FROM runs GROUP BY 1, 2)"""

HOLDS_SQL = f"""{MOVES_SQL},
steps AS (SELECT flight_id, event_time, sec, observation_seq, latitude, longitude, altitude_ft, track_deg, release_date,
  sec - LAG(sec) OVER (PARTITION BY flight_id ORDER BY observation_seq) AS step, track_deg - LAG(track_deg) OVER (PARTITION BY flight_id ORDER BY observation_seq) + 180 AS turn FROM obs WHERE NOT on_ground AND track_deg IS NOT NULL),
counted AS (SELECT *, CASE WHEN step BETWEEN 1 AND {WIDE.max_step_gap_seconds} THEN ((turn % 360) + 360) % 360 - 180 ELSE 0 END AS t FROM steps),
windowed AS (SELECT *, SUM(t) OVER (PARTITION BY flight_id ORDER BY sec RANGE BETWEEN {WIDE.turn_window_seconds // 2} PRECEDING AND {WIDE.turn_window_seconds // 2} FOLLOWING) AS turned FROM counted),
circling AS (SELECT *, CASE WHEN abs(turned) >= 360 THEN 1 ELSE 0 END AS c FROM windowed),
c_runs AS (SELECT *, SUM(fresh) OVER (PARTITION BY flight_id ORDER BY observation_seq ROWS UNBOUNDED PRECEDING) AS run_no FROM
  (SELECT *, CASE WHEN c = LAG(c) OVER (PARTITION BY flight_id ORDER BY observation_seq) THEN 0 ELSE 1 END AS fresh FROM circling)),
candidates AS (SELECT flight_id, MIN(event_time) AS hold_start, MAX(event_time) AS hold_end, MAX(sec) - MIN(sec) AS duration_seconds, COUNT(*) AS n_observations,
  MIN(altitude_ft) AS min_altitude_ft, MAX(altitude_ft) AS max_altitude_ft, round(AVG(altitude_ft)) AS mean_altitude_ft, round(AVG(latitude), 5) AS centroid_latitude, round(AVG(longitude), 5) AS centroid_longitude,
  round(sqrt(pow((MAX(latitude) - MIN(latitude)) * 111.32::DOUBLE, 2) + pow((MAX(longitude) - MIN(longitude)) * 111.32::DOUBLE * cos(radians(AVG(latitude))), 2)), 2) AS span_km,
  round(arg_max(turned, abs(turned) * 1e6 + turned)::DOUBLE, 1) AS turn_degrees, round(MAX(abs(turned)) / 360.0::DOUBLE, 1) AS circuits, MAX(step) AS max_sample_gap_seconds, MAX(release_date) AS release_date
  FROM c_runs WHERE c = 1 GROUP BY flight_id, run_no),
long_enough AS (SELECT c.*, p.arrival_airport_ident, p.arrival_airport_iata, round({km_sql("c.centroid_latitude", "c.centroid_longitude", "a.latitude_deg", "a.longitude_deg")}, 1) AS distance_to_arrival_airport_km
  FROM candidates c LEFT JOIN pivoted p USING (flight_id) LEFT JOIN airports a ON a.ident = p.arrival_airport_ident WHERE duration_seconds >= 240),
holds AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY flight_id ORDER BY hold_start) AS INTEGER) AS hold_seq FROM long_enough),
rollup_h AS (SELECT flight_id, COUNT(*) AS n, CAST(SUM(duration_seconds) AS BIGINT) AS s FROM holds GROUP BY 1),
flights AS (SELECT b.*, CAST(b.first_seen_time AS DATE) AS flight_date, CASE WHEN regexp_matches(b.callsign, '^[A-Z]{{3}}[0-9][0-9A-Z]*$') THEN b.callsign[1:3] END AS airline_icao,
  p.* EXCLUDE (flight_id), COALESCE(h.n, 0) AS n_detected_holds, COALESCE(h.n, 0) > 0 AS has_detected_hold, COALESCE(h.s, 0) AS total_hold_seconds
  FROM base b LEFT JOIN pivoted p USING (flight_id) LEFT JOIN rollup_h h USING (flight_id)),
h_metrics AS (SELECT CAST(hold_start AS DATE) AS operations_date, arrival_airport_ident AS airport_ident, COUNT(DISTINCT flight_id) AS fh, AVG(duration_seconds) AS ad FROM holds WHERE arrival_airport_ident IS NOT NULL GROUP BY 1, 2),
ops AS (SELECT CAST(event_time AS DATE) AS operations_date, ident AS airport_ident, iata_code AS airport_iata, airport_name, airport_type, iso_country, latitude_deg AS airport_latitude, longitude_deg AS airport_longitude,
  COUNT(*) FILTER (WHERE movement_type = 'arrival') AS arrivals, COUNT(*) FILTER (WHERE movement_type = 'departure') AS departures, COUNT(*) AS total_operations, COUNT(DISTINCT icao) AS unique_aircraft,
  MIN(event_time) AS first_operation_time, MAX(event_time) AS last_operation_time, MAX(release_tag) AS release_tag, MAX(release_date) AS release_date, 'adsb_inferred' AS metric_source FROM moves GROUP BY 1, 2, 3, 4, 5, 6, 7, 8),
ops_h AS (SELECT o.*, COALESCE(h.fh, 0) AS flights_with_detected_holds, CASE WHEN arrivals > 0 THEN round(COALESCE(h.fh, 0) / arrivals, 4) END AS hold_rate, h.ad FROM ops o LEFT JOIN h_metrics h USING (operations_date, airport_ident))"""
