"""The registered queries of the trajectory engine, each beside the SQL that gives the same rows.

Every query runs the library's own operators over the whole fixture view (see fixtures); limits stand only where they are
the feature. Doubles are rounded where two engines may add in another order.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


from strider.functions.columns import airline_of, clock_text, duration_text, haversine_km, in_any_box, text_or
from strider.operators import decode, explore, flights, holds, legacy, movements, phases, quality, scope, timewin
from strider.plans import fixtures as fx

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql.strip()
        return f

    return keep


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---- frames that queries share -----------------------------------------------------------------------------


def _obs(spark, d) -> DataFrame:
    return fx.observations(spark, d)


def _base(spark, d) -> DataFrame:
    return flights.aggregate_flights(_obs(spark, d))


def _moves(spark, d) -> DataFrame:
    return movements.airport_movements(_base(spark, d), fx.airports(spark, d))


def _holds(spark, d) -> DataFrame:
    return holds.to_flight_holds(_obs(spark, d), flights.movement_pivot(_moves(spark, d)), fx.airports(spark, d), fx.WIDE)


def _flights(spark, d) -> DataFrame:
    return flights.to_flights(_base(spark, d), flights.movement_pivot(_moves(spark, d)), _holds(spark, d))


def _phases(spark, d) -> DataFrame:
    return phases.to_flight_phases(_obs(spark, d), fx.WIDE)


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


# ---- decode and segmentation -------------------------------------------------------------------------------


@query(f"WITH {fx.POINTS_SQL} SELECT icao, is_icao_address, event_time, ground_speed_kt, vertical_rate_fpm, callsign FROM cleaned")
def value_nulling(spark, d):
    return fx.cleaned(spark, d).select("icao", "is_icao_address", "event_time", "ground_speed_kt", "vertical_rate_fpm", "callsign")


@query(f"WITH {fx.observations_sql(21_600)} SELECT icao, CAST(segment_no AS BIGINT) AS segment_no, COUNT(*) AS n, MIN(event_time) AS first_seen FROM obs GROUP BY 1, 2")
def session_segments(spark, d):
    df = timewin.segment_by_gap(fx.cleaned(spark, d), "icao", "event_time", 21_600)
    return df.groupBy("icao", "segment_no").agg(F.count(F.lit(1)).alias("n"), F.min("event_time").alias("first_seen"))


@query(f"WITH {fx.OBS_SQL} SELECT flight_id, icao, event_time, observation_seq, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, on_ground, altitude_ft, release_tag, release_date FROM obs")
def observations_table(spark, d):
    return _obs(spark, d).select("flight_id", "icao", "event_time", "observation_seq", *r6("latitude", "longitude"), "on_ground", "altitude_ft", "release_tag", "release_date")


_TRACES = """
WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(floor(epoch(ts)) AS BIGINT) // 3600 * 3600 AS hour, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type, event_id FROM events),
q AS (SELECT 'u' || user_id AS icao, hour, event_id,
  CASE WHEN event_type <> 'signup' THEN CAST(k * 100 AS DOUBLE) END AS altitude_ft, event_type = 'signup' AS on_ground,
  CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k * 9 AS DOUBLE) END AS speed, CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS track_deg, CASE WHEN k % 5 <> 0 THEN 'C' || k END AS callsign,
  CAST(40 + k AS DOUBLE) AS latitude FROM p),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY icao, hour ORDER BY
  (altitude_ft IS NOT NULL)::INT + (speed IS NOT NULL)::INT + (track_deg IS NOT NULL)::INT + (callsign IS NOT NULL)::INT DESC, latitude, event_id) AS rn FROM q)
SELECT icao, CAST(hour AS BIGINT) AS event_epoch, latitude, on_ground, altitude_ft, CASE WHEN speed > 700 THEN NULL ELSE speed END AS ground_speed_kt, track_deg, callsign FROM r WHERE rn = 1
"""


def _raw(spark, d) -> DataFrame:
    """Raw traces, one row for each aircraft: points fall on whole hours, so that many collide."""
    k = F.get_json_object("props", "$.k").cast("int")
    text = lambda c: c.cast("string")
    point = F.array(
        text(F.floor(F.unix_timestamp("ts") / 3600) * 3600), text(40 + k), F.lit("5"), F.when(F.col("event_type") == "signup", "ground").otherwise(text(k * 100)),
        F.when(k % 3 != 0, text(k * 9)), F.when(k % 4 != 0, text(k)), F.lit("0"), F.lit(None).cast("string"),
        F.when(k % 5 != 0, F.concat(F.lit('{"flight": "C'), text(k), F.lit(' "}'))),
    )
    e = fx.table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("icao"), "event_id", point.alias("p"))
    raw = e.groupBy("icao").agg(F.array_sort(F.collect_list(F.struct("event_id", "p"))).alias("t"))
    none = F.lit(None).cast("string")
    return raw.select("icao", none.alias("r"), none.alias("t"), none.alias("ownOp"), F.lit(0.0).alias("timestamp"), F.col("t.p").alias("trace"))


_PATH = "s/v2024.01.01-x/traces/00/a.json.gz"


@query(_TRACES)
def dedup_winner(spark, d):
    out = decode.decode(_raw(spark, d), path=F.lit(_PATH))
    return out.select("icao", F.unix_timestamp("event_time").alias("event_epoch"), "latitude", "on_ground", "altitude_ft", "ground_speed_kt", "track_deg", "callsign")


@query("SELECT COUNT(*) AS raw_points, COUNT(DISTINCT (user_id, CAST(floor(epoch(ts)) AS BIGINT) // 3600)) AS observations, COUNT(*) - COUNT(DISTINCT (user_id, CAST(floor(epoch(ts)) AS BIGINT) // 3600)) AS dropped FROM events")
def points_dropped(spark, d):
    raw = _raw(spark, d)
    return quality.points_dropped(raw, decode.decode(raw, path=F.lit(_PATH)))


@query(f"""WITH t AS ({_TRACES}), g AS (SELECT *, CASE WHEN event_epoch - LAG(event_epoch) OVER w <= 86400 THEN 0 ELSE 1 END AS fresh FROM t WINDOW w AS (PARTITION BY icao ORDER BY event_epoch)),
n AS (SELECT *, SUM(fresh) OVER (PARTITION BY icao ORDER BY event_epoch ROWS UNBOUNDED PRECEDING) AS segment_no FROM g)
SELECT icao || '_' || strftime(make_timestamp(MIN(event_epoch) * 1000000), '%Y%m%d%H%M%S') AS flight_id, icao, COUNT(*) AS n_observations, MAX(event_epoch) - MIN(event_epoch) AS duration_seconds,
  arg_min(callsign, event_epoch) FILTER (WHERE callsign IS NOT NULL) AS callsign, MAX(altitude_ft) AS max_altitude_ft, MAX(ground_speed_kt) AS max_ground_speed_kt, bool_or(on_ground) AS saw_ground FROM n GROUP BY icao, segment_no""")
def decoded_flights(spark, d):
    """From raw traces to flights: decode, segment, number, aggregate."""
    observed = decode.assign_flights(decode.decode(_raw(spark, d), path=F.lit(_PATH)), fx.WIDE.gap_seconds)
    return flights.aggregate_flights(observed).select("flight_id", "icao", "n_observations", "duration_seconds", "callsign", "max_altitude_ft", "max_ground_speed_kt", "saw_ground")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CASE WHEN event_type = 'click' THEN 'SWR' END AS airline FROM events")
def json_props_extract(spark, d):
    e = fx.table(spark, d, "events")
    callsign = F.when(F.col("event_type") == "click", F.concat(F.lit("SWR"), (F.col("user_id") % 900 + 100).cast("string"))).otherwise("D-EABC")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), airline_of(callsign).alias("airline"))


@query("SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 HAVING bool_or(CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 40 AND 42)")
def exists_array_filter(spark, d):
    """The spatial pre-filter on arrays, before they are exploded."""
    k = F.get_json_object("props", "$.k")
    raw = fx.table(spark, d, "events").groupBy("user_id").agg(F.collect_list(F.array(F.lit("0"), k, F.lit("7"))).alias("trace"))
    return scope.near_scope(raw, [(40.0, 42.0, 6.0, 8.0)]).select("user_id", F.size("trace").cast("long").alias("n"))


# ---- flights and movements ---------------------------------------------------------------------------------


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """The frame with these doubles rounded, beyond what the order of additions or a library's sine changes."""
    return df.withColumns({n: F.round(n, 6) for n in names})


def rounded_sql(*names: str) -> str:
    return "* REPLACE (" + ", ".join(f"round({n}, 6) AS {n}" for n in names) + ")"


_ENDS = ("first_latitude", "first_longitude", "last_latitude", "last_longitude")
_KM = ("departure_distance_km", "arrival_distance_km")


@query(f"WITH {fx.BASE_SQL} SELECT {rounded_sql(*_ENDS)} FROM base")
def session_aggregate(spark, d):
    return rounded(_base(spark, d), *_ENDS)


@query(f"WITH {fx.BASE_SQL} SELECT flight_id, callsign, n_callsigns, CASE WHEN regexp_matches(callsign, '^[A-Z]{{3}}[0-9][0-9A-Z]*$') THEN callsign[1:3] END AS airline_icao FROM base")
def session_first_callsign(spark, d):
    return _base(spark, d).select("flight_id", "callsign", "n_callsigns", airline_of("callsign").alias("airline_icao"))


@query(f"WITH {fx.AIRPORTS_SQL}, s AS (SELECT unnest([-1, 0, 1]) AS x) SELECT ident, CAST(floor(latitude_deg) + a.x AS BIGINT) AS cell_lat, CAST(floor(longitude_deg) + b.x AS BIGINT) AS cell_lon FROM airports, s a, s b")
def airport_cells(spark, d):
    return movements.airport_cells(fx.airports(spark, d)).select("ident", "cell_lat", "cell_lon")


_MOVE = "flight_id, movement_type, event_time, altitude_ft, ident, iata_code, airport_name, airport_type, iso_country, elevation_ft, release_tag, release_date"


@query(f"WITH {fx.MOVES_SQL} SELECT {_MOVE}, round(distance_km, 6) AS distance_km FROM moves")
def movements_nearest(spark, d):
    return _moves(spark, d).select(*_MOVE.split(", "), *r6("distance_km"))


@query(f"WITH {fx.MOVES_SQL} SELECT movement_type, COUNT(*) AS n, COUNT(DISTINCT flight_id) AS flights FROM ends GROUP BY 1")
def union_all_endpoints(spark, d):
    return movements.endpoints(_base(spark, d)).groupBy("movement_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("flight_id").alias("flights"))


@query(f"WITH {fx.MOVES_SQL} SELECT {rounded_sql(*_KM)} FROM pivoted")
def movement_pivot(spark, d):
    return rounded(flights.movement_pivot(_moves(spark, d)), *_KM)


@query(f"WITH {fx.HOLDS_SQL}, f AS (SELECT {', '.join(flights.FLIGHT)} FROM flights) SELECT {rounded_sql(*_ENDS, *_KM)} FROM f")
def flights_table(spark, d):
    return rounded(_flights(spark, d), *_ENDS, *_KM)


_OPS = "operations_date, airport_ident, airport_iata, airport_name, airport_type, iso_country, arrivals, departures, total_operations, unique_aircraft, first_operation_time, last_operation_time, release_tag, release_date, metric_source"


@query(f"WITH {fx.HOLDS_SQL} SELECT {_OPS} FROM ops")
def daily_operations(spark, d):
    return movements.to_airport_operations(_moves(spark, d)).select(*_OPS.split(", "))


@query(f"WITH {fx.HOLDS_SQL} SELECT operations_date, airport_ident, arrivals, flights_with_detected_holds, hold_rate, CAST(floor(ad + 0.5) AS DOUBLE) AS avg_hold_duration_seconds FROM ops_h")
def daily_operations_holds(spark, d):
    ops = movements.to_airport_operations(_moves(spark, d), _holds(spark, d))
    return ops.select("operations_date", "airport_ident", "arrivals", "flights_with_detected_holds", "hold_rate", "avg_hold_duration_seconds")


@query(f"WITH {fx.MOVES_SQL} SELECT flight_id, COUNT(*) AS n FROM obs WHERE flight_id IN (SELECT flight_id FROM moves WHERE ident IN ('A003', 'A007', 'A011')) GROUP BY 1")
def scope_semi(spark, d):
    own = scope.Scope(airports=("A003", "A007", "A011"))
    ids = scope.scope_flight_ids(_moves(spark, d), own)
    return scope.restrict_to_flights(_obs(spark, d), ids).groupBy("flight_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {fx.MOVES_SQL} SELECT DISTINCT flight_id FROM obs WHERE flight_id NOT IN (SELECT flight_id FROM moves)")
def orphans_anti(spark, d):
    return quality.orphans(_obs(spark, d), _moves(spark, d))


# ---- phases and holds --------------------------------------------------------------------------------------


@query(f"WITH {fx.PHASES_SQL} SELECT flight_id, observation_seq, round(climb, 6) AS climb, phase FROM labelled")
def phase_labels(spark, d):
    return phases.label_observations(_obs(spark, d), fx.WIDE).select("flight_id", "observation_seq", F.round("smoothed_vertical_rate_fpm", 6).alias("climb"), "phase")


@query(f"WITH {fx.PHASES_SQL} SELECT * EXCLUDE (run_no), CAST(ROW_NUMBER() OVER (PARTITION BY flight_id ORDER BY start_time) AS INTEGER) AS phase_seq FROM phases")
def phase_intervals(spark, d):
    return _phases(spark, d)


@query(f"WITH {fx.PHASES_SQL} SELECT phase, COUNT(*) AS intervals, COUNT(DISTINCT flight_id) AS flights, quantile_disc(duration_seconds, 0.5) AS median_seconds, round(avg(n_observations), 1) AS avg_observations FROM phases GROUP BY 1")
def phase_mix(spark, d):
    return phases.phase_mix(_phases(spark, d))


@query(f"WITH {fx.PHASES_SQL}, n AS (SELECT COUNT(*) AS n FROM phases GROUP BY flight_id) SELECT quantile_disc(n, 0.5) AS p50, quantile_disc(n, 0.9) AS p90, quantile_disc(n, 0.99) AS p99, MAX(n) AS most FROM n")
def phase_fragmentation(spark, d):
    return phases.fragmentation(_phases(spark, d))


@query(f"WITH {fx.HOLDS_SQL} SELECT flight_id, observation_seq, CAST(t AS DOUBLE) AS counted_turn, CAST(turned AS DOUBLE) AS turn_in_window_degrees FROM windowed")
def turn_window(spark, d):
    return holds.turn_in_window(_obs(spark, d), fx.WIDE).select("flight_id", "observation_seq", "counted_turn", "turn_in_window_degrees")


@query(f"WITH {fx.HOLDS_SQL} SELECT * FROM candidates")
def hold_candidates(spark, d):
    return holds.detect_hold_candidates(_obs(spark, d), fx.WIDE)


@query(f"WITH {fx.HOLDS_SQL} SELECT {', '.join(holds.HOLD)} FROM holds")
def flight_holds(spark, d):
    return _holds(spark, d)


_LIMITED = f"WHERE span_km <= {fx.NARROW.max_span_km} AND max_altitude_ft - min_altitude_ft <= {fx.NARROW.max_altitude_range_ft}"


@query(f"WITH {fx.HOLDS_SQL} SELECT flight_id, CAST(ROW_NUMBER() OVER (PARTITION BY flight_id ORDER BY hold_start) AS INTEGER) AS hold_seq, hold_start, span_km, min_altitude_ft, max_altitude_ft FROM long_enough {_LIMITED}")
def hold_limits(spark, d):
    """Holds within limits of span and level that others exceed."""
    found = holds.to_flight_holds(_obs(spark, d), flights.movement_pivot(_moves(spark, d)), fx.airports(spark, d), fx.NARROW)
    return found.select("flight_id", "hold_seq", "hold_start", "span_km", "min_altitude_ft", "max_altitude_ft")


def _quantiles(column: str, name: str) -> str:
    return ", ".join(f"quantile_disc({column}, {q}) AS {name}_p{int(q * 100)}" for q in (0.5, 0.9))


_SHAPE = {"duration": "duration_seconds", "span": "span_km", "circuits": "circuits", "altitude": "mean_altitude_ft"}


@query(f"WITH {fx.HOLDS_SQL} SELECT COUNT(*) AS holds, {', '.join(_quantiles(c, n) for n, c in _SHAPE.items())}, round(100.0 * COUNT(arrival_airport_ident) / COUNT(*), 1) AS with_arrival_pct FROM holds")
def hold_shape(spark, d):
    q = [F.col(n)[i].alias(f"{n}_p{p}") for n in _SHAPE for i, p in enumerate((50, 90))]
    return holds.hold_shape(_holds(spark, d)).select("holds", *q, "with_arrival_pct")


@query(f"""WITH {fx.HOLDS_SQL}, far AS (SELECT distance_to_arrival_airport_km + CAST(hour(hold_start) % 3 * 75 AS DOUBLE) AS km FROM holds)
SELECT CASE WHEN km IS NULL THEN 'airport unknown' WHEN km < 50 THEN 'terminal area (<50 km)' WHEN km < 150 THEN 'near (50-150 km)' ELSE 'en route (>150 km)' END AS where_held, COUNT(*) AS holds FROM far GROUP BY 1""")
def hold_distance_buckets(spark, d):
    """The fixture's holds all lie near their airport, so that some are moved away from it first."""
    moved = _holds(spark, d).withColumn("distance_to_arrival_airport_km", F.col("distance_to_arrival_airport_km") + F.hour("hold_start") % 3 * 75)
    return holds.hold_distance_buckets(moved)


@query("""WITH g AS (SELECT user_id, event_type, ts, event_id, CASE WHEN event_type = LAG(event_type) OVER w THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
r AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run_no FROM g)
SELECT user_id, CAST(run_no AS BIGINT) AS run_no, MAX(event_type) AS event_type, COUNT(*) AS n FROM r GROUP BY 1, 2""")
def run_collapse_event_type(spark, d):
    df = timewin.number_runs(fx.table(spark, d, "events"), "user_id", "ts", "event_type")
    return df.groupBy("user_id", "run_no").agg(F.max("event_type").alias("event_type"), F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 43200 PRECEDING AND 43200 FOLLOWING), 6) AS smooth FROM events""")
def range_smooth_value(spark, d):
    e = fx.table(spark, d, "events").withColumn("sec", F.unix_timestamp("ts"))
    return e.select("event_id", F.round(F.avg("value").over(timewin.around("user_id", "sec", 43_200)), 6).alias("smooth"))


# ---- as-of, intervals, thinning ----------------------------------------------------------------------------


@query(f"WITH {fx.PHASES_SQL} SELECT l.flight_id, l.observation_seq, COALESCE(CASE WHEN l.event_time <= p.end_time THEN p.phase END, 'unknown') AS phase FROM labelled l ASOF LEFT JOIN phases p ON l.flight_id = p.flight_id AND l.event_time >= p.start_time")
def asof_phase(spark, d):
    o = _obs(spark, d).select("flight_id", "observation_seq", "event_time")
    return explore.label_points_with_phase(o, _phases(spark, d)).select("flight_id", "observation_seq", "phase")


@query(f"WITH {fx.HOLDS_SQL} SELECT o.flight_id, o.observation_seq FROM obs o WHERE EXISTS (SELECT 1 FROM holds h WHERE h.flight_id = o.flight_id AND o.event_time BETWEEN h.hold_start AND h.hold_end)")
def interval_points_in_holds(spark, d):
    return explore.points_in_holds(_obs(spark, d), _holds(spark, d)).select("flight_id", "observation_seq")


@query(f"WITH {fx.HOLDS_SQL} SELECT flight_id, observation_seq, event_time FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY flight_id, sec // 21600 ORDER BY observation_seq) AS r FROM obs WHERE flight_id IN (SELECT flight_id FROM holds)) WHERE r = 1")
def thin_time_bucket(spark, d):
    return explore.track_sample(_obs(spark, d), _holds(spark, d), 21_600).select("flight_id", "observation_seq", "event_time")


# ---- explorer and reports ----------------------------------------------------------------------------------


@query(f"WITH {fx.HOLDS_SQL}, h AS (SELECT CAST(unnest(range(24)) AS INTEGER) AS hour) SELECT h.hour, (SELECT COUNT(*) FROM flights WHERE departure_airport_iata = 'NAT' AND hour(departure_time) = h.hour) AS departures, (SELECT COUNT(*) FROM flights WHERE arrival_airport_iata = 'NAT' AND hour(arrival_time) = h.hour) AS arrivals FROM h")
def hourly_spine(spark, d):
    return explore.hourly_traffic(_flights(spark, d), "NAT")


@query(f"""WITH {fx.BASE_SQL}, c AS (SELECT registration AS value, COUNT(*) AS flights FROM base WHERE registration IS NOT NULL GROUP BY 1), r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY flights DESC, value) AS rn FROM c)
SELECT value, flights FROM r WHERE rn <= 8 UNION ALL SELECT 'Other (' || COUNT(*) || ')', CAST(SUM(flights) AS BIGINT) FROM r WHERE rn > 8 HAVING COUNT(*) > 0""")
def topn_folded_other(spark, d):
    return explore.distribution(_base(spark, d), "registration", 8)


@query(f"WITH {fx.HOLDS_SQL} SELECT flight_id, icao, callsign FROM flights WHERE airline_icao = 'SWR' AND aircraft_type = 'T1' AND (upper(COALESCE(callsign, '')) LIKE '%R1%' OR upper(COALESCE(icao, '')) LIKE '%R1%')")
def select_flights_filters(spark, d):
    return explore.select_flights(_flights(spark, d), airline="SWR", aircraft_type="T1", callsign=" r1 ").select("flight_id", "icao", "callsign")


@query(f"WITH {fx.HOLDS_SQL} SELECT departure_airport_ident AS value, CAST(CASE departure_airport_ident WHEN 'A007' THEN 1 WHEN 'A003' THEN 2 ELSE 3 END AS INTEGER) AS rank FROM flights WHERE departure_airport_ident IS NOT NULL GROUP BY 1")
def filter_options(spark, d):
    return explore.options_for(_flights(spark, d), "departure_airport_ident", ("A007", "A003")).select("value", "rank")


@query(f"WITH {fx.HOLDS_SQL} SELECT flight_id FROM flights WHERE departure_airport_iata = 'NAT' OR arrival_airport_iata = 'NAT'")
def airport_touching_flights(spark, d):
    return explore.airport_flights(_flights(spark, d), "NAT").select("flight_id")


@query(f"WITH {fx.HOLDS_SQL} SELECT COUNT(*) AS flights, COUNT(DISTINCT icao) AS aircraft, COUNT(DISTINCT airline_icao) AS airlines, COUNT(DISTINCT aircraft_type) AS aircraft_types, COUNT(*) FILTER (WHERE has_detected_hold) AS with_holds FROM flights")
def explorer_kpis(spark, d):
    return explore.explorer_kpis(_flights(spark, d))


@query(f"WITH {fx.HOLDS_SQL} SELECT CAST(SUM(total_operations) AS BIGINT) AS operations, CAST(SUM(arrivals) AS BIGINT) AS arrivals, CAST(SUM(departures) AS BIGINT) AS departures, CAST(SUM(flights_with_detected_holds) AS BIGINT) AS holding_flights, round(SUM(flights_with_detected_holds) / SUM(arrivals), 6) AS hold_share, round(AVG(round(ad)), 6) AS mean_hold_seconds FROM ops_h WHERE airport_ident = 'A003'")
def airport_kpis(spark, d):
    return explore.airport_kpis(movements.to_airport_operations(_moves(spark, d), _holds(spark, d)), "A003")


@query(f"""WITH {fx.HOLDS_SQL} SELECT flight_id, COALESCE(callsign, icao) AS callsign, COALESCE(departure_airport_iata, '—') AS dep,
CASE WHEN duration_seconds >= 3600 THEN (duration_seconds // 3600) || 'h ' || lpad(CAST(duration_seconds % 3600 // 60 AS VARCHAR), 2, '0') || 'm'
WHEN duration_seconds >= 60 THEN (duration_seconds // 60) || 'm ' || lpad(CAST(duration_seconds % 60 AS VARCHAR), 2, '0') || 's' ELSE duration_seconds || 's' END AS duration,
COALESCE(strftime(departure_time, '%H:%M'), '—') AS clock FROM flights""")
def flight_board(spark, d):
    return _flights(spark, d).select(
        "flight_id", text_or("callsign", F.col("icao")).alias("callsign"), text_or("departure_airport_iata").alias("dep"), duration_text("duration_seconds").alias("duration"), clock_text("departure_time").alias("clock")
    )


@query(f"WITH {fx.HOLDS_SQL} SELECT flight_id, observation_seq, event_time FROM obs WHERE release_date IN (DATE '2024-01-03', DATE '2024-01-04') AND flight_id IN (SELECT MIN(flight_id) FROM flights UNION ALL SELECT MAX(flight_id) FROM flights)")
def trajectory_fetch(spark, d):
    from strider.sources.readers import load_trajectories

    o = _obs(spark, d)
    ends = o.agg(F.min("flight_id"), F.max("flight_id")).first()
    return load_trajectories(o, list(ends), ["2024-01-03", "2024-01-04"]).select("flight_id", "observation_seq", "event_time")


@query(f"WITH {fx.MOVES_SQL} SELECT flight_id, movement_type, event_time AS movement_time, ident AS airport_ident, iata_code AS airport_iata, airport_name, iso_country, round(distance_km, 2) AS distance_km, release_date, '{explore.TRACK_DATA_SOURCE}' AS data_source FROM moves")
def report_movements(spark, d):
    return explore.with_source(explore.report_movements(_moves(spark, d)))


@query(f"""WITH {fx.HOLDS_SQL} SELECT (SELECT COUNT(*) FROM moves) AS operations, (SELECT COUNT(*) FROM moves WHERE movement_type = 'arrival') AS arrivals, (SELECT COUNT(*) FROM moves WHERE movement_type = 'departure') AS departures,
(SELECT COUNT(DISTINCT icao) FROM flights) AS unique_aircraft, (SELECT COUNT(*) FROM flights) AS flights, COUNT(*) AS detected_holds, COUNT(DISTINCT flight_id) AS flights_with_holds, round(AVG(duration_seconds), 6) AS avg_hold_seconds,
CAST(SUM(duration_seconds) AS BIGINT) AS total_hold_seconds, round(AVG(circuits), 6) AS avg_circuits, round(COUNT(DISTINCT flight_id) / (SELECT COUNT(*) FROM moves WHERE movement_type = 'arrival'), 6) AS hold_rate FROM holds""")
def report_measures(spark, d):
    return explore.measures(_moves(spark, d), _flights(spark, d), _holds(spark, d))


@query(f"WITH {fx.MOVES_SQL} SELECT CAST(hour(event_time) AS INTEGER) AS hour, COUNT(*) FILTER (WHERE movement_type = 'departure') AS departure, COUNT(*) FILTER (WHERE movement_type = 'arrival') AS arrival FROM moves GROUP BY 1")
def hourly_by_direction(spark, d):
    return explore.hourly_by_direction(_moves(spark, d))


@query(f"WITH {fx.HOLDS_SQL} SELECT airline_icao, COUNT(*) AS flights FROM flights WHERE airline_icao IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def airline_top(spark, d):
    return explore.airline_top(_flights(spark, d))


@query(f"WITH {fx.HOLDS_SQL} SELECT airline_icao, aircraft_type, COUNT(*) AS flights FROM flights WHERE airline_icao IS NOT NULL AND aircraft_type IS NOT NULL GROUP BY 1, 2")
def airline_type_matrix(spark, d):
    return explore.airline_type_matrix(_flights(spark, d))


@query(f"WITH {fx.BASE_SQL} SELECT aircraft_type, COUNT(*) AS flights, COUNT(DISTINCT icao) AS aircraft, CAST(SUM(duration_seconds) AS BIGINT) AS seconds FROM base GROUP BY 1")
def aircraft_usage(spark, d):
    return explore.aircraft_usage(_base(spark, d))


@query(f"WITH {fx.HOLDS_SQL} SELECT duration_seconds // 3600 * 3600 AS from_seconds, COUNT(*) AS holds FROM holds GROUP BY 1")
def duration_histogram(spark, d):
    return explore.duration_histogram(_holds(spark, d), 3600)


@query(f"WITH {fx.HOLDS_SQL} SELECT arrival_airport_ident, COUNT(*) AS holds, round(avg(circuits), 6) AS avg_circuits, round(avg(duration_seconds), 6) AS avg_seconds FROM holds GROUP BY 1")
def circuits_by_airport(spark, d):
    return explore.circuits_by_airport(_holds(spark, d))


@query(f"WITH {fx.OBS_SQL} SELECT COUNT(DISTINCT icao) AS aircraft, COUNT(DISTINCT callsign) AS callsigns, MIN(event_time) AS first_seen, MAX(event_time) AS last_seen FROM obs")
def profile_totals(spark, d):
    return explore.profile_totals(_obs(spark, d))


@query(f"WITH {fx.OBS_SQL} SELECT on_ground, COUNT(*) AS reports, round(AVG(altitude_ft), 0) AS avg_altitude_ft FROM obs GROUP BY 1")
def profile_by_ground(spark, d):
    return explore.profile_by_ground(_obs(spark, d))


@query(f"WITH {fx.OBS_SQL} SELECT {', '.join(f'round({e}, 6) AS {n}' for e, n in (('MIN(latitude)', 'south'), ('MAX(latitude)', 'north'), ('MIN(longitude)', 'west'), ('MAX(longitude)', 'east'), ('(MIN(latitude) + MAX(latitude)) / 2', 'mid_latitude'), ('(MIN(longitude) + MAX(longitude)) / 2', 'mid_longitude')))} FROM obs")
def map_frame(spark, d):
    return rounded(explore.map_frame(_obs(spark, d)), "south", "north", "west", "east", "mid_latitude", "mid_longitude")


@query(f"WITH {fx.OBS_SQL} SELECT aircraft_type, COUNT(*) AS reports, COUNT(DISTINCT icao) AS aircraft, MAX(altitude_ft) AS max_altitude_ft FROM obs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def profile_by_type(spark, d):
    return explore.profile_by_type(_obs(spark, d))


@query(f"WITH {fx.OBS_SQL} SELECT icao, callsign, aircraft_type, event_time, ground_speed_kt, altitude_ft FROM obs WHERE NOT on_ground ORDER BY ground_speed_kt DESC NULLS LAST, icao, event_time LIMIT 5")
def topk_fastest(spark, d):
    return explore.fastest(_obs(spark, d))


@query(f"WITH {fx.BASE_SQL}, {fx.AIRPORTS_SQL} SELECT count(*) AS pairs, round(sum({fx.km_sql('b.first_latitude', 'b.first_longitude', 'a.latitude_deg', 'a.longitude_deg')}), 2) AS km FROM base b JOIN airports a ON a.ident = 'A' || lpad(CAST(CAST(ltrim(b.icao, '~u') AS BIGINT) % 25 AS VARCHAR), 3, '0')")
def haversine_pairs(spark, d):
    b = _base(spark, d).withColumn("ident", F.concat(F.lit("A"), F.lpad((F.ltrim("icao", F.lit("~u")).cast("long") % 25).cast("string"), 3, "0")))
    a = fx.airports(spark, d)
    km = haversine_km(F.col("first_latitude"), F.col("first_longitude"), F.col("latitude_deg"), F.col("longitude_deg"))
    return b.join(a, "ident").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.sum(km), 2).alias("km"))


@query(f"WITH {fx.OBS_SQL} SELECT flight_id, COUNT(*) AS n FROM obs WHERE latitude BETWEEN 41 AND 42 AND longitude BETWEEN 6 AND 8 GROUP BY 1")
def box_filter(spark, d):
    return _obs(spark, d).where(in_any_box([(41.0, 42.0, 6.0, 8.0)], F.col("latitude"), F.col("longitude"))).groupBy("flight_id").agg(F.count(F.lit(1)).alias("n"))


# ---- quality -----------------------------------------------------------------------------------------------


def _rules_sql(rules: dict, source: str, with_sql: str) -> str:
    def duck(rule: str) -> str:
        rule = rule.replace("flight_id LIKE CONCAT(icao, '_%')", "flight_id LIKE icao || '_%'").replace("DATE(", "date_trunc('day', ")
        rule = re.sub(r"UNIX_TIMESTAMP\((\w+)\)", r"CAST(floor(epoch(\1)) AS BIGINT)", rule)
        return rule.replace("airline_icao RLIKE '^[A-Z]{3}$'", "regexp_matches(airline_icao, '^[A-Z]{3}$')")

    each = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", COUNT(*) FILTER (WHERE {duck(r)}) AS failures FROM {source}" for n, r in rules.items())
    return f"WITH {with_sql}, s AS (SELECT * FROM {source}) {each.replace(f'FROM {source}', 'FROM s')}"


def _spoiled(df: DataFrame, spoil: dict) -> DataFrame:
    """The frame with some columns given by expressions that both engines read, each over the columns as they were."""
    return df.select(*[F.expr(spoil[c]).alias(c) if c in spoil else F.col(c) for c in df.columns])


def _spoiled_sql(source: str, spoil: dict) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in spoil.items())}) FROM ({source})"


def _some(column: str, every: str, **bad: str) -> str:
    """A column that takes the values `bad` (v0, v1, ...) in the rows where `every` is 0, 1, ..., and stays elsewhere."""
    return f"CASE {every} " + " ".join(f"WHEN {n[1:]} THEN {v}" for n, v in bad.items()) + f" ELSE {column} END"


# What is broken in each table, so that every rule has rows to find.
_N = "observation_seq % 13"
_BAD_OBSERVATIONS = {
    "flight_id": _some("flight_id", _N, v0="''", v1="NULL", v2="'zz'"), "icao": _some("icao", _N, v3="''", v4="NULL"), "is_icao_address": _some("is_icao_address", _N, v5="NULL"),
    "event_time": _some("event_time", _N, v6="NULL"), "observation_seq": _some("observation_seq", _N, v7="0"), "latitude": _some("latitude", _N, v8="95", v9="NULL", v10="0"),
    "longitude": _some("longitude", _N, v8="-181", v10="0"), "ground_speed_kt": _some("ground_speed_kt", _N, v11="701"), "vertical_rate_fpm": _some("vertical_rate_fpm", _N, v11="-20001"),
    "callsign": _some("callsign", _N, v12="''"), "release_tag": _some("release_tag", _N, v0="''", v1="NULL"), "release_date": _some("release_date", _N, v1="NULL", v2="DATE '2001-01-01'"),
}
_N = "minute(event_time) % 7"
_BAD_MOVEMENTS = {
    "flight_id": _some("flight_id", _N, v0="''"), "movement_type": _some("movement_type", _N, v1="'both'"), "ident": _some("ident", _N, v2="NULL"), "event_time": _some("event_time", _N, v3="NULL"),
    "distance_km": _some("distance_km", _N, v4="50.5"), "latitude": _some("latitude", _N, v5="-90.5"), "longitude": _some("longitude", _N, v6="180.5"),
}
_N = "minute(first_seen_time) % 15"
_BAD_FLIGHTS = {
    "flight_id": _some("flight_id", _N, v0="NULL"), "flight_date": _some("flight_date", _N, v1="NULL", v2="DATE '2001-01-01'"), "icao": _some("icao", _N, v3="''"), "last_seen_time": _some("last_seen_time", _N, v4="TIMESTAMP '2001-01-01 00:00:00'"),
    "duration_seconds": _some("duration_seconds", _N, v5="-1"), "n_observations": _some("n_observations", _N, v6="0"), "first_latitude": _some("first_latitude", _N, v7="91"), "last_latitude": _some("last_latitude", _N, v8="-91"),
    "first_longitude": _some("first_longitude", _N, v7="181"), "last_longitude": _some("last_longitude", _N, v8="-181"), "airline_icao": _some("airline_icao", _N, v9="'sw'"),
    "departure_distance_km": _some("departure_distance_km", _N, v10="51"), "arrival_time": _some("arrival_time", _N, v11="NULL"), "arrival_airport_ident": _some("arrival_airport_ident", _N, v11="'A001'"),
    "has_detected_hold": _some("has_detected_hold", _N, v12="NOT has_detected_hold"), "n_detected_holds": _some("n_detected_holds", _N, v13="-1"), "total_hold_seconds": _some("total_hold_seconds", _N, v14="CASE WHEN n_detected_holds = 0 THEN 5 ELSE -5 END"),
}
_N = "minute(start_time) % 9"
_BAD_PHASES = {
    "flight_id": _some("flight_id", _N, v0="''"), "phase": _some("phase", _N, v1="'hover'", v8="'taxi'"), "start_time": _some("start_time", _N, v2="NULL"), "end_time": _some("end_time", _N, v3="NULL", v4="TIMESTAMP '2001-01-01 00:00:00'"),
    "duration_seconds": _some("duration_seconds", _N, v5="-1"), "n_observations": _some("n_observations", _N, v6="0"), "phase_seq": _some("phase_seq", _N, v7="0"), "max_altitude_ft": _some("max_altitude_ft", _N, v8="100"),
}
_N = "minute(hold_start) % 11"
_BAD_HOLDS = {
    "flight_id": _some("flight_id", _N, v0="NULL"), "hold_start": _some("hold_start", _N, v1="NULL"), "hold_end": _some("hold_end", _N, v2="NULL", v3="TIMESTAMP '2001-01-01 00:00:00'"), "duration_seconds": _some("duration_seconds", _N, v4="239"),
    "span_km": _some("span_km", _N, v5="25.5"), "circuits": _some("circuits", _N, v6="0.9"), "max_altitude_ft": _some("max_altitude_ft", _N, v7="min_altitude_ft + 4001"),
    "centroid_latitude": _some("centroid_latitude", _N, v8="91"), "centroid_longitude": _some("centroid_longitude", _N, v9="-181"), "hold_seq": _some("hold_seq", _N, v10="0"),
}
_N = "minute(first_operation_time) % 12"
_BAD_OPERATIONS = {
    "operations_date": _some("operations_date", _N, v0="NULL", v1="DATE '2001-01-01'"), "airport_ident": _some("airport_ident", _N, v2="''"), "total_operations": _some("total_operations", _N, v3="0"), "arrivals": _some("arrivals", _N, v4="-1"),
    "unique_aircraft": _some("unique_aircraft", _N, v5="0", v6="1000000"), "airport_latitude": _some("airport_latitude", _N, v7="91"), "airport_longitude": _some("airport_longitude", _N, v7="-181"),
    "last_operation_time": _some("last_operation_time", _N, v8="TIMESTAMP '2001-01-01 00:00:00'"), "metric_source": _some("metric_source", _N, v9="'official'"),
    "flights_with_detected_holds": _some("flights_with_detected_holds", _N, v10="1000000"), "hold_rate": _some("hold_rate", _N, v11="1.5"),
}


@query(_rules_sql(quality.OBSERVATION_RULES, "bad", f"{fx.OBS_SQL}, bad AS ({_spoiled_sql('FROM obs', _BAD_OBSERVATIONS)})"))
def quality_violations(spark, d):
    return quality.violations(_spoiled(_obs(spark, d), _BAD_OBSERVATIONS), quality.OBSERVATION_RULES)


@query(_rules_sql(quality.MOVEMENT_RULES, "bad", f"{fx.MOVES_SQL}, bad AS ({_spoiled_sql('FROM moves', _BAD_MOVEMENTS)})"))
def quality_movements(spark, d):
    return quality.violations(_spoiled(_moves(spark, d), _BAD_MOVEMENTS), quality.MOVEMENT_RULES)


@query(_rules_sql(quality.FLIGHT_RULES, "bad", f"{fx.HOLDS_SQL}, bad AS ({_spoiled_sql('FROM flights', _BAD_FLIGHTS)})"))
def quality_flights(spark, d):
    return quality.violations(_spoiled(_flights(spark, d), _BAD_FLIGHTS), quality.FLIGHT_RULES)


_NUMBERED = "SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY flight_id ORDER BY start_time) AS INTEGER) AS phase_seq FROM phases"


@query(_rules_sql(quality.FLIGHT_PHASE_RULES, "bad", f"{fx.PHASES_SQL}, bad AS ({_spoiled_sql(_NUMBERED, _BAD_PHASES)})"))
def quality_phases(spark, d):
    return quality.violations(_spoiled(_phases(spark, d), _BAD_PHASES), quality.FLIGHT_PHASE_RULES)


@query(_rules_sql(quality.FLIGHT_HOLD_RULES, "bad", f"{fx.HOLDS_SQL}, bad AS ({_spoiled_sql('FROM holds', _BAD_HOLDS)})"))
def quality_holds(spark, d):
    return quality.violations(_spoiled(_holds(spark, d), _BAD_HOLDS), quality.FLIGHT_HOLD_RULES)


@query(_rules_sql(quality.AIRPORT_OPERATION_RULES, "bad", f"{fx.HOLDS_SQL}, bad AS ({_spoiled_sql('FROM ops_h', _BAD_OPERATIONS)})"))
def quality_operations(spark, d):
    ops = movements.to_airport_operations(_moves(spark, d), _holds(spark, d))
    return quality.violations(_spoiled(ops, _BAD_OPERATIONS), quality.AIRPORT_OPERATION_RULES)


@query("SELECT CAST(SUM(n - 1) AS BIGINT) AS surplus FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def uniqueness_surplus(spark, d):
    return quality.surplus(fx.table(spark, d, "lineitem"), ("l_orderkey", "l_linenumber"))


@query(f"WITH {fx.BASE_SQL} SELECT (SELECT COUNT(*) FROM obs) AS observations, CAST(SUM(n_observations) AS BIGINT) AS in_flights FROM base")
def conservation(spark, d):
    o = _obs(spark, d)
    n = o.agg(F.count(F.lit(1)).alias("observations")).withColumn("k", F.lit(1))
    return n.join(flights.aggregate_flights(o).agg(F.sum("n_observations").alias("in_flights")).withColumn("k", F.lit(1)), "k").drop("k")


@query(f"WITH {fx.HOLDS_SQL} SELECT COUNT(*) AS flights, round(100.0 * COUNT(callsign) / COUNT(*), 1) AS callsign_pct, round(100.0 * COUNT(arrival_airport_ident) / COUNT(*), 1) AS arrival_airport_ident_pct, COUNT(*) FILTER (WHERE n_callsigns > 1) AS several_callsigns FROM flights")
def coverage_pct(spark, d):
    return flights.attribute_coverage(_flights(spark, d), ("callsign", "arrival_airport_ident"))


@query(f"WITH {fx.BASE_SQL} SELECT flight_id, 'both' AS side, 'max_altitude_ft' AS columns FROM base WHERE n_observations % 7 = 0 UNION ALL SELECT flight_id, 'left', NULL FROM base WHERE n_observations % 7 = 1")
def table_diff(spark, d):
    b = _base(spark, d).select("flight_id", "n_observations", "max_altitude_ft")
    other = b.withColumn("max_altitude_ft", F.when(F.col("n_observations") % 7 == 0, F.coalesce("max_altitude_ft", F.lit(0.0)) + 1).otherwise(F.col("max_altitude_ft")))
    other = other.where("n_observations % 7 <> 1")
    return explore.table_diff(b, other, ("flight_id",)).select("flight_id", "side", F.array_join("columns", ",").alias("columns"))


# ---- the first dashboard -----------------------------------------------------------------------------------


def _states(spark, d) -> DataFrame:
    """State vectors by callsign (one a user) from the events."""
    k = F.get_json_object("props", "$.k").cast("int")
    u = F.col("user_id")
    return fx.table(spark, d, "events").select(
        F.col("ts").alias("timestamp"), (47 + k * 0.01).alias("latitude"), (8 + k * 0.01).alias("longitude"), F.floor(F.col("value") * 100).cast("double").alias("altitude"),
        (k * 7 % 900).cast("double").alias("groundspeed"), (k - 50).cast("double").alias("vertical_rate"), F.concat(F.lit("SWR"), u.cast("string")).alias("callsign"),
        (F.col("event_type") == "signup").alias("on_ground"), F.concat(F.lit("AL"), (u % 6).cast("string")).alias("airline"),
    )


_STATES_SQL = """s0 AS (SELECT ts AS timestamp, CAST(47 AS DOUBLE) + k * CAST(0.01 AS DOUBLE) AS latitude, CAST(8 AS DOUBLE) + k * CAST(0.01 AS DOUBLE) AS longitude, CAST(floor(value * 100) AS DOUBLE) AS altitude, CAST(k * 7 % 900 AS DOUBLE) AS groundspeed,
  CAST(k - 50 AS DOUBLE) AS vertical_rate, 'SWR' || user_id AS callsign, event_type = 'signup' AS on_ground, 'AL' || (user_id % 6) AS airline FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)),
s1 AS (SELECT *, epoch_us(timestamp) / 1e6 - LAG(epoch_us(timestamp) / 1e6) OVER w AS dt, sqrt(pow(latitude - LAG(latitude) OVER w, 2) + pow(longitude - LAG(longitude) OVER w, 2)) AS deg, abs(altitude - LAG(altitude) OVER w) AS alt
  FROM s0 WHERE altitude > -1500 AND altitude < 60000 AND groundspeed >= 0 AND groundspeed < 800 WINDOW w AS (PARTITION BY callsign ORDER BY timestamp)),
s2 AS (SELECT * FROM s1 WHERE dt IS NULL OR dt > 3600 OR (deg / dt < 0.003 AND alt / dt < 150)),
s3 AS (SELECT *, AVG(vertical_rate) OVER (PARTITION BY callsign ORDER BY timestamp ROWS 39 PRECEDING) AS climb FROM s2),
states AS (SELECT *, CASE WHEN on_ground OR (altitude < 600 AND groundspeed < 50) THEN 'TAXI' WHEN climb > 8.3 THEN 'CLIMB' WHEN climb < -8.3 THEN 'DESCENT' WHEN altitude < 18000 THEN 'LEVEL_OFF' ELSE 'CRUISE' END AS phase FROM s3),
g AS (SELECT *, CASE WHEN epoch_us(timestamp) / 1e6 - LAG(epoch_us(timestamp) / 1e6) OVER w <= 86400 AND phase = LAG(phase) OVER w THEN 0 ELSE 1 END AS fresh FROM states WINDOW w AS (PARTITION BY callsign ORDER BY timestamp)),
segs AS (SELECT *, SUM(fresh) OVER (PARTITION BY callsign ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS segment_id FROM g)"""


@query(f"WITH {_STATES_SQL} SELECT callsign, timestamp, phase FROM states")
def legacy_rolling_phase(spark, d):
    return legacy.detect_phases(_states(spark, d)).select("callsign", "timestamp", "phase")


@query(f"WITH {_STATES_SQL} SELECT callsign, CAST(segment_id AS BIGINT) AS segment_id, MAX(phase) AS phase, COUNT(*) AS n FROM segs GROUP BY 1, 2")
def legacy_segments(spark, d):
    df = legacy.segments(legacy.detect_phases(_states(spark, d)), 86_400)
    return df.groupBy("callsign", "segment_id").agg(F.max("phase").alias("phase"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_STATES_SQL}, e AS (SELECT callsign, arg_min(latitude, timestamp) AS la, arg_min(longitude, timestamp) AS lo, arg_min(altitude, timestamp) AS al, arg_max(latitude, timestamp) AS lb, arg_max(longitude, timestamp) AS lob, arg_max(altitude, timestamp) AS alb FROM s0 GROUP BY 1),
f AS (SELECT *, la > 47.205 AND la < 47.705 AND lo > 8.205 AND lo < 8.705 AS si, lb > 47.205 AND lb < 47.705 AND lob > 8.205 AND lob < 8.705 AS ei, alb - al AS rise FROM e)
SELECT callsign, CASE WHEN si AND NOT ei THEN 'DEPARTURE' WHEN ei AND NOT si THEN 'ARRIVAL' WHEN si THEN CASE WHEN rise > 500 THEN 'DEPARTURE' WHEN rise < -500 THEN 'ARRIVAL' ELSE 'UNKNOWN' END
WHEN pow(la - 47.46, 2) + pow(lo - 8.55, 2) < 0.04 AND rise > 2000 THEN 'DEPARTURE' ELSE 'OVERFLIGHT' END AS direction FROM f""")
def legacy_direction(spark, d):
    return legacy.classify_direction(_states(spark, d), (47.205, 8.205, 47.705, 8.705))


@query(f"WITH {_STATES_SQL}, h AS (SELECT CAST(unnest(range(24)) AS INTEGER) AS hour) SELECT h.hour, COUNT(DISTINCT callsign) AS flight_count FROM h LEFT JOIN s0 ON hour(s0.timestamp) = h.hour GROUP BY 1")
def legacy_hourly(spark, d):
    return legacy.hourly_callsigns(_states(spark, d))


@query(f"WITH {_STATES_SQL}, t AS (SELECT airline, callsign, (epoch_us(MAX(timestamp)) - epoch_us(MIN(timestamp))) / 60e6 AS m FROM states WHERE phase = 'TAXI' GROUP BY 1, 2) SELECT airline, round(AVG(m), 4) AS avg_taxi, COUNT(DISTINCT callsign) AS flight_count FROM t GROUP BY 1 HAVING COUNT(DISTINCT callsign) > 2")
def airline_efficiency(spark, d):
    return legacy.airline_efficiency(legacy.detect_phases(_states(spark, d)))


@query(f"WITH {_STATES_SQL}, m AS (SELECT callsign, CAST(segment_id AS BIGINT) AS segment_id, round((epoch_us(MAX(timestamp)) - epoch_us(MIN(timestamp))) / 60e6, 6) AS minutes FROM segs WHERE phase = 'TAXI' GROUP BY 1, 2) SELECT * FROM m WHERE minutes > 1 AND minutes < 1440")
def legacy_taxi_minutes(spark, d):
    return legacy.taxi_minutes(legacy.detect_phases(_states(spark, d)), gap_seconds=86_400, below=1440)


@query(f"WITH {_STATES_SQL} SELECT callsign, COUNT(*) AS seconds FROM states WHERE phase = 'LEVEL_OFF' GROUP BY 1 HAVING COUNT(*) > 30 ORDER BY 2 DESC, 1 LIMIT 15")
def legacy_level_offs(spark, d):
    return legacy.longest_level_offs(legacy.detect_phases(_states(spark, d)))


@query(f"WITH {_STATES_SQL} SELECT COUNT(DISTINCT callsign) AS flights, round(100.0 * COUNT(DISTINCT CASE WHEN phase = 'LEVEL_OFF' THEN callsign END) / COUNT(DISTINCT callsign), 1) AS level_off_pct FROM states")
def legacy_level_off_share(spark, d):
    return legacy.level_off_share(legacy.detect_phases(_states(spark, d)))


# ---- relational core on the star schema --------------------------------------------------------------------


@query("""SELECT n_name, round(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue, COUNT(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def revenue_by_nation(spark, d):
    t = lambda n: fx.table(spark, d, n)
    df = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    df = df.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("lines"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 2""")
def topk_per_group(spark, d):
    w = W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return fx.table(spark, d, "orders").withColumn("r", F.row_number().over(w)).where("r <= 2").select("o_custkey", "o_orderkey", "o_totalprice")


