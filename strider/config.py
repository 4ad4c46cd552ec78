"""The thresholds that give the operators their meaning, in one place."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the data model.
PHASES = ("taxi_out", "climb", "cruise", "descent", "taxi_in", "taxi", "unknown")
KEPT_AIRPORT_TYPES = ("large_airport", "medium_airport")
EARTH_RADIUS_KM = 6371.0
HOLD_KM_PER_DEGREE = 111.32  # holds measure their span with this rounder constant
AIRLINE_CALLSIGN = r"^[A-Z]{3}[0-9][0-9A-Z]*$"
METRIC_SOURCE = "adsb_inferred"
TRACK_DATA_SOURCE = "ADS-B derived (adsb.lol) - not official airline or ATC data"
PUBLISHED_TABLES = ("observations", "flights", "movements", "flight_phases", "flight_holds", "airport_daily_operations")


@dataclass(frozen=True)
class Thresholds:
    """Every number an operator takes; pass a changed copy instead of changing defaults."""

    max_ground_speed_kt: float = 700
    max_vertical_rate_fpm: float = 20000
    gap_seconds: int = 900
    match_radius_km: float = 5.0
    max_height_ft: float = 5000.0
    level_band_fpm: float = 300.0
    smoothing_seconds: int = 60
    turn_window_seconds: int = 360
    min_turn_degrees: float = 360.0
    max_step_gap_seconds: int = 60
    min_hold_seconds: int = 240
    max_span_km: float = 25.0
    max_altitude_range_ft: float = 4000.0
    track_sample_seconds: int = 30


DEFAULTS = Thresholds()
