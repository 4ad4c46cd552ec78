"""The first dashboard's operators: state vectors by callsign, row-window phases, segments and their charts' figures."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.sources import schemas

FEET, KNOTS = 3.28084, 1.94384  # per metre, per metre a second


def read_states(spark, path: str) -> DataFrame:
    """State-vector CSV without a header, all text."""
    return spark.read.schema(schemas.LEGACY_STATES).csv(path)


def to_states(raw: DataFrame) -> DataFrame:
    """Typed states of airline flights: stray header lines, incomplete rows and other callsigns go; units turn imperial."""
    names = {"time": "timestamp", "lon": "longitude", "lat": "latitude", "baroaltitude": "altitude", "velocity": "groundspeed", "vertrate": "vertical_rate"}
    df = raw.where(~F.col("time").eqNullSafe("time")).select(
        *[F.col(c).try_cast("double").alias(n) for c, n in names.items()], "icao24", F.trim(F.coalesce("callsign", F.lit(""))).alias("callsign"), (F.lower("on_ground") == "true").alias("on_ground")
    )
    df = df.dropna(subset=[*names.values(), "icao24"]).withColumn("airline", F.upper(F.substring("callsign", 1, 3))).where(F.col("airline").rlike("^[A-Z]{3}$"))
    return df.withColumns(
        {
            "altitude": F.col("altitude") * FEET, "vertical_rate": F.col("vertical_rate") * FEET, "groundspeed": F.col("groundspeed") * KNOTS,
            "timestamp": F.timestamp_micros(F.round(F.col("timestamp") * 1_000_000).cast("long")), "on_ground": F.coalesce("on_ground", F.lit(False)),
        }
    )


def load_data(spark, path: str, **filters) -> DataFrame:
    """Parquet with IN filters pushed down; a missing path gives an empty frame."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "timestamp timestamp")
    for column, values in filters.items():
        df = df.where(F.col(column).isin(list(values)))
    return df


def clean_states(df: DataFrame, by: str = "callsign") -> DataFrame:
    """Drop incomplete and impossible rows, and rows that jump from the one before (gaps over an hour excuse a jump)."""
    df = df.dropna(subset=["latitude", "longitude", "altitude", "timestamp"])
    df = df.where((F.col("altitude") > -1500) & (F.col("altitude") < 60000) & (F.col("groundspeed") >= 0) & (F.col("groundspeed") < 800))
    w = W.partitionBy(by).orderBy("timestamp")
    change = lambda c: F.col(c) - F.lag(c).over(w)
    t = F.unix_micros(F.col("timestamp").cast("timestamp")) / 1e6
    df = df.withColumns({"__dt": t - F.lag(t).over(w), "__deg": F.sqrt(F.pow(change("latitude"), 2) + F.pow(change("longitude"), 2)), "__alt": F.abs(change("altitude"))})
    slow = (F.try_divide("__deg", "__dt") < 0.003) & (F.try_divide("__alt", "__dt") < 150)
    return df.where(F.col("__dt").isNull() | (F.col("__dt") > 3600) | slow).drop("__dt", "__deg", "__alt")


def detect_phases(df: DataFrame, by: str = "callsign", rows: int = 40) -> DataFrame:
    """Phase from the mean climb of the last `rows` rows. TAXI goes before CLIMB, DESCENT, LEVEL_OFF and CRUISE."""
    df = clean_states(df, by)
    w = W.partitionBy(by).orderBy("timestamp").rowsBetween(1 - rows, 0)
    climb = F.coalesce(F.avg("vertical_rate").over(w), F.col("vertical_rate"))
    df = df.withColumn("__climb", climb)
    c, low = F.col("__climb"), (F.col("altitude") < 600) & (F.col("groundspeed") < 50)
    phase = (
        F.when(F.coalesce(F.col("on_ground"), F.lit(False)) | low, "TAXI").when(c > 8.3, "CLIMB").when(c < -8.3, "DESCENT")
        .when(c.between(-8.3, 8.3) & (F.col("altitude") < 18000), "LEVEL_OFF").otherwise("CRUISE")
    )
    return df.withColumn("phase", phase).drop("__climb")


def classify_direction(df: DataFrame, box: tuple[float, float, float, float], by: str = "callsign", home: tuple[float, float] = (47.46, 8.55)) -> DataFrame:
    """DEPARTURE, ARRIVAL, OVERFLIGHT or UNKNOWN of each flight, from its first and last point and a box
    (south, west, north, east), its edges out."""
    ends = df.groupBy(by).agg(F.min_by(F.struct("latitude", "longitude", "altitude"), "timestamp").alias("a"), F.max_by(F.struct("latitude", "longitude", "altitude"), "timestamp").alias("b"))
    inside = lambda p: (F.col(f"{p}.latitude") > box[0]) & (F.col(f"{p}.latitude") < box[2]) & (F.col(f"{p}.longitude") > box[1]) & (F.col(f"{p}.longitude") < box[3])
    start, end, rise = inside("a"), inside("b"), F.col("b.altitude") - F.col("a.altitude")
    near = F.pow(F.col("a.latitude") - home[0], 2) + F.pow(F.col("a.longitude") - home[1], 2) < 0.04
    both = F.when(rise > 500, "DEPARTURE").when(rise < -500, "ARRIVAL").otherwise("UNKNOWN")
    return ends.select(by, F.when(start & end, both).when(start, "DEPARTURE").when(end, "ARRIVAL").when(near & (rise > 2000), "DEPARTURE").otherwise("OVERFLIGHT").alias("direction"))


def segments(df: DataFrame, gap_seconds: int = 300, by: str = "callsign") -> DataFrame:
    """Number the stretches of a callsign: a gap or a change of phase starts the next; (callsign, segment_id) names one."""
    w = W.partitionBy(by).orderBy("timestamp")
    t = F.unix_micros(F.col("timestamp").cast("timestamp")) / 1e6
    same = (t - F.lag(t).over(w) <= gap_seconds) & (F.col("phase") == F.lag("phase").over(w))
    df = df.withColumn("__new", F.when(same, 0).otherwise(1))
    return df.withColumn("segment_id", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__new")


def hourly_callsigns(df: DataFrame) -> DataFrame:
    counts = df.groupBy(F.hour("timestamp").alias("hour")).agg(F.count_distinct("callsign").alias("flight_count"))
    hours = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    return hours.join(F.broadcast(counts), "hour", "left").fillna(0, ["flight_count"]).orderBy("hour")


def _minutes():
    """From a group's first timestamp to its last."""
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    return (F.max(at) - F.min(at)) / 60e6


def taxi_minutes(df: DataFrame, gap_seconds: int = 300, below: int = 120) -> DataFrame:
    """Taxi stretches of more than one and under `below` minutes."""
    known = df.dropna(subset=["timestamp", "callsign", "phase"])
    return segments(known, gap_seconds).where("phase = 'TAXI'").groupBy("callsign", "segment_id").agg(F.round(_minutes(), 6).alias("minutes")).where((F.col("minutes") > 1) & (F.col("minutes") < below))


def longest_level_offs(df: DataFrame, n: int = 15) -> DataFrame:
    return df.where("phase = 'LEVEL_OFF'").groupBy("callsign").agg(F.count(F.lit(1)).alias("seconds")).where("seconds > 30").orderBy(F.desc("seconds"), "callsign").limit(n)


def airline_efficiency(df: DataFrame) -> DataFrame:
    """Mean taxi time of airlines with more than two flights."""
    each = df.where("phase = 'TAXI'").groupBy("airline", "callsign").agg(_minutes().alias("taxi_min"))
    return each.groupBy("airline").agg(F.round(F.avg("taxi_min"), 4).alias("avg_taxi"), F.count_distinct("callsign").alias("flight_count")).where("flight_count > 2")


def level_off_share(df: DataFrame) -> DataFrame:
    held = F.count_distinct(F.when(F.col("phase") == "LEVEL_OFF", F.col("callsign")))
    return df.agg(F.count_distinct("callsign").alias("flights"), F.coalesce(F.round(F.try_divide(100.0 * held, F.count_distinct("callsign")), 1), F.lit(0.0)).alias("level_off_pct"))
