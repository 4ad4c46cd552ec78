"""Sessions and readers; schemas are declared, never inferred."""

from __future__ import annotations

import os
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.config import KEPT_AIRPORT_TYPES
from strider.sources import schemas


def s3a_options(endpoint: str, access_key: str, secret_key: str) -> dict[str, str]:
    """Settings for an S3-compatible store; its connector must be on the class path."""
    at = "spark.hadoop.fs.s3a."
    return {
        f"{at}endpoint": endpoint, f"{at}access.key": access_key, f"{at}secret.key": secret_key, f"{at}path.style.access": "true",
        f"{at}connection.ssl.enabled": "false", f"{at}aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    }


def build_session(name: str = "strider", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, compressed caches, adaptive plans, and an object store where the environment names one."""
    own = {"spark.sql.session.timeZone": "UTC", "spark.rdd.compress": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.sources.partitionOverwriteMode": "dynamic"}
    if endpoint := os.environ.get("S3_ENDPOINT"):
        own |= s3a_options(endpoint, os.environ["S3_ACCESS_KEY"], os.environ["S3_SECRET_KEY"])
    builder = SparkSession.builder.appName(name).config(map=own | conf)
    return (builder.master(master) if master else builder).getOrCreate()


def read_aircraft(spark: SparkSession, path: str) -> DataFrame:
    """One row for each trace file: gzipped JSON objects anywhere below the path, manifests left aside."""
    return spark.read.schema(schemas.RAW_TRACE).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json.gz").option("multiLine", "true").json(str(path))


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.AIRPORTS).option("header", "true").csv(str(path))


def filter_airports(raw: DataFrame) -> DataFrame:
    """The kept types with a position, in the reference columns, from a full airport table read as text."""
    placed = F.nullif("latitude_deg", F.lit("")).isNotNull() & F.nullif("longitude_deg", F.lit("")).isNotNull()
    return raw.where(F.col("type").isin(*KEPT_AIRPORT_TYPES) & placed).select(*schemas.AIRPORTS.fieldNames())


def read_table(spark: SparkSession, root: str, name: str, days=None, **equal) -> DataFrame:
    """A published table; days prune partitions, other filters reach the files."""
    df = spark.read.schema(schemas.PUBLISHED[name]).parquet(f"{root}/{name}")
    if days := as_dates(days or []):
        df = df.where(F.col("release_date").isin(*days))
    for column, value in equal.items():
        df = df.where(F.col(column).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(column) == value)
    return df


def as_dates(values) -> list[date]:
    """Sorted distinct dates of strings, dates and datetimes; missing values drop out."""
    out = set()
    for v in values:
        if v is None or v != v:
            continue
        out.add(v.date() if isinstance(v, datetime) else v if isinstance(v, date) else datetime.fromisoformat(str(v)).date())
    return sorted(out)


def load_trajectories(observations: DataFrame, flight_ids, days=None) -> DataFrame:
    """The points of some flights, in order; without ids nothing is read."""
    ids = [i for i in dict.fromkeys(flight_ids) if i]
    if not ids:
        return observations.limit(0)
    if days := as_dates(days or []):
        observations = observations.where(F.col("release_date").isin(*days))
    return observations.where(F.col("flight_id").isin(*ids)).orderBy("flight_id", "observation_seq")


def load_trajectory(observations: DataFrame, flight_id: str, day=None) -> DataFrame:
    return load_trajectories(observations, [flight_id], [day] if day else None)
