"""Trace files as they arrive: decode is stateless, so a file stream lands observations without any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.operators import decode
from strider.sources import schemas


def decoded_stream(spark: SparkSession, path: str) -> DataFrame:
    """Decoded points of trace files that appear below the path."""
    raw = spark.readStream.schema(schemas.RAW_TRACE).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json.gz").option("multiLine", "true").json(path)
    return decode.decode(raw.select("*", F.col("_metadata.file_path").alias("path")), path=F.col("path"))


def land(points: DataFrame, target: str, checkpoint: str):
    """Append to a table by day; exactly once by the file sink's own log. Flights are cut by the daily build, over whole days."""
    return points.writeStream.format("parquet").partitionBy("release_date").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
