"""Primitives for irregular time series: gap segments, runs, windows in seconds, as-of and interval joins, thinning.

Each takes its partition and order columns; stacked on the same partition column they share one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.functions.columns import seconds


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def running(partition, order):
    return W.partitionBy(*_list(partition)).orderBy(*_list(order)).rowsBetween(W.unboundedPreceding, W.currentRow)


def segment_by_gap(df: DataFrame, partition, time: str, gap_seconds: int, out: str = "segment_no", ties=()) -> DataFrame:
    """Number the stretches of a series: a gap of more than `gap_seconds` whole seconds starts the next.

    The numbers do not depend on `ties`, an order of equal times; windows that need it then find the rows sorted.
    """
    order = [time, *ties]
    w = W.partitionBy(*_list(partition)).orderBy(*order)
    gap = seconds(time) - seconds(F.lag(time).over(w))
    starts = F.when(gap <= gap_seconds, 0).otherwise(1)
    return df.withColumn("__starts", starts).withColumn(out, F.sum("__starts").over(running(partition, order))).drop("__starts")


def number_runs(df: DataFrame, partition, order, value: str, out: str = "run_no") -> DataFrame:
    """Number the runs of equal values in order; a null is never equal to what precedes it."""
    w = W.partitionBy(*_list(partition)).orderBy(*_list(order))
    starts = F.when(F.col(value) == F.lag(value).over(w), 0).otherwise(1)
    return df.withColumn("__starts", starts).withColumn(out, F.sum("__starts").over(running(partition, order))).drop("__starts")


def around(partition, epoch: str, half_seconds: int):
    """A window of time, not of rows: `half_seconds` to either side, both ends in."""
    return W.partitionBy(*_list(partition)).orderBy(epoch).rangeBetween(-half_seconds, half_seconds)


def asof_interval(points: DataFrame, intervals: DataFrame, by: str, time: str = "event_time", start: str = "start_time", end: str = "end_time", value: str = "phase", missing: str = "unknown") -> DataFrame:
    """Give each point the value of the latest interval that began at or before it, if that has not ended.

    One union and one window instead of a range join: an interval's start row carries its end and value forward.
    """
    names = points.columns
    p = points.select(*names, F.lit(1).alias("__kind"), F.col(time).alias("__at"), F.lit(None).cast(intervals.schema[end].dataType).alias("__end"), F.lit(None).cast("string").alias("__value"))
    i = intervals.select(
        *[F.col(by) if n == by else F.lit(None).cast(points.schema[n].dataType).alias(n) for n in names],
        F.lit(0).alias("__kind"), F.col(start).alias("__at"), F.col(end).alias("__end"), F.col(value).cast("string").alias("__value"),
    )
    w = W.partitionBy(by).orderBy("__at", "__kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.last(F.when(F.col("__kind") == 0, F.struct("__end", "__value")), ignorenulls=True).over(w)
    both = p.unionByName(i).withColumn("__last", last).where("__kind = 1")
    inside = F.col("__last").isNotNull() & (F.col("__at") <= F.col("__last.__end"))
    return both.select(*names, F.coalesce(F.when(inside, F.col("__last.__value")), F.lit(missing)).alias(value))


def within_intervals(points: DataFrame, intervals: DataFrame, by: str, time: str, start: str, end: str) -> DataFrame:
    """The points inside any interval of their key, both ends in; never more than once."""
    i = intervals.select(F.col(by).alias("__by"), F.col(start).alias("__from"), F.col(end).alias("__to"))
    return points.join(i, (points[by] == i["__by"]) & points[time].between(i["__from"], i["__to"]), "left_semi")


def thin_by_bucket(df: DataFrame, by: str, time: str, order: str, every_seconds: int) -> DataFrame:
    """The first row of each bucket of time."""
    w = W.partitionBy(by, F.floor(seconds(time) / every_seconds)).orderBy(order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")
