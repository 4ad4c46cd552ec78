"""Exact percentiles from counts of distinct values, which are few where values are whole units.

The p-th percentile is the first value up to which p percent of all values lie, as SQL's quantile_disc has it; nulls do
not count. Rows are counted by value first, so that what is ranked in one task is distinct values and not rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.functions.columns import col


def ranked(counted: DataFrame, by: Column | str, value: Column | str, n: str = "n") -> DataFrame:
    """Counts of distinct values with how many values of the group lie up to each, and how many there are."""
    group = W.partitionBy(by)
    known = F.when(col(value).isNotNull(), F.col(n)).otherwise(0)
    upto = group.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    return counted.withColumns({"__upto": F.sum(known).over(upto), "__total": F.sum(known).over(group)})


def percentile(value: Column | str, percent: int) -> Column:
    """An aggregate over ranked counts, in whole numbers: a product with 0.9 may lie beside the rank."""
    return F.min(F.when(F.col("__upto") * 100 >= F.col("__total") * percent, col(value)))
