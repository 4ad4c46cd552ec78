"""Published tables as Parquet by day. Overwriting a day replaces its partition and no other.

Plain Parquet has no transactions: what a transactional table would check for free is checked here, and every write goes
beside the table first and is then moved into place. Readers during a move may see neither version.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strider.sources import schemas

DAY = "release_date"


class WrongDay(ValueError):
    """Rows of another day than the one that is written."""


def day_literal(day: str):
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
        raise ValueError(f"a day looks like 2025-12-30, not {day!r}")
    return F.lit(day).cast("date")


def _same_fields(a: T.StructType, b: T.StructType) -> bool:
    return {f.name: f.dataType for f in a} == {f.name: f.dataType for f in b}


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _swap(spark: SparkSession, new: str, target: str, aside: str) -> None:
    """Move `new` to `target`; what was there waits aside until that is done and comes back where it fails."""
    fs, to = _fs(spark, target)
    old = _fs(spark, aside)[1]
    had = fs.exists(to)
    if had:
        fs.delete(old, True)
        if not fs.rename(to, old):
            raise OSError(f"{target} cannot be moved")
    if not fs.rename(_fs(spark, new)[1], to):
        if had:
            fs.rename(old, to)
        raise OSError(f"{new} cannot be moved to {target}")
    fs.delete(old, True)


def write_table(df: DataFrame, path: str, day: str | None = None, full_rebuild: bool = False, files_per_day: int = 1) -> None:
    """Replace one day, or, only when asked, everything. A wrong or missing day, and a changed schema, are refused.

    The rows are computed once, written beside the table and moved into place when the written days have been checked; no
    rows for a day leave it as it is. files_per_day: days are small by scope; raise it for days that one file (and one task) cannot hold.
    """
    if full_rebuild == (day is not None):
        raise ValueError("give either a day or full_rebuild=True")
    spark = df.sparkSession
    if day is not None:
        day_literal(day)
        there = live_files(spark, path)[0] and spark.read.parquet(path).schema
        if there and not _same_fields(there, df.schema):
            raise ValueError("the schema differs from the table's; only a full rebuild may change it")
    tag = day or "all"
    beside, aside = f"{path}.new-{tag}", f"{path}.old-{tag}"
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    spread = (DAY,) if files_per_day == 1 else (DAY, F.pmod(F.xxhash64(*hashed), F.lit(files_per_day)))
    df.repartition(*spread).write.mode("overwrite").partitionBy(DAY).option("partitionOverwriteMode", "static").parquet(beside)
    fs, new = _fs(spark, beside)
    if day is None:
        _swap(spark, beside, path, aside)
        return
    parts = [s.getPath().getName() for s in fs.listStatus(new) if s.isDirectory()]
    if any(part != f"{DAY}={day}" for part in parts):
        fs.delete(new, True)
        raise WrongDay(f"rows outside {day}")
    fs.mkdirs(_fs(spark, path)[1])
    for part in parts:
        _swap(spark, f"{beside}/{part}", f"{path}/{part}", aside)
    fs.delete(new, True)


def publish(name: str, df: DataFrame, root: str, **how) -> None:
    """Write one of the published tables, its columns in declared order and types."""
    fields = schemas.PUBLISHED[name].fields
    write_table(df.select(*[F.col(f.name).cast(f.dataType) for f in fields]), f"{root}/{name}", **how)


def live_files(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) of a table, from a listing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0, 0
    n = size = 0
    it = fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        if f.getPath().getName().endswith(".parquet"):
            n, size = n + 1, size + f.getLen()
    return n, size


def vacuum(spark: SparkSession, root: str, hours: dict[str, int] | None = None) -> list[tuple[str, int, int]]:
    """Delete what failed writes left behind (unfinished folders older than the table's hours); missing tables are skipped.
    Returns (table, files, bytes). Defaults keep observations' leftovers a day and others' a week."""
    out = []
    for name in schemas.PUBLISHED:
        fs, p = _fs(spark, f"{root}/{name}")
        if not fs.exists(p):
            continue
        age = (hours or {}).get(name, 24 if name == "observations" else 168) * 3_600_000
        now, n, size = spark._jvm.java.lang.System.currentTimeMillis(), 0, 0
        for s in fs.listStatus(p):
            if s.getPath().getName().startswith(("_temporary", ".spark-staging")) and now - s.getModificationTime() > age:
                said = fs.getContentSummary(s.getPath())
                n, size = n + said.getFileCount(), size + said.getLength()
                fs.delete(s.getPath(), True)
        out.append((name, n, size))
    return out


def export_single_file(df: DataFrame, folder: str, name: str) -> tuple[str, int, int]:
    """Write a small extract as one Parquet file that other tools open by path; returns (name, rows, bytes)."""
    spark = df.sparkSession
    beside = f"{folder}/_{name}_staging"
    df.coalesce(1).write.mode("overwrite").parquet(beside)
    fs, b = _fs(spark, beside)
    part = next(s.getPath() for s in fs.listStatus(b) if s.getPath().getName().startswith("part-"))
    _, target = _fs(spark, f"{folder}/{name}.parquet")
    fs.delete(target, True)
    fs.rename(part, target)
    fs.delete(b, True)
    return name, spark.read.parquet(f"{folder}/{name}.parquet").count(), fs.getFileStatus(target).getLen()
