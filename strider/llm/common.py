"""Shared pieces: the shared folder, staged tables, word splitting and vectorised text hashing."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts define it: space and \x09-\x0D. A word is a run of anything else.
WORD_GAP = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir. Where that is unset there is none: a folder of the driver's
    own would take each executor's part of a table to another disk."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and spark.sparkContext.master.startswith("local["):  # one process: its temporary folder is shared by all
        found = f"file:{spark._jvm.java.lang.System.getProperty('java.io.tmpdir')}/strider-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", found)
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/strider-{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Cut lineage: write the frame to the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):  # nothing reads them once the table is there
        df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete what stage() wrote, once nothing reads it any more."""
    path = getattr(df, "_staged_path", None)
    if path:
        jvm, jsc = df.sparkSession._jvm, df.sparkSession._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Executions within drop their shuffle files as they end, and pass texts to Python in batches of a few megabytes."""
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v.removesuffix("b") if k.endswith("Batch") else v)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


# ---- numpy -------------------------------------------------------------------------------------------------

_RNG = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
P, Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
P_INV = np.uint64(pow(int(P), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = {"n": 0}
KEPT: dict = {}  # what a Python process keeps between the tasks of an operator, by the operator's name


def drop_kept(own: str) -> None:
    """Drop what operators other than `own` keep in this process."""
    for name in KEPT.keys() - {own}:
        del KEPT[name]


def give_back() -> None:
    """Return what this process has freed to the system: allocators keep it, and idle workers count as their executor's memory."""
    _POWERS.clear()
    _POWERS["n"] = 0
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def lean(run: Callable, own: str = "") -> Callable:
    """A pass of mapInArrow() whose process keeps no memory after a task, but for what `own` has in KEPT."""

    def passed(it):
        drop_kept(own)
        try:
            yield from run(it)
        finally:
            give_back()

    return passed


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64, for i up to n; kept between calls up to 2**22."""
    if _POWERS["n"] < n:
        size = 1 << max(12, int(n).bit_length())
        up, down = np.full(size, P), np.full(size, P_INV)
        up[0] = down[0] = 1
        _POWERS.update(n=size, up=np.cumprod(up, dtype=np.uint64), down=np.cumprod(down, dtype=np.uint64))
    up, down = _POWERS["up"], _POWERS["down"]
    if _POWERS["n"] > 1 << 22:
        _POWERS["n"] = 0
        _POWERS.pop("up"), _POWERS.pop("down")
    return up, down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each span of bytes, from prefix sums of a polynomial; equal spans hash alike anywhere."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(BYTE_CODE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def batches(texts, most: int = 1 << 20):
    """Cut a list of texts (None: empty) into runs of about `most` bytes: (index of the first, UTF-8 texts)."""
    part, size, first = [], 0, 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if t else b""
        if part and size + len(b) > most:
            yield first, part
            part, size, first = [], 0, i
        part.append(b)
        size += len(b) + 1
    if part:
        yield first, part


def word_hashes(part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the A-Z-lower-cased words of all texts of a run, and where each text's words begin (n + 1 offsets)."""
    data = np.frombuffer(b"\n".join(part).lower() + b"\n", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.cumsum([0] + [len(b) + 1 for b in part])
    return span_hashes(data, starts, ends), np.searchsorted(starts, bounds)


def shingle_sets(texts, width: int = 5):
    """For each text its sorted distinct shingle hashes; fewer words than `width` make one shingle, no word makes none."""
    for _, part in batches(texts):
        h, at = word_hashes(part)
        if len(h) >= width:
            total = np.zeros(len(h) - width + 1, np.uint64)
            for j in range(width):
                total = total * Q + h[j : len(h) - width + 1 + j]
            total = mix(total)
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= width:
                s = np.sort(total[a : b - width + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif b > a:
                s = np.array([b - a], np.uint64)
                for x in h[a:b]:
                    s = s * Q + x
                yield mix(s ^ np.uint64(0x5851F42D4C957F2D))
            else:
                yield np.empty(0, np.uint64)
