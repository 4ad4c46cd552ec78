"""Training-order materialisation: token sequences at permuted global slots, in fixed-stride binary shards.

Texts become token ids, each text closed by an end mark and cut into sequences of `length` ids. Every sequence gets a
number 0..N-1 (tasks count their own; the few counts by task are summed to offsets) and a keyed Feistel network over the
least even power of two that holds N, walked along its cycle until it falls below N, permutes the numbers: a bijection
without any table, so slot and number follow from each other anywhere. Slots are dealt in ranges of `per_shard`; each
range is one partition and one file of records of equal size in the order of slots. A reader finds slot s in shard
s // per_shard at byte (s % per_shard) * stride, so reading is sequential and can go on anywhere.

A record: slot int64, document id int64, part int32, ids used int32, `length` little-endian uint16 ids (padded with the
end mark), and the two bytes 0D 0A, which Spark's line writer puts between records and which show a torn record.
Files are Spark's own output: a lost task is written again, a shard appears only when its job commits.

The numbered sequences are a table in the target folder until all shards are there, and `_manifest.json` beside them says
what they were made from: length, key, tokens, and a fingerprint of the documents (number and hash of ids and texts). A
second call on the folder writes the missing shards from that table, so that all shards follow one numbering however the
documents are split by then; if the documents or the parameters are others, it raises ValueError and changes nothing.

Defined results: a null or empty text is one sequence with the end mark alone; repeated rows are sequences each; a null
id is stored as the least int64 and read back as null; an empty table makes no shard; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strider.llm.common import mix, new_path, shuffles_freed

LENGTH, PER_SHARD, KEY, ROUNDS, SLICES = 512, 4096, 20240229, 6, 4
END = 50_256
RANKS = "byte_bpe_50k.tiktoken"
HEAD = struct.Struct("<qqii")
NULL_ID = -(2**63)


def stride(length: int = LENGTH) -> int:
    return HEAD.size + 2 * length + 2


# ---- the permutation ---------------------------------------------------------------------------------------


def permute(x: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS, back: bool = False) -> np.ndarray:
    """The keyed permutation of 0..n-1 (or its inverse): Feistel rounds, repeated while the value is n or more."""
    half = np.uint64(max(1, (max(1, int(n) - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = np.asarray(x).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys[::-1] if back else keys:
            if back:
                left, right = right ^ (mix(left + k) & mask), left
            else:
                left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


# ---- tokens ------------------------------------------------------------------------------------------------

_ENCODERS: dict = {}


class Encoder:
    """Byte-level BPE of a rank file; nothing in a text is a special token."""

    def __init__(self, data: bytes):
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.own = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        return self.own.encode_to_numpy(text, disallowed_special=()).astype("<u2") if text else np.empty(0, "<u2")


def encoder(key: str, sent) -> Encoder:
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(sent.value)
    return _ENCODERS[key]


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def rank_data(path: str | None = None) -> bytes:
    with open(path or ranks_path(), "rb") as f:
        return f.read()


def sequences(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, path: str | None = None) -> DataFrame:
    """(task, number within the task, the record but for its slot, a hash of the document at its first part): one narrow pass."""
    sent = docs.sparkSession.sparkContext.broadcast(rank_data(path))  # the rank file, under a megabyte
    key = uuid.uuid4().hex
    kind = np.dtype([("doc", "<i8"), ("part", "<i4"), ("used", "<i4"), ("tokens", "<u2", length)])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, number = encoder(key, sent), TaskContext.get().partitionId(), 0
        for whole in it:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids = [own.encode(t) for t in batch.column(1).to_pylist()]
                size = np.fromiter(map(len, ids), np.int64, len(ids)) + 1  # with the end mark
                parts = -(-size // length)
                first = np.cumsum(parts) - parts
                doc = np.repeat(np.arange(len(ids)), parts)
                rec = np.empty(len(doc), kind)
                rec["doc"] = np.array([NULL_ID if i is None else i for i in batch.column(0).to_pylist()], np.int64)[doc]
                rec["part"] = np.arange(len(doc)) - first[doc]
                rec["used"] = np.minimum(size[doc] - rec["part"].astype(np.int64) * length, length)
                flat = np.full(len(doc) * length, END, "<u2")
                for x, f in zip(ids, first * length):
                    flat[f : f + len(x)] = x
                rec["tokens"] = flat.reshape(-1, length)
                tail = pa.FixedSizeBinaryArray.from_buffers(pa.binary(kind.itemsize), len(rec), [None, pa.py_buffer(rec.view(np.uint8))]).cast(pa.binary())
                mark = pa.array(batch.column(2).to_numpy()[doc], pa.int64(), mask=rec["part"] > 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rec), task, np.int32)), pa.array(np.arange(number, number + len(rec))), tail, mark], ["task", "number", "tail", "mark"])
                number += len(rec)

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"), marked(id, text).alias("mark"))
    return rows.mapInArrow(run, "task int, number long, tail binary, mark long")


def marked(id: str, text: str) -> Column:
    return F.xxhash64(F.col(id).cast("long"), F.lit(0), F.col(text))


def fingerprint(marks: DataFrame) -> list[int]:
    """The number of documents and two sums of their hashes: the same for the same rows in any order."""
    return list(marks.agg(F.count("mark"), F.coalesce(F.bit_xor("mark"), F.lit(0).cast("long")), F.coalesce(F.sum(F.pmod("mark", F.lit((1 << 31) - 1))), F.lit(0).cast("long"))).first())


# ---- shards ------------------------------------------------------------------------------------------------


def number(staged: DataFrame) -> tuple[np.ndarray, int]:
    """The first number of each task's sequences, and how many there are in all."""
    counts = {r[0]: r[1] for r in staged.groupBy("task").agg(F.count(F.lit(1))).collect()}  # one row a task
    offsets = np.zeros(max(counts, default=-1) + 1, np.int64)
    total = 0
    for t in sorted(counts):
        offsets[t], total = total, total + counts[t]
    return offsets, total


def slots(spark: SparkSession, offsets: np.ndarray, total: int, key: int):
    """A column function: the slot of (task, number), and its eight bytes. Only these two columns go to Python."""
    sent = spark.sparkContext.broadcast(offsets)  # eight bytes a task

    @F.arrow_udf("struct<slot: bigint, head: binary>")
    def slot(task: pa.Array, n: pa.Array) -> pa.Array:
        at = permute(sent.value[task.to_numpy()] + n.to_numpy(), total, key)
        head = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(at), [None, pa.py_buffer(at.astype("<i8").view(np.uint8))]).cast(pa.binary())
        return pa.StructArray.from_arrays([pa.array(at), head], ["slot", "head"])

    return slot.asNondeterministic()  # evaluated once, not again in a filter that is pushed down


def files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def done_shards(spark: SparkSession, path: str) -> list[int]:
    """Shards that are there whole: a job's output is moved into place only when all of it is written."""
    fs, p = files(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith("shard="))


def write_shards(staged: DataFrame, path: str, per_shard: int = PER_SHARD, key: int = KEY, slices: int = SLICES) -> None:
    """One file for each range of slots, its records in order; shards that are there already are passed over. They are written
    in `slices` ranges one after another, so that only one range's shuffle is on disk at a time. A range is dealt by its
    shards, one partition each, without a sample."""
    spark = staged.sparkSession
    offsets, total = number(staged)
    n = -(-total // per_shard)
    have = np.zeros(n, bool)  # one byte a shard
    done = np.array(done_shards(spark, path), np.int64)
    have[done[done < n]] = True
    slot, step = slots(spark, offsets, total, key), max(1, -(-n // slices))
    for at in range(0, n, step):
        upto = min(n, at + step)
        missing = np.flatnonzero(~have[at:upto]) + at
        if not len(missing):
            continue
        low, high = int(missing[0]), int(missing[-1]) + 1
        rows = staged.select(slot("task", "number").alias("at"), "tail").where(F.col("at.slot").between(low * per_shard, high * per_shard - 1))
        rows = rows.select(F.floor(F.col("at.slot") / per_shard).alias("shard"), F.col("at.slot").alias("slot"), F.concat("at.head", "tail").cast("string").alias("value"))
        if len(missing) < high - low:  # after a break inside a range; a list no longer than the range's shards
            kept = spark.createDataFrame([(int(x),) for x in missing], "kept long")
            rows = rows.join(F.broadcast(kept), rows["shard"] == kept["kept"], "left_semi")
        rows = rows.repartitionById(high - low, (F.col("shard") - low).cast("int")).sortWithinPartitions("shard", "slot")
        with shuffles_freed(spark):
            rows.select("shard", "value").write.mode("append").option("lineSep", "\r\n").partitionBy("shard").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    fs, p = files(spark, f"{path}/_manifest.json")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    fs, p = files(spark, f"{path}/_manifest.json")
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    finally:
        stream.close()


def materialise(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY,
    id: str = "doc_id", text: str = "text", ranks: str | None = None,
) -> str:
    """Write the shards of a table of texts, or those that are missing of an earlier call; returns their folder."""
    spark = docs.sparkSession
    path = (path or new_path(spark, "shards")).rstrip("/")
    made = {"length": length, "per_shard": per_shard, "key": key, "ranks": zlib.crc32(rank_data(ranks))}
    found, table = read_manifest(spark, path), f"{path}/_sequences"
    fs, target = files(spark, table)
    if found is None:
        if done_shards(spark, path):
            raise ValueError(f"{path} holds shards without a manifest")
        fs.delete(target, True)  # of a call that broke off before its manifest
        sequences(docs, id, text, length, ranks).write.option("compression", "zstd").parquet(table)
        found = made | {"documents": fingerprint(spark.read.parquet(table).select("mark"))}
        write_manifest(spark, path, found)
    elif found != made | {"documents": fingerprint(docs.select(marked(id, text).alias("mark")))}:
        raise ValueError(f"{path} was made from other documents or with other parameters")
    if fs.exists(target):  # else a call before this one was done
        write_shards(spark.read.schema("task int, number long, tail binary, mark long").parquet(table), path, per_shard, key)
        fs.delete(target, True)
    return path


def read_shards(spark: SparkSession, path: str, length: int = LENGTH) -> DataFrame:
    """The records of all shards: where each stands, what it holds, and a checksum of its ids. A file is at most a shard."""
    schema = "slot long, shard long, byte_offset long, doc_id long, part int, n_tokens int, token_crc long"
    if not done_shards(spark, path):
        return spark.createDataFrame([], schema)
    kind = np.dtype([("slot", "<i8"), ("doc", "<i8"), ("part", "<i4"), ("used", "<i4"), ("tokens", "u1", 2 * length), ("end", "S2")])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer()
                if data.size % kind.itemsize:
                    raise ValueError(f"torn record at the end of {name}")
                rec = np.frombuffer(data, kind)
                if len(torn := np.flatnonzero(rec["end"] != b"\r\n")):
                    raise ValueError(f"torn record at slot {rec['slot'][torn[0]]} in {name}")
                shard = int(name.rpartition("shard=")[2].partition("/")[0])
                crc = [zlib.crc32(t[: 2 * u].data) for t, u in zip(rec["tokens"], rec["used"].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(rec["slot"]), pa.array(np.full(len(rec), shard, np.int64)), pa.array(np.arange(len(rec), dtype=np.int64) * kind.itemsize),
                    pa.array(rec["doc"], mask=rec["doc"] == NULL_ID), pa.array(rec["part"]), pa.array(rec["used"]), pa.array(crc, pa.int64()),
                ], ["slot", "shard", "byte_offset", "doc_id", "part", "n_tokens", "token_crc"])

    return spark.read.format("binaryFile").load(f"{path}/shard=*/part-*").select("path", "content").mapInArrow(run, schema)
