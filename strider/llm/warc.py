"""Merkle fixity audit of WARC files: compare replicas by their roots and descend only where they differ.

Pages become WARC/1.0 response records, dealt by id range into files of `per_file` ids; within a file they are ordered by
id and have an offset. A leaf hashes one record (sha256 of 00 and the record). The records of one id are one slot of the
file, whose place follows from the id alone, so that a record which is lost or added leaves all other nodes as they were;
an inner node hashes the `fanout` nodes below it in order (sha256 of 01 and their hashes) and stands for an ordered range
of offsets; the root stands for the file. The audit joins the replicas' roots, keeps the pairs that differ or lack a side,
and joins the children of those only, down to the slots; records within these are matched by their hashes. Replicas that
agree cost one comparison a file. Records of one id gather by the first digits of their hashes (4,096 parts), everything
else by partial groups of at most `fanout` rows or over such parts, so nothing gathers a file or a hot id in one task.

A record's status is `same`; `differs` (its id has one record in each replica's differing part: corrupt in one of them);
`copies_differ` (there more or fewer times); `only_own` or `only_other` (lost or added; also where several records of an
id changed, since which became which cannot be told). `moved` tells an intact record whose offset is another there.

Defined results: equal records of an id are one row with `copies`; a record with a null id is a file of its own, found by
its hash; a null url or body is written empty; empty tables have no files and audit to nothing; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.llm.common import stage

PER_FILE, FANOUT = 1024, 16


def records(pages: DataFrame, id: str = "page_id", url: str = "url", body: str = "html", per_file: int = PER_FILE) -> DataFrame:
    """(file, place, id, record) of each page: a WARC response record as bytes."""
    text = F.coalesce(F.col(body), F.lit(""))
    size = F.octet_length(text).cast("string")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col(id).cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.col(url), F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), size, F.lit("\r\n\r\n"),
    )
    record = F.concat(head, text, F.lit("\r\n\r\n")).cast("binary")
    df = pages.select(F.col(id).alias("id"), record.alias("record"))
    none = -1 - F.abs(F.shiftright(F.xxhash64("record"), 2))
    file = F.when(F.col("id").isNull(), none).otherwise(F.floor(F.col("id") / per_file)).cast("long")
    return df.select(file.alias("file"), F.coalesce(F.pmod("id", F.lit(per_file)), F.lit(0)).cast("long").alias("place"), "id", "record")


def leaves(recs: DataFrame) -> DataFrame:
    """(file, place, part, id, offset, length, copies, hash) of each distinct record, in order of place and hash within a
    file; bodies do not travel."""
    leaf = F.sha2(F.concat(F.lit(b"\x00"), F.col("record")), 256)
    df = recs.select("file", "place", "id", F.octet_length("record").cast("long").alias("length"), leaf.alias("hash"))
    df = df.groupBy("file", "place", "id", "length", "hash").agg(F.count(F.lit(1)).alias("copies"))
    df = df.withColumn("part", F.conv(F.substring("hash", 1, 3), 16, 10).cast("int"))
    size = F.col("length") * F.col("copies")
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    parts = df.groupBy("file", "place", "part").agg(F.sum(size).alias("bytes"))
    parts = parts.select("file", "place", "part", before("bytes", W.partitionBy("file").orderBy("place", "part")).alias("start"))
    inner = df.select("*", before(size, W.partitionBy("file", "place", "part").orderBy("hash")).alias("within"))
    both = inner.join(parts, ["file", "place", "part"])
    return both.select("file", "place", "part", "id", (F.col("start") + F.col("within")).alias("offset"), "length", "copies", "hash")


def node(items: Column) -> Column:
    """The hash over an ordered array of hex texts."""
    return F.sha2(F.concat(F.lit(b"\x01"), F.unhex(F.array_join(items, ""))), 256)


def above(rows: DataFrame, keys: tuple[str, ...], order: str, item: Column) -> DataFrame:
    """One node for each of `keys`: its range of offsets and the hash over its items in order."""
    below = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("h"))))
    up = rows.groupBy(*keys).agg(F.min("from_offset").alias("from_offset"), F.max("to_offset").alias("to_offset"), below.alias("below"))
    return up.select(*keys, "from_offset", "to_offset", node(F.transform("below", lambda x: x["h"])).alias("hash"))


def tree(leaf_rows: DataFrame, fanout: int = FANOUT, per_file: int = PER_FILE) -> DataFrame:
    """All levels: (file, level, place, from_offset, to_offset, hash); level 0 are the slots, the last has the roots."""
    end = F.col("offset") + F.col("length") * F.col("copies")
    rows = leaf_rows.select("file", "place", "part", F.col("offset").alias("from_offset"), end.alias("to_offset"), "hash", "copies")
    parts = above(rows, ("file", "place", "part"), "hash", F.concat("hash", F.lpad(F.hex("copies"), 16, "0")))
    level = above(parts, ("file", "place"), "part", F.col("hash"))
    out, k, wide = level.withColumn("level", F.lit(0)), 0, 1
    while wide < per_file:
        k, wide = k + 1, wide * fanout
        level = above(level.withColumn("up", F.floor(F.col("place") / fanout).cast("long")), ("file", "up"), "place", F.col("hash")).withColumnRenamed("up", "place")
        out = out.unionByName(level.withColumn("level", F.lit(k)))
    return out


def build(recs: DataFrame, name: str, fanout: int = FANOUT, per_file: int = PER_FILE) -> tuple[DataFrame, DataFrame]:
    """The staged leaves and tree of one replica."""
    own = stage(leaves(recs), f"{name}-leaves")
    return own, stage(tree(own, fanout, per_file), f"{name}-tree")


def audit(left: DataFrame, right: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(file, place): the slots at which two trees differ, found from the roots down."""
    top = max((t.agg(F.max("level")).first()[0] or 0) for t in (left, right))
    nodes = None
    for k in range(top, -1, -1):
        a = left.where(F.col("level") == k).select("file", "place", F.col("hash").alias("a"))
        b = right.where(F.col("level") == k).select("file", "place", F.col("hash").alias("b"))
        if nodes is not None:
            below = nodes.select("file", F.explode(F.sequence(F.col("place") * fanout, F.col("place") * fanout + (fanout - 1))).alias("place"))
            a, b = a.join(below, ["file", "place"], "left_semi"), b.join(below, ["file", "place"], "left_semi")
        both = a.join(b, ["file", "place"], "full_outer")
        nodes = stage(both.where(~F.col("a").eqNullSafe(F.col("b"))).select("file", "place"), f"differ{k}")
    return nodes


def report(own: DataFrame, other: DataFrame, bad: DataFrame) -> DataFrame:
    """Every record of the first replica, and the records that only the other has, with their status."""
    at, slot = ["file", "place", "part", "hash"], ["file", "place"]
    files = bad.select("file").distinct()
    there = other.join(files, "file", "left_semi").select(*at, F.col("offset").alias("other_offset"), F.col("copies").alias("other_copies"))
    lost = own.join(bad, slot, "left_semi").join(there, at, "left_anti")
    added = stage(other.join(bad, slot, "left_semi").join(own.join(files, "file", "left_semi"), at, "left_anti"), "added")
    single = lambda df, name: df.where(F.col("id").isNotNull()).groupBy(*slot).agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias(name)).where("n = 1").drop("n")
    pairs = stage(single(lost, "hash").join(single(added, "other_sha256"), slot), "pairs")

    lacks = F.col("other_copies").isNull() & F.col("bad")
    status = (
        F.when(F.col("other_sha256").isNotNull(), "differs").when(lacks, "only_own").when(F.col("bad") & (F.col("copies") != F.col("other_copies")), "copies_differ").otherwise("same")
    )
    both = own.join(bad.withColumn("bad", F.lit(True)), slot, "left").join(there, at, "left").join(pairs, [*slot, "hash"], "left")
    moved = F.coalesce(F.col("offset") != F.col("other_offset"), F.lit(False))
    cols = ("offset", "length", "copies", F.col("hash").alias("sha256"))
    mine = both.select(F.col("id").alias("page_id"), "file", "place", *cols, "other_sha256", moved.alias("moved"), status.alias("status"))
    new = added.join(pairs.select(*slot, F.col("other_sha256").alias("hash")), [*slot, "hash"], "left_anti")
    none = F.lit(None).cast("long")
    theirs = new.select(
        F.col("id").alias("page_id"), "file", "place", none.alias("offset"), "length", F.lit(0).cast("long").alias("copies"), F.lit(None).cast("string").alias("sha256"),
        F.col("hash").alias("other_sha256"), F.lit(False).alias("moved"), F.lit("only_other").alias("status"),
    )
    return mine.unionByName(theirs)


def damaged(pages: DataFrame, id: str = "page_id", body: str = "html", every: int = 97) -> DataFrame:
    """A second replica for drills: the body of each row whose id's crc32 is divisible by `every` has its first byte changed."""
    hit = F.crc32(F.col(id).cast("string").cast("binary")) % every == 0
    return pages.withColumn(body, F.when(hit, F.concat(F.lit("?"), F.substring(body, 2, 2**31 - 1))).otherwise(F.col(body)))


def fixity(pages: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Audit two replicas of a table of pages, record by record."""
    own, own_tree = build(records(pages), "own", fanout)
    other, other_tree = build(records(replica), "other", fanout)
    return report(own, other, audit(own_tree, other_tree, fanout))
