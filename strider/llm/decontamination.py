"""Benchmark decontamination: size-partitioned MinHash containment search, then exact shingle containment.

Native: DataFrame functions only. A test item is short and a document may be long, so their Jaccard similarity is tiny
and symmetric MinHash would need thousands of hash functions. The containment form asks instead which of an item's own
minimum-hash shingles a document contains: each of them is found with probability equal to the containment, whatever the
document's length. Items are partitioned by size; a partition of items with at most u shingles uses a bottom-k sketch of
k = floor((1 - threshold) * u) + 1 minima, so an item whose containment reaches the threshold has lost fewer than k
shingles and at least one minimum is met: no leak is missed. Candidates are then verified by exact containment of the
items' shingles, compared as text.

Only items have sketches. A document's side of the containment estimate is all of its shingles, looked up among the items'
minima: a sketch of the document would have to keep a share of them that depends on its length to the item's, and for short
items in long documents that is nearly all. So nothing of a document is sampled or kept.

The benchmark's sketch is the small side: it is counted first and broadcast up to BROADCAST_ROWS rows; beyond that the
join is left to shuffle. Documents are read twice, the second time only candidates are shingled; which documents are
candidates is written down in between, so that the search runs once.

Defined results: words are lower-cased (A-Z) runs without white space; an item with fewer than `width` words is one shorter
shingle, looked for among the documents' runs of that many words; an item or document without words is linked with
nothing; repeated rows of a document give one row for each item; items with equal ids are told apart by their text and
reported once, by the larger containment; a null document id is a document of its own id; other columns are not read by
leaks() and kept by decontaminate(), whatever their names; of equal containments the larger item is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.llm.common import ascii_lower, stage, words

BROADCAST_ROWS = 200_000


def runs(w: str, width: int) -> Column:
    """Hashes of all runs of `width` words of the array column w."""
    from_ = F.slice(w, 1, F.size(w) - (width - 1))
    return F.when(F.size(w) >= width, F.transform(from_, lambda x, i: F.xxhash64(F.lit(width), x, *[F.get(w, i + j) for j in range(1, width)])))


def run_texts(w: Column, at: Column, width: Column) -> Column:
    return F.array_join(F.slice(w, at + 1, width), " ")


def item_shingles(benchmark: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """(item, item_key, size, width, shingle hash, shingle text), distinct by item."""
    items = benchmark.select(F.col(id).alias("item_id"), words(ascii_lower(F.col(text))).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("item_key", F.xxhash64("item_id", F.array_join("w", " "))).withColumn("width", F.least(F.size("w"), F.lit(width)))
    hashed = F.lit(None).cast("array<bigint>")
    for k in range(width, 0, -1):
        hashed = F.when(F.col("width") == k, runs("w", k)).otherwise(hashed)
    items = items.withColumn("h", hashed)
    rows = items.select("item_id", "item_key", "width", "w", F.posexplode("h").alias("at", "shingle"))
    rows = rows.select("item_id", "item_key", "width", "shingle", run_texts(F.col("w"), F.col("at"), F.col("width")).alias("run")).distinct()
    sizes = rows.groupBy("item_key").agg(F.count(F.lit(1)).alias("size")).withColumnRenamed("item_key", "size_key")
    return rows.join(sizes, F.col("item_key") == F.col("size_key")).drop("size_key")


def sketch(shingles: DataFrame, threshold: float, ratio: float = 2.0) -> DataFrame:
    """The bottom-k minima of each item, k set by its size partition [u / ratio, u]."""
    upper = F.pow(F.lit(ratio), F.ceil(F.log(F.col("size")) / F.log(F.lit(ratio)) - F.lit(1e-9)))
    k = (F.floor((1 - threshold) * upper + F.lit(1e-9)) + 1).cast("int")
    order = W.partitionBy("item_key").orderBy(F.xxhash64(F.lit(77), "shingle"), "shingle")
    return shingles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_key", "width", "shingle")


def sized(df: DataFrame) -> DataFrame:
    """Broadcast a frame whose rows were counted to be few; else leave the join to a shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, width: int = 5, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item with at least `threshold` of the item's shingles in the document."""
    shingles = item_shingles(benchmark, item, item_text, width)
    widths = sorted(r[0] for r in shingles.select("width").distinct().collect())  # at most `width` values
    minima = sized(sketch(shingles, threshold))
    base = docs.select(F.col(id).alias("d_id"), words(ascii_lower(F.col(text))).alias("w")).where(F.size("w") > 0)
    empty = F.expr("cast(array() as array<bigint>)")
    all_runs = F.concat(*[F.coalesce(runs("w", k), empty) for k in widths]) if widths else empty
    found = base.select("d_id", F.explode(all_runs).alias("d_shingle"))
    hits = found.join(minima, found["d_shingle"] == minima["shingle"]).groupBy("d_id", "item_key").agg(F.count(F.lit(1)).alias("met"))
    candidates = hits.groupBy("d_id").agg(F.collect_set("item_key").alias("item_keys"))  # at most one entry for each item
    candidates = stage(candidates, "candidates")  # the search, the dearest part, runs once

    # Exact: the candidates' own words, cut into runs, against the text of every shingle of the item.
    c = candidates.withColumnRenamed("d_id", "c_id")
    again = docs.select(F.col(id).alias("d_id"), F.col(text).alias("d_text"))
    again = again.join(sized(c), again["d_id"].eqNullSafe(F.col("c_id"))).select("d_id", "item_keys", words(ascii_lower(F.col("d_text"))).alias("w"))
    wanted = sized(shingles)
    pieces = again.select("d_id", "w", "item_keys", F.explode(all_runs_at("w", widths)).alias("r"))
    met = pieces.join(wanted, (F.col("r.h") == wanted["shingle"]) & F.array_contains("item_keys", F.col("item_key")))
    met = met.where(run_texts(F.col("w"), F.col("r.i"), F.col("r.k")) == F.col("run"))
    shared = met.groupBy("d_id", "item_id", "item_key", "size").agg(F.countDistinct("run").alias("shared"))
    good = shared.where(F.col("shared") >= F.lit(threshold) * F.col("size"))
    best = good.groupBy("d_id", "item_id").agg(F.max(F.struct((F.col("shared") / F.col("size")).alias("containment"), "size", "shared")).alias("b"))
    return best.select(F.col("d_id").alias(id), F.col("item_id").alias(item), F.col("b.size").cast("long").alias("n_item"), F.col("b.shared").cast("long").alias("n_shared"), F.round("b.containment", 6).alias("containment"))


def _two(f):
    return lambda x, i: f(x, i)


def all_runs_at(w: str, widths: list[int]) -> Column:
    """(hash, position, width) of every run of each width."""
    none = F.expr("cast(array() as array<struct<h:bigint,i:int,k:int>>)")
    out = none
    for k in widths:

        def one(x: Column, i: Column, k: int = k) -> Column:
            return F.struct(F.xxhash64(F.lit(k), x, *[F.get(w, i + j) for j in range(1, k)]).alias("h"), i.alias("i"), F.lit(k).alias("k"))

        here = F.when(F.size(w) >= k, F.transform(F.slice(w, 1, F.size(w) - (k - 1)), _two(one)))
        out = F.concat(out, F.coalesce(here, none))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", **kw) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    bad = stage(leaks(docs, benchmark, id=id, **kw).select(F.col(id).alias("bad_id")).distinct(), "leaks")
    return docs.join(sized(bad), docs[id].eqNullSafe(bad["bad_id"]), "left_anti")  # the left side's columns only
