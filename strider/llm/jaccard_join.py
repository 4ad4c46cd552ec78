"""N-gram Jaccard join by PartEnum signatures, exact: links at Jaccard >= threshold and their components.

Sizes are cut into cells; a cell's band is the cell and the sizes above it that can still link with one of its sizes. A pair
is looked for in the band of its smaller set, so a set signs for its own cell and, if it stands low in that, for the one
below. Sets of sizes a and b that link differ in at most (a + b) (1 - t) / (1 + t) shingles; k is that bound for a band.
The domain is dealt by hash into n1 first-level parts of n2 = 3 second-level parts each, and for every first-level part all
subsets of n2 - k2 = 2 of its parts are enumerated: a signature is the hash of a set's projection on one subset. As
n1 (k2 + 1) >= k + 1, one first-level part differs in at most k2 = 1 shingle, and one of its subsets is met by both sets.
More than that: a pair at distance d shares at least 2 n1 - d signatures. n1 is SLACK times what is needed, so that some of
them may be empty (these are not signed) or hot.

Signatures are compared in packed form: a task signs a run of sets and sends their signatures on packed by partition; of a
signature that is crowded in the run it sends only the least set, and the others as a star around that. So a signature
that a third of all sets has travels CROWD times a run at most. A partition is sorted and yields the signatures that several sets
have; those with the very same sets are one group, of so much weight, as near copies share most of their signatures.

Groups of a signature are never joined with themselves as they come. The stars are settled and labelled first; then only
pairs of members with different labels remain. They are taken from signatures whose members have at most GROUP labels, so
that a signature makes at most GROUP pairs a member. A set that has not enough such signatures for the counting argument is
loose (texts made mostly of a common passage, families of thousands of near copies, small sets with empty subsets). Loose
sets are joined among themselves by their rarest shingles (prefix filtering); an entry carries the shingles that it can
still share, and with that the largest partner it can have, so entries without any partner of a fitting size leave
their group. Around the entry nearest to a group's common part again a star is settled first; what then still has different
labels is compared by sketches in cells of two blocks of BLOCK members. No pair is lost to a limit.

A candidate pair is settled in two steps. Each set has a parity sketch, one bit for each of about two hash buckets an
element: the parity of the elements in that bucket. Sketches differ in at most as many bits as the sets differ in shingles,
so a pair whose sketches differ in more bits than a link allows is none, and only the rest read their texts. The texts'
common shingles are then counted exactly.

That finds every component, and enough links to connect each. The other links of a component are between its members, so
link() and join() settle all of them afterwards: a component's sets are cut into blocks by size, every two blocks whose
sizes can link are a cell, and a cell counts the common shingles of all its pairs at once.

Exact copies collapse before any of this, in each task (a set signs once a task) and then over all. Components are found by
star contraction over staged edges, never on the driver. Shingles and sets are told apart by 64-bit hashes.

Defined results: words are A-Z-lower-cased runs without white space; a text of fewer than five words is one shingle; null
texts and texts without words have size 0 and link with nothing; rows with equal ids are judged each by their own text; rows
with a null id stand for no set: their component is that of the documents with their text, null where there are none;
further columns are not read by join() and kept by keep_one(), whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.llm.common import lean, mix, shingle_sets, stage, unstage

NUM, DEN = 75, 100  # link when DEN * intersection >= NUM * union
STEP, SLACK, GROUP, WIDTH = 1.75, 1.1, 32, 5
N2, K2 = 3, 1
SEEN, BLOCK = 200_000, 2048
SIX = np.uint64((1 << 48) - 1)
RUN, CROWD = 500_000, 16  # signatures of a run, about; sets of a signature that a run sends on one by one
SLOTS, MOST = 1 << 20, 65_535  # of each of the two rows of approximate counts of loose shingles, and how far these go
ELEMENTS = 1_000_000  # shingles of a block of whole texts, about
BROADCAST_ROWS = 500_000


def cells_of(limit: int, num: int = NUM, den: int = DEN, step: float = STEP) -> list[tuple[int, int, int]]:
    """(least, largest, top) of each cell of sizes: its sets, and the largest that one of them can link with."""
    out, low = [], 1
    while low <= limit:
        high = max(low, int(low * step))
        out.append((low, high, high * den // num))
        low = high + 1
    return out


LOW, HIGH, TOP = (np.array(x, np.int64) for x in zip(*cells_of(1 << 40)))


def most_apart(a, b, num: int = NUM, den: int = DEN):
    """The most shingles in which linked sets of sizes a and b differ."""
    return (a + b) * (den - num) // (den + num)


def first_level(slack: float = SLACK) -> np.ndarray:
    """n1 of each band: n1 (K2 + 1) exceeds the most differing shingles of a pair of the band, with slack."""
    return np.ceil((most_apart(HIGH, TOP) + 1) * slack / (K2 + 1)).astype(np.int64)


N1 = first_level()


def bands(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band of each size's cell, and the band below where the size is still in it (else -1)."""
    own = np.searchsorted(HIGH, n)
    below = own - 1
    return own, np.where((own > 0) & (n <= TOP[np.maximum(below, 0)]), below, -1)


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, index of its set) of non-empty sets, in order of the sets, and the spare of each set: how many shared
    signatures a linked pair has at least, in any band."""
    n = np.array([len(s) for s in sets], np.int64)
    spare = np.full(len(sets), 1 << 30, np.int64)
    if not len(sets):
        return np.empty(0, np.uint64), np.empty(0, np.int64), spare
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    value = mix(flat + np.uint64(0x51ED270B))
    own, below = bands(n)
    out_sig, out_owner = [], []
    for band, partner in ((own, np.minimum(n * DEN // NUM, TOP[own])), (below, np.minimum(n, HIGH[np.maximum(below, 0)]))):
        here = np.flatnonzero(band >= 0)
        if not len(here):
            continue
        n1 = np.where(band >= 0, N1[band], 0)
        at = np.cumsum(np.concatenate([[0], n1]))  # first-level parts of set i: at[i] .. at[i + 1]
        if len(here) < len(sets):
            mine = (band >= 0)[owner]
            o, x, v = owner[mine], flat[mine], value[mine]
        else:
            o, x, v = owner, flat, value
        part = (mix(x ^ (np.uint64(0xA5A5A5A5) + band.astype(np.uint64))[o]) % (N2 * n1).astype(np.uint64)[o]).astype(np.int64) + N2 * at[o]
        total, filled = np.zeros(N2 * at[-1], np.uint64), np.bincount(part, minlength=N2 * at[-1])
        np.add.at(total, part, v)
        total, filled = total.reshape(-1, N2), filled.reshape(-1, N2)
        holder = np.repeat(np.arange(len(sets)), n1)
        first = np.arange(at[-1]) - at[holder]
        # A subset of two of the three parts is given by the part that is left out.
        left_out = mix((first.astype(np.uint64) * np.uint64(4) + (band[holder].astype(np.uint64) + np.uint64(1) << np.uint64(40)))[:, None] + np.arange(N2, dtype=np.uint64)[None, :])
        sig = mix((total.sum(axis=1, dtype=np.uint64)[:, None] - total) ^ left_out)
        full = (filled.sum(axis=1)[:, None] - filled) > 0
        out_sig.append(sig[full])
        out_owner.append(np.broadcast_to(holder[:, None], full.shape)[full])
        signed = np.bincount(out_owner[-1], minlength=len(sets))
        left = 2 * n1 - most_apart(n, partner) - (N2 * n1 - signed)
        spare[here] = np.minimum(spare[here], left[here])
    sig, who = np.concatenate(out_sig), np.concatenate(out_owner)
    order = np.argsort(who, kind="stable")
    return sig[order], who[order], spare


def fingerprint(s: np.ndarray) -> int:
    """A 64-bit hash of a whole set; size 0 gives 0."""
    if not len(s):
        return 0
    return int(mix(np.array([mix(s).sum(dtype=np.uint64) ^ np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def parity(s: np.ndarray) -> bytes:
    """A set's parity sketch: a power of two of bits, at least twice the set's size."""
    m = max(64, 1 << (2 * len(s) - 1).bit_length())
    return np.packbits((np.bincount((mix(s ^ np.uint64(0x9A17)) & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1).astype(np.uint8), bitorder="little").tobytes()


def parity_distance(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ, the longer one folded to the length of the other."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


# ---- signing and grouping ----------------------------------------------------------------------------------

#: What a signing task sends on. Kind 0: a document. Kind 1: a run's signatures of one partition, as sets, the number of each
#: set's signatures, and six bytes of each signature; 3: the same, marked. Kind 2: (signature, set, least set) of crowded ones.
SENT = "bucket int, kind byte, doc long, n int, set long, spare long, text_hash long, sketch binary, sets binary, counts binary, keys binary"
_SENT = pa.schema([
    ("bucket", pa.int32()), ("kind", pa.int8()), ("doc", pa.int64()), ("n", pa.int32()), ("set", pa.int64()), ("spare", pa.int64()),
    ("text_hash", pa.int64()), ("sketch", pa.binary()), ("sets", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary()),
])
GROUPED = "kind byte, key long, set long, least long, weight long, doc long, n int, spare long, text_hash long, sketch binary"
_GROUPED = pa.schema([
    ("kind", pa.int8()), ("key", pa.int64()), ("set", pa.int64()), ("least", pa.int64()), ("weight", pa.int64()), ("doc", pa.int64()), ("n", pa.int32()),
    ("spare", pa.int64()), ("text_hash", pa.int64()), ("sketch", pa.binary()),
])


def rows_of(schema: pa.Schema, rows: int, /, **columns) -> pa.RecordBatch:
    """A batch of so many rows; columns not given are null."""
    cols = [columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def packed(sig: np.ndarray, who: np.ndarray, ids: np.ndarray, partitions: int, home: int) -> Iterator[pa.RecordBatch]:
    """One run's signatures for each partition. Of a signature with more than CROWD sets in the run only the least set is sent
    to the signature's partition, marked; its star goes to any partition, as rows that need no further grouping."""
    p = np.uint64(partitions)
    sig = ((sig // p) & SIX) * p + sig % p  # what six bytes and the partition tell
    order = np.argsort(sig)
    k, w = sig[order], who[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    size = np.diff(np.append(first, len(k)))
    crowd = np.repeat(size > CROWD, size)
    parts = [(1, k[~crowd], w[~crowd])]
    if crowd.any():
        least = np.repeat(np.minimum.reduceat(ids[w], first), size)
        yield rows_of(_SENT, 1, bucket=[home % partitions], kind=[2], keys=[np.stack([k[crowd].view(np.int64), ids[w[crowd]], least[crowd]]).tobytes()])
        rep = np.flatnonzero(crowd & (ids[w] == least))
        parts.append((3, k[rep], w[rep]))
    for kind, k, w in parts:
        bucket = (k % p).astype(np.int64)
        order = np.argsort(bucket * len(ids) + w)
        k, w, bucket = k[order], w[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(partitions + 1))
        six = np.ascontiguousarray(((k // p) & SIX).view(np.uint8).reshape(-1, 8)[:, :6])
        used, sets, counts, keys = [], [], [], []
        for b in np.flatnonzero(edges[1:] > edges[:-1]):
            i, j = edges[b], edges[b + 1]
            at = np.flatnonzero(np.concatenate([[True], w[i + 1 : j] != w[i : j - 1]]))
            many = np.diff(np.append(at, j - i))
            again = 1 + (many - 1) // 255  # a count is one byte; a set with more signatures is written again
            used.append(int(b))
            sets.append(np.repeat(ids[w[i:j][at]], again).tobytes())
            last = np.cumsum(again) - 1
            one = np.full(last[-1] + 1, 255, np.uint8)
            one[last] = many - 255 * (again - 1)
            counts.append(one.tobytes())
            keys.append(six[i:j].tobytes())
        if used:
            yield rows_of(_SENT, len(used), bucket=used, kind=np.full(len(used), kind, np.int8), sets=sets, counts=counts, keys=keys)


def signed(docs: DataFrame, id: str, text: str, partitions: int) -> DataFrame:
    """One pass over the texts: SENT rows."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        task, number = TaskContext.get().partitionId(), count()
        sigs, owners, ids, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            home = int(mix(np.array([(task << 20) + next(number)], np.uint64))[0] >> np.uint64(16))
            yield from packed(np.concatenate(sigs), np.concatenate(owners), np.array(ids, np.int64), partitions, home)
            for x in (sigs, owners, ids):
                x.clear()

        for whole in it:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows, fresh, which = [], [], []
                docs_here = batch.column(0).to_pylist()
                for i, s in zip(docs_here, shingle_sets(batch.column(1).to_pylist(), WIDTH)):
                    a = fingerprint(s)
                    if len(s) and i is not None and a not in seen:  # a row without an id stands for no set
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(a)
                        which.append(len(rows))
                        fresh.append(s)
                    rows.append((len(s), a))
                n, a = (np.array(x, np.int64) for x in zip(*rows))
                sig, who, left = signatures(fresh)
                spare, sketch = np.full(len(rows), 1 << 30, np.int64), [None] * len(rows)
                spare[which] = left
                for r, s in zip(which, fresh):
                    sketch[r] = parity(s)
                bucket = (mix(np.arange(len(rows), dtype=np.uint64) + np.uint64((task << 32) + (next(number) << 8))) % np.uint64(partitions)).astype(np.int32)
                yield rows_of(_SENT, len(rows), bucket=bucket, kind=np.zeros(len(rows), np.int8), doc=docs_here, n=n.astype(np.int32), set=a, spare=spare, text_hash=batch.column(2), sketch=sketch)
                sigs.append(sig)
                owners.append(who + len(ids))
                ids += a[which].tolist()
                held += len(sig)
                if held >= RUN:
                    yield from flush()
                    held = 0
        if held:
            yield from flush()

    rows = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"))
    return rows.mapInArrow(lean(run), SENT)


def same_groups(key: np.ndarray, who: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, set, least, weight) of the signatures that several sets have, or that a run marked. Signatures with the same
    sets are one group, named by its sets, of so much weight; a marked signature, whose sets are not all here, is its own."""
    order = np.lexsort((who, key))
    key, who, marked = key[order], who[order], marked[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (who[1:] != who[:-1])])
    marked = np.maximum.reduceat(marked, np.flatnonzero(new))
    key, who = key[new], who[new]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    least, mark = who[first], np.maximum.reduceat(marked, first).astype(bool)
    name = mix(np.add.reduceat(mix(who.view(np.uint64)), first) ^ mix(size.astype(np.uint64)))
    name = np.where(mark, key[first], name)
    kept = np.flatnonzero((size > 1) | mark)
    name, at, weight = np.unique(name[kept], return_index=True, return_counts=True)
    groups = kept[at]
    rows = np.repeat(first[groups] - np.concatenate([[0], np.cumsum(size[groups])[:-1]]), size[groups]) + np.arange(size[groups].sum())
    return np.repeat(name, size[groups]).view(np.int64), who[rows], np.repeat(least[groups], size[groups]), np.repeat(weight, size[groups])


def grouped(sent: DataFrame, partitions: int) -> DataFrame:
    """GROUPED rows: the documents (kind 0), and (key, set, least, weight) of groups of sets that share signatures (kind 1)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, keys, marks = [], [], []
        for batch in it:
            kind = batch.column(1).to_numpy(zero_copy_only=False)
            docs = batch.filter(pa.array(kind == 0))
            if docs.num_rows:
                yield rows_of(_GROUPED, docs.num_rows, **{c: docs.column(c) for c in ("kind", "doc", "n", "set", "spare", "text_hash", "sketch")})
            for r in np.flatnonzero(kind == 2):
                key, who, least = np.frombuffer(batch.column(10)[r].as_py(), np.int64).reshape(3, -1)
                yield rows_of(_GROUPED, len(key), kind=np.ones(len(key), np.int8), key=key, set=who, least=least, weight=np.ones(len(key), np.int64))
            for r in np.flatnonzero((kind == 1) | (kind == 3)):
                six = np.frombuffer(batch.column(10)[r].as_py(), np.uint8).reshape(-1, 6)
                wide = np.zeros((len(six), 8), np.uint8)
                wide[:, :6] = six
                keys.append(wide.view(np.uint64).ravel() * np.uint64(partitions) + np.uint64(batch.column(0)[r].as_py()))
                sets.append(np.repeat(np.frombuffer(batch.column(8)[r].as_py(), np.int64), np.frombuffer(batch.column(9)[r].as_py(), np.uint8)))
                marks.append(np.full(len(six), kind[r] == 3, np.uint8))
        if not keys:
            return
        key = np.concatenate(keys)
        keys.clear()
        order = np.argsort(key)
        key, marked = key[order], np.concatenate(marks)[order]
        same = key[1:] == key[:-1]
        more = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (marked > 0)
        if not more.any():
            return
        key, who, least, weight = same_groups(key[more], np.concatenate(sets)[order[more]], marked[more])
        for at in range(0, len(key), 1 << 18):
            g = slice(at, at + (1 << 18))
            yield rows_of(_GROUPED, len(key[g]), kind=np.ones(len(key[g]), np.int8), key=key[g], set=who[g], least=least[g], weight=weight[g])

    return sent.repartitionById(partitions, F.col("bucket")).mapInArrow(lean(run), GROUPED)


# ---- pairs -------------------------------------------------------------------------------------------------


def few(df: DataFrame) -> DataFrame:
    """Broadcast what was counted to be few rows; else the join shuffles."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, id: str, text: str, name: str) -> DataFrame:
    """Of staged (a, b) pairs of sets those that link: first by sketches, then from the whole texts of one document for each set."""
    pairs = stage(maybe(pairs, sets), f"{name}-maybe")
    if pairs.isEmpty():
        return pairs
    need = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
    one = stage(sets.join(need, "set").select("set", "rep", "rep_hash"), f"{name}-need")
    texts = stage(texts_of(one, docs, id, text), f"{name}-texts")
    both = pairs.join(texts.withColumnRenamed("t", "ta"), F.col("a") == F.col("set")).drop("set")
    both = both.join(texts.withColumnRenamed("t", "tb"), F.col("b") == F.col("set")).drop("set").select("a", "b", "ta", "tb")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}  # few sets, most of which come again soon
        for whole in it:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                keys = [batch.column(0).to_pylist(), batch.column(1).to_pylist()]
                if len(known) > 512:
                    known.clear()
                for side in (0, 1):
                    new = {k: i for i, k in enumerate(keys[side]) if k not in known}
                    known.update(zip(new, shingle_sets([batch.column(2 + side)[i].as_py() for i in new.values()], WIDTH)))
                good = []
                for a, b in zip(*keys):
                    x, y = known[a], known[b]
                    common = len(x) + len(y) - len(np.union1d(x, y)) if len(x) and len(y) else 0
                    good.append(common > 0 and DEN * common >= NUM * (len(x) + len(y) - common))
                keep = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    out = stage(both.mapInArrow(lean(run), "a long, b long"), f"{name}-links")
    unstage(texts)
    return out


def texts_of(sets: DataFrame, docs: DataFrame, id: str, text: str) -> DataFrame:
    """(set, t): for each set the text of the row that stands for it."""
    rows = docs.select(F.col(id).cast("long").alias("t_doc"), F.col(text).alias("t"))
    found = rows.join(few(sets.select("set", "rep", "rep_hash")), F.col("t_doc") == F.col("rep"))
    return found.where(F.xxhash64("t") == F.col("rep_hash")).groupBy("set").agg(F.first("t").alias("t"))


def maybe(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Drop the pairs that sizes and sketches rule out."""
    own = sets.select("set", "n", "sketch")
    p = pairs.join(own.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka")), "a")
    p = p.join(own.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb")), "b").select("a", "b", "na", "nb", "ka", "kb")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sizes = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            keep = pa.array([parity_distance(x, y) <= most_apart(m, n) for (m, n), x, y in zip(sizes, batch.column(4).to_pylist(), batch.column(5).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return p.mapInArrow(lean(run), "a long, b long")


def sizes_fit(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Drop pairs whose sizes alone rule a link out."""
    n = sets.select("set", "n")
    p = pairs.join(n.select(F.col("set").alias("sa"), F.col("n").alias("na")), F.col("a") == F.col("sa"))
    p = p.join(n.select(F.col("set").alias("sb"), F.col("n").alias("nb")), F.col("b") == F.col("sb"))
    return p.where(F.least("na", "nb") * DEN >= F.greatest("na", "nb") * NUM).select("a", "b")


def star(groups: DataFrame) -> DataFrame:
    """(a, b): each member of a group with its least member."""
    return groups.where(F.col("set") != F.col("least")).select(F.col("least").alias("a"), F.col("set").alias("b")).distinct()


def labels_of(links: DataFrame) -> DataFrame:
    """(member, label): the component that the links so far put a set in; pairs inside one are settled."""
    return components(links).withColumnRenamed("component", "label")


def labelled(groups: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """(key, set, label, and the groups' other columns): the members of groups with more than one label. Each step is a
    partial aggregate by key, so no task holds a group."""
    labels = few(labels)
    extra = [c for c in groups.columns if c not in ("key", "set", "least")]
    g = groups.join(labels, groups["set"] == labels["member"], "left").select("key", "set", F.coalesce("label", "set").alias("label"), *extra)
    ends = g.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(F.col("key").alias("open_key"))
    ends = few(stage(ends, f"{name}-open"))
    return stage(g.join(ends, g["key"] == ends["open_key"]).drop("open_key").distinct(), f"{name}-mixed")


def with_labels(mixed: DataFrame) -> DataFrame:
    """Add `labels`, the number of labels of each group."""
    n = mixed.select("key", "label").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("labels")).withColumnRenamed("key", "n_key")
    n = few(stage(n, "label-counts"))
    return mixed.join(n, mixed["key"] == n["n_key"]).drop("n_key")


def across(mixed: DataFrame) -> DataFrame:
    """(a, b): members of one group with different labels."""
    left = mixed.select("key", F.col("set").alias("a"), F.col("label").alias("la"))
    right = mixed.select("key", F.col("set").alias("b"), F.col("label").alias("lb"))
    return left.join(right, "key").where("a < b AND la <> lb").select("a", "b").distinct()


def close_pairs(t: pa.Table, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of members `first` x `second` the pairs with different labels that sizes, reaches and sketches leave open."""
    sets, labels, n, reach = (t.column(c).to_numpy().astype(np.int64) for c in ("set", "label", "n", "reach"))
    sketches = t.column("sketch").to_pylist()
    lengths = np.array([len(k) for k in sketches])
    out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for x in np.unique(lengths[first]):
        for y in np.unique(lengths[second]):
            i, j = first[lengths[first] == x], second[lengths[second] == y]
            p, q = (np.frombuffer(b"".join(sketches[k] for k in at), np.uint8).reshape(len(at), m) for at, m in ((i, x), (j, y)))
            while p.shape[1] > q.shape[1]:
                p = p[:, : p.shape[1] // 2] ^ p[:, p.shape[1] // 2 :]
            while q.shape[1] > p.shape[1]:
                q = q[:, : q.shape[1] // 2] ^ q[:, q.shape[1] // 2 :]
            step = max(1, (1 << 24) // max(1, len(j) * p.shape[1]))
            for at in range(0, len(i), step):
                h = i[at : at + step]
                fit = (n[h][:, None] <= reach[j][None, :]) & (n[j][None, :] <= reach[h][:, None]) & (labels[h][:, None] != labels[j][None, :])
                rows, cols = np.nonzero(fit)
                far = np.bitwise_count(p[at + rows] ^ q[cols]).sum(axis=1, dtype=np.int64) > most_apart(n[h][rows], n[j][cols])
                a, b = sets[h][rows[~far]], sets[j][cols[~far]]
                out_a.append(np.minimum(a, b))
                out_b.append(np.maximum(a, b))
    return np.concatenate(out_a), np.concatenate(out_b)


def across_blocks(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """The same pairs as across(), those already dropped that sketches rule out, for groups of any size: a group is dealt by
    hash into blocks of about BLOCK members, each cell of two blocks is a group of its own, and only open pairs leave it."""
    blocks = mixed.groupBy("key").agg((F.floor((F.count(F.lit(1)) - 1) / BLOCK) + 1).alias("blocks")).withColumnRenamed("key", "b_key")
    own = sets.select(F.col("set").alias("own"), "n", "sketch")
    m = mixed.join(few(stage(blocks, "blocks")), F.col("key") == F.col("b_key")).join(own, mixed["set"] == F.col("own"))
    m = m.withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")))
    m = m.select("key", "set", "label", "reach", "n", "sketch", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    m = m.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    def cell(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        block, low, high = t.column("block").to_numpy(), t.column("low")[0].as_py(), t.column("high")[0].as_py()
        a, b = close_pairs(t, np.flatnonzero(block == low), np.flatnonzero(block == high))
        return pa.table({"a": a, "b": b})

    return m.groupBy("key", "low", "high").applyInArrow(cell, "a long, b long").where("a < b").distinct()


def slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a shingle is counted, in each of the two rows."""
    x = mix(keys ^ np.uint64(0xC0117))
    return (x % np.uint64(SLOTS)).astype(np.int64), ((x >> np.uint64(32)) % np.uint64(SLOTS)).astype(np.int64) + SLOTS


def loose_entries(loose: DataFrame, docs: DataFrame, id: str, text: str) -> DataFrame:
    """(key, set, n, rest, reach): the prefixes of loose sets, shingles ordered from the rarest among the loose. `rest` is how
    many shingles a set can share from here on, `reach` the size of the largest set that it can link with by so many.

    Any order of shingles that is the same for all sets is right; this one is by approximate counts, the lesser of two in rows
    of SLOTS counters, whatever the number of shingles. They are never too small: a shingle counted once is in one set alone."""
    spark = loose.sparkSession

    def shingled(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                keys = [s.tobytes() for s in shingle_sets(batch.column(1).to_pylist(), WIDTH)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["set", "keys"])

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task = np.zeros(2 * SLOTS, np.uint32), TaskContext.get().partitionId()
        for batch in it:
            for x in slots(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)):
                np.add.at(total, x, np.uint32(1))
        blocks = np.minimum(total, MOST).astype(np.uint16).reshape(-1, 1 << 16)
        used = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.full(len(used), task // 256)), pa.array([blocks[i].tobytes() for i in used], pa.binary())], ["block", "part", "counts"])

    def together(t: pa.Table) -> pa.Table:
        total = np.zeros(1 << 16, np.uint32)
        for x in t.column("counts"):
            total = np.minimum(total + np.frombuffer(x.as_buffer(), np.uint16), MOST)
        return pa.table({"block": t.column("block")[:1], "part": t.column("part")[:1], "counts": pa.array([total.astype(np.uint16).tobytes()], pa.binary())})

    sets = stage(texts_of(loose, docs, id, text).mapInArrow(lean(shingled), "set long, keys binary"), "loose")
    schema = "block long, part long, counts binary"  # parts of a table of counters; few come together in one task
    counts = sets.select("keys").mapInArrow(lean(counted), schema).groupBy("block", "part").applyInArrow(together, schema).groupBy("block").applyInArrow(together, schema)
    table = np.zeros((2 * SLOTS >> 16, 1 << 16), np.uint16)
    for r in stage(counts, "loose-counts").toArrow().to_pylist():  # 4 * SLOTS bytes in all
        table[r["block"]] = np.frombuffer(r["counts"], np.uint16)
    table = table.ravel()
    sent = spark.sparkContext.broadcast(table)

    def prefixes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for who, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = np.frombuffer(blob, np.uint64)
                one, two = slots(s)
                df = np.minimum(sent.value[one], sent.value[two])
                s, df, n = s[df > 1], df[df > 1], len(s)
                s = s[np.lexsort((s, df))]
                rest = len(s) - np.arange(len(s), dtype=np.int64)
                reach = rest * (DEN + NUM) // NUM - n
                far = reach * DEN >= n * NUM
                m = int(far.sum())
                if m:
                    yield pa.RecordBatch.from_arrays([pa.array(s[far].view(np.int64)), pa.array(np.full(m, who, np.int64)), pa.array(np.full(m, n, np.int64)), pa.array(rest[far]), pa.array(reach[far])], ["key", "set", "n", "rest", "reach"])

    return stage(sets.mapInArrow(lean(prefixes), "key long, set long, n long, rest long, reach long"), "entries")


def reachable(entries: DataFrame, name: str) -> DataFrame:
    """Entries without those that no size in their group can reach: a partner is as large as the group's least at least, and
    reaches at most as far as the group's furthest."""
    ends = entries.groupBy(F.col("key").alias("r_key")).agg(F.min("n").alias("least_n"), F.max("reach").alias("most_reach"), F.min("set").alias("one"), F.max("set").alias("two")).where("one <> two")
    ends = few(stage(ends.select("r_key", "least_n", "most_reach"), f"{name}-ends"))
    out = entries.join(ends, (entries["key"] == ends["r_key"]) & (ends["least_n"] <= entries["reach"]) & (entries["n"] <= ends["most_reach"]))
    return stage(out.select(*entries.columns), f"{name}-reachable")


def entry_stars(entries: DataFrame) -> DataFrame:
    """(a, b): each entry with that of its group which shares the greatest part of itself, where their sizes fit."""
    best = F.max(F.struct((F.col("rest") / F.col("n")).alias("part"), F.col("set").alias("set"), F.col("n").alias("n"), F.col("reach").alias("reach")))
    centre = entries.groupBy(F.col("key").alias("c_key")).agg(best.alias("c"))
    both = entries.join(few(stage(centre, "centres")), F.col("key") == F.col("c_key")).where("set <> c.set AND n <= c.reach AND c.n <= reach")
    return both.select(F.least("set", "c.set").alias("a"), F.greatest("set", "c.set").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(member, component): the least member reachable. Alternating large and small stars, each staged."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    last = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    same = False
    while not same:
        # Large star: every node sends its larger neighbours to the least of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("m", "u").alias("m"))
        large = both.join(least, both["u"] == least["k"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        moved = large.join(least, large["u"] == least["k"])
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = stage(small, "edges")
        mark = new.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        same, last, edges = mark == last, mark, new
    return edges.select(F.col("u").alias("member"), F.col("v").alias("component"))


def spanning(docs: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, sets, links): (doc, n, set), (set, n, rep, spare), and linked pairs (a, b) of distinct sets, as many as
    connect every component, not all of them."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stage(grouped(signed(docs, id, text, partitions), partitions), "signed")
    documents = rows.where("kind = 0").select("doc", "n", "set", "spare", "text_hash", "sketch")
    one = F.min(F.struct("doc", "text_hash"))  # a text that has the set
    sets = documents.where("n > 0 AND doc IS NOT NULL").groupBy("set").agg(F.max("n").alias("n"), one.alias("one"), F.min("spare").alias("spare"), F.max("sketch").alias("sketch"))
    sets = stage(sets.select("set", "n", F.col("one.doc").alias("rep"), F.col("one.text_hash").alias("rep_hash"), "spare", "sketch"), "sets")

    groups = rows.where("kind = 1").groupBy("key", "set").agg(F.min("least").alias("least"), F.sum("weight").alias("weight"))
    groups = stage(groups, "groups")
    around = stage(sizes_fit(star(groups), sets), "stars")
    links = verify(around, sets, docs, id, text, "stars")
    mixed = stage(with_labels(labelled(groups, labels_of(links), "groups")), "mixed")
    more = across(mixed.where(F.col("labels") <= GROUP)).join(around, ["a", "b"], "left_anti")
    links = links.unionByName(verify(stage(sizes_fit(more, sets), "across"), sets, docs, id, text, "across"))

    hot = mixed.where(F.col("labels") > GROUP).groupBy("set").agg(F.sum("weight").alias("hot")).withColumnRenamed("set", "hot_set")
    loose = sets.join(hot, sets["set"] == hot["hot_set"], "left").where(F.col("spare") - F.coalesce("hot", F.lit(0)) <= 0)
    loose = stage(loose.select("set", "rep", "rep_hash"), "loose-sets")
    if not loose.isEmpty():
        entries = reachable(loose_entries(loose, docs, id, text), "loose")
        around = stage(entry_stars(entries).join(links, ["a", "b"], "left_anti"), "loose-stars")
        links = links.unionByName(verify(around, sets, docs, id, text, "loose-stars"))
        mixed = reachable(labelled(entries.select("key", "set", "n", "reach"), labels_of(links), "loose"), "loose-mixed")
        more = across_blocks(mixed.select("key", "set", "label", "reach"), sets).join(around, ["a", "b"], "left_anti")
        links = links.unionByName(verify(stage(more, "loose-across"), sets, docs, id, text, "loose-across"))
    return documents, sets, links


# ---- all links ---------------------------------------------------------------------------------------------


def common_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """How many elements each of the left sets has in common with each of the right ones."""
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    value = np.concatenate([*left, *right])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    column = np.cumsum(np.concatenate([[False], value[1:] != value[:-1]]))
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    column = np.cumsum(np.concatenate([[False], column[1:] != column[:-1]])) if len(column) else column
    out = np.zeros((len(left), len(right)), np.int64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, (low, low + width))
        dense = np.zeros((len(left) + len(right), int(column[j - 1]) - low + 1), np.float32)  # sums to `width` are exact
        dense[owner[i:j], column[i:j] - low] = 1
        out += (dense[: len(left)] @ dense[len(left) :].T).astype(np.int64)
    return out


def counted(documents: DataFrame, sets: DataFrame) -> DataFrame:
    """Sets with their copies, the number of distinct documents that have the set."""
    copies = documents.where("n > 0 AND doc IS NOT NULL").select("doc", "set").distinct().groupBy("set").agg(F.count(F.lit(1)).alias("copies"))
    return stage(sets.select("set", "n", "rep", "rep_hash").join(copies, "set"), "counted")


def members(links: DataFrame, sets: DataFrame) -> DataFrame:
    """(c, set, n, rep, rep_hash, copies, m, block): the sets of each component of two or more, m in number, in blocks by size."""
    found = components(links)
    found = found.unionByName(found.select(F.col("component").alias("member"), "component").distinct())
    g = found.join(sets, found["member"] == sets["set"]).select(F.col("component").alias("c"), "set", "n", "rep", "rep_hash", "copies")
    whole = W.partitionBy("c")
    order = whole.orderBy("n", "set").rowsBetween(W.unboundedPreceding, W.currentRow)
    block = F.floor((F.row_number().over(whole.orderBy("n", "set")) - 1) / BLOCK) + F.floor(F.sum("n").over(order) / ELEMENTS)
    return stage(g.withColumn("m", F.count(F.lit(1)).over(whole)).withColumn("block", block), "members")


def cells(parts: DataFrame, docs: DataFrame, id: str, text: str, run, schema: str, name: str) -> DataFrame:
    """run(members, rows, columns) of the linked pairs of every two blocks of a component whose sizes can link, staged."""
    many = parts.where("m > 2")  # two sets that are a component are linked
    size = stage(many.groupBy("c", "block").agg(F.min("n").alias("least"), F.max("n").alias("most")), f"{name}-blocks")
    low, high = (size.select(F.col("c").alias(f"c_{x}"), F.col("block").alias(x), F.col("least").alias(f"least_{x}"), F.col("most").alias(f"most_{x}")) for x in ("low", "high"))
    near = low.join(high, F.col("c_low") == F.col("c_high")).where(f"low <= high AND least_high * {NUM} <= most_low * {DEN}").select("c_low", "low", "high")
    near = near.withColumn("own", F.explode(F.array_distinct(F.array("low", "high"))))
    texts = stage(texts_of(many, docs, id, text).withColumnRenamed("set", "t_set"), f"{name}-texts")
    own = many.join(texts, many["set"] == texts["t_set"])
    rows = own.join(near, (own["c"] == near["c_low"]) & (own["block"] == near["own"])).select("c", "low", "high", "block", "set", "copies", "t")

    def cell(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        block, a, b = t.column("block").to_numpy(), t.column("low")[0].as_py(), t.column("high")[0].as_py()
        key, hashes = t.column("set").to_numpy(), list(shingle_sets(t.column("t").to_pylist(), WIDTH))
        i, j = np.flatnonzero(block == a), np.flatnonzero(block == b)
        n = np.array([len(s) for s in hashes], np.int64)
        common = common_counts([hashes[x] for x in i], [hashes[x] for x in j])
        good = DEN * common >= NUM * (n[i][:, None] + n[j][None, :] - common)
        if a == b:
            good &= key[i][:, None] < key[j][None, :]
        x, y = np.nonzero(good)
        return run(t, i[x], j[y])

    out = stage(rows.groupBy("c", "low", "high").applyInArrow(cell, schema), name)
    unstage(texts)
    return out


def twos(parts: DataFrame) -> DataFrame:
    """(a, b): the components of two sets."""
    return parts.where("m = 2").groupBy("c").agg(F.min("set").alias("a"), F.max("set").alias("b")).select("a", "b")


def link(docs: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, sets, links) as from spanning(), but with all linked pairs (a, b) of distinct sets, a < b, once each."""
    documents, sets, links = spanning(docs, id, text)
    parts = members(links, counted(documents, sets))

    def run(t: pa.Table, x: np.ndarray, y: np.ndarray) -> pa.Table:
        key = t.column("set").to_numpy()
        return pa.table({"a": np.minimum(key[x], key[y]), "b": np.maximum(key[x], key[y])})

    return documents, sets, twos(parts).unionByName(cells(parts, docs, id, text, run, "a long, b long", "all-links"))


def links_by_set(links: DataFrame, sets: DataFrame, docs: DataFrame, id: str, text: str) -> DataFrame:
    """(l_set, copies, linked): of each set its copies, and the documents with a set that is linked with it. Cells add up
    their own, so no row is made for a pair."""
    parts = members(links, sets)

    def run(t: pa.Table, x: np.ndarray, y: np.ndarray) -> pa.Table:
        copies, total = t.column("copies").to_numpy(), np.zeros(t.num_rows, np.int64)
        np.add.at(total, x, copies[y])
        np.add.at(total, y, copies[x])
        return pa.table({"set": t.column("set"), "linked": total})

    many = cells(parts, docs, id, text, run, "set long, linked long", "all-linked")
    two = parts.where("m = 2").withColumn("linked", F.sum("copies").over(W.partitionBy("c")) - F.col("copies")).select("set", "linked")
    linked = many.unionByName(two).groupBy("set").agg(F.sum("linked").alias("linked"))
    return sets.join(linked, "set", "left").select(F.col("set").alias("l_set"), "copies", F.coalesce("linked", F.lit(0)).alias("linked"))


def labelled_documents(documents: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, set) of each row, from links that connect the components."""
    found = components(links)
    part = sets.join(found, sets["set"] == found["member"], "left").select("set", "rep", F.coalesce("component", "set").alias("c"))
    least = part.groupBy("c").agg(F.min("rep").alias("component_id")).withColumnRenamed("c", "least_c")
    part = part.join(least, part["c"] == least["least_c"]).select(F.col("set").alias("p_set"), "component_id")
    out = documents.select("doc", "n", "set").join(part, documents["set"] == part["p_set"], "left")
    return out.select(
        F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"), "set",
    )


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: what needs no more than the spanning links."""
    return labelled_documents(*spanning(docs, id, text)).drop("set")


def join(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, n_links: a document's links are the other documents at Jaccard >= threshold, exact
    copies among them. An id with several texts counts once for each of its sets; rows with a null id are not counted, and
    have n_links only where they have a component."""
    documents, sets, links = spanning(docs, id, text)
    per_set = links_by_set(links, counted(documents, sets), docs, id, text)
    out = labelled_documents(documents, sets, links).join(per_set, F.col("set") == F.col("l_set"), "left")
    n_links = F.col("copies") + F.col("linked") - F.col("doc_id").isNotNull().cast("long")
    return out.select("doc_id", "n_shingles", "component_id", F.when(F.col("n_shingles") > 0, n_links).otherwise(F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component stays, that with the least id; so do those without words."""
    stay = classes(docs, id, text).where("n_shingles = 0 OR doc_id IS NULL OR doc_id = component_id").select(F.col("doc_id").alias("stay_id")).distinct()
    return docs.join(stay, docs[id].eqNullSafe(stay["stay_id"]), "left_semi")
