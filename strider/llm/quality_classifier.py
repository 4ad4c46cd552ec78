"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network with calibrated output.

Tokens are runs of letters, digits or other signs (lower-cased A-Z), plus marks for capitals-only words and for a word
that repeats the one before. Each token has a fixed sparse ternary index vector drawn from its hash; a token's word
vector is its index vector plus the sum of its neighbours' index vectors over all texts, scaled to length one: these are
counts without labels, so every document adds to them, and the vocabulary is every token that occurs `least` times or more.
The sums are integers, so they are the same in whatever order tasks finish. Tokens outside the vocabulary use their index
vector. Up to BROADCAST_TOKENS vectors are broadcast, those of the most frequent tokens where there are more; the texts' other
tokens are joined with the rest. A document pools the mean and the root mean square of its tokens' vectors, with a few shape numbers; a numpy
network (tanh layer, then logistic) is fitted on labelled rows, and a temperature fitted on a part kept aside scales its
logit. At most `max_docs` labelled documents are fitted on, those first by a hash of their id; scores use whole texts.

Defined results: null and empty texts have zero vectors and are scored like any other; null labels are not learned
from; of several rows with a labelled id the one whose text comes first by hash is learned from, with the id's first label
by value, so that no id counts twice; every row is scored; with labels of one class only, or none, every score is the
smoothed label mean; keep_good() keeps all columns, also such as are named like its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.llm.common import batches, give_back, lean, mix, span_hashes, stage, unstage
from strider.llm.language_id import held_out

MAX_DOCS = 6_000
LEAST = 3  # a token that occurs less often keeps its index vector
BROADCAST_TOKENS = 1_500_000  # vectors that a model holds; how many there are is not bounded
HELD, LATE, CELL = 160_000, 32_000, 60_000  # tokens that a task sums up at a time, those that wait, and rows of a group, about
RANGES = 8  # of tokens, a power of two, one range's shuffle on disk at a time
DIM, NONZERO, WINDOW, HIDDEN = 48, 6, 2, 24
CAPITALS, REPEATED = np.uint64(0xA11CA95), np.uint64(0x2E9EA7)

#: Classes of bytes: 0 white space, 1 letters (and all of UTF-8's longer characters), 2 digits, 3 signs.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1


def tokens(part: list[bytes]):
    """Of a run of texts: token hashes, offsets by text (n + 1), capitals-only flags, repeat flags, classes."""
    raw = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
    low = np.frombuffer(raw.tobytes().lower(), np.uint8)
    kind = _CLASS[raw]
    edge = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    ends = np.append(edge[1:], len(kind))
    real = kind[edge] > 0
    starts, ends = edge[real], ends[real]
    h = span_hashes(low, starts, ends)
    upper = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90))])
    capital = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 1)
    bounds = np.cumsum([0] + [len(b) + 1 for b in part])
    at = np.searchsorted(starts, bounds)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[at[:-1][at[:-1] < len(h)]] = False
    return h, at, capital, again, kind[starts]


def index_vectors(h: np.ndarray) -> np.ndarray:
    """The sparse ternary vectors of token hashes, as int8 rows."""
    out = np.zeros((len(h), DIM), np.int8)
    rows = np.arange(len(h))
    for step in (np.arange(1, NONZERO + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)):
        x = mix(h + step)
        out[rows, (x % np.uint64(DIM)).astype(np.int64)] = np.where(x >> np.uint64(63), 1, -1)
    return out


def pack(rows: np.ndarray) -> list[bytes]:
    """Integer rows as bytes: int8 where all of a row fits, else int64."""
    small = (np.abs(rows) <= 127).all(axis=1)
    narrow = rows.astype(np.int8)
    return [narrow[i].tobytes() if small[i] else rows[i].astype(np.int64).tobytes() for i in range(len(rows))]


def unpack(packed: pa.Array) -> np.ndarray:
    """The int64 rows of pack()."""
    data = packed.to_pylist()
    wide = np.fromiter((len(b) != DIM for b in data), bool, len(data))
    out = np.empty((len(data), DIM), np.int64)
    out[~wide] = np.frombuffer(b"".join(b for b in data if len(b) == DIM), np.int8).reshape(-1, DIM)
    out[wide] = np.frombuffer(b"".join(b for b in data if len(b) != DIM), np.int64).reshape(-1, DIM)
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    v = rows.astype(np.float64)
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


class Sums:
    """Counts and vectors by token, summed as parts come in: in place for tokens that are there, the others wait in parts of
    LATE rows until they are put among them."""

    def __init__(self, kind: type = np.int32):
        self.w, self.n, self.v = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty((0, DIM), kind)
        self.late, self.waiting, self.tokens = [], 0, 0

    def add(self, w: np.ndarray, n: np.ndarray, v: np.ndarray) -> None:
        """A part; a token stands in it once."""
        self.tokens += int(n.sum())
        if len(self.w):
            spot = np.minimum(np.searchsorted(self.w, w), len(self.w) - 1)
            there = self.w[spot] == w
            self.n[spot[there]] += n[there]
            self.v[spot[there]] += v[there].astype(self.v.dtype)
            w, n, v = w[~there], n[~there], v[~there]
        if len(w):
            self.late.append((w, n, v))
            self.waiting += len(w)
            if self.waiting > LATE:
                self.settle()

    def settle(self) -> int:
        """Put what waits among the rest; returns how many tokens there are."""
        if self.late:
            w, n, v = (np.concatenate(x) for x in zip(*self.late))
            self.late, self.waiting = [], 0
            order = np.argsort(w, kind="stable")
            w = w[order]
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            n, v, w = np.add.reduceat(n[order], first), np.add.reduceat(v[order], first, axis=0, dtype=self.v.dtype), w[first]
            at = np.searchsorted(self.w, w)
            self.w, self.n, self.v = np.insert(self.w, at, w), np.insert(self.n, at, n), np.insert(self.v, at, v, axis=0)
        return len(self.w)

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.settle()
        return self.w, self.n, self.v


def neighbours(part: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, counts, summed index vectors of the tokens within WINDOW) of a run of texts."""
    h, at, *_ = tokens(part)
    words, spot = np.unique(h, return_inverse=True)
    if not len(h):
        return words, np.empty(0, np.int64), np.empty((0, DIM), np.int32)
    index = index_vectors(words)[spot]
    doc = np.repeat(np.arange(len(part)), np.diff(at))
    near = np.zeros((len(h), DIM), np.int8)  # 2 * WINDOW terms of -1, 0 or 1
    for gap in range(1, WINDOW + 1):
        same = (doc[gap:] == doc[:-gap]).astype(np.int8)[:, None]
        near[gap:] += index[:-gap] * same
        near[:-gap] += index[gap:] * same
    order = np.argsort(spot, kind="stable")
    count = np.bincount(spot, minlength=len(words))
    starts = np.concatenate([[0], np.cumsum(count)[:-1]])
    return words, count.astype(np.int64), np.add.reduceat(near[order], starts, axis=0, dtype=np.int32)


def in_range(k: int) -> Column:
    """Whether token `w` is in a range of the tokens' order, in which tasks write them: most pages of the others are not read."""
    low = (k << 64) // RANGES
    low -= 1 << 64 if low >= 1 << 63 else 0
    return F.col("w").between(low, low + (1 << 64) // RANGES - 1)


def word_vectors(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(w, v, level), staged: every token of the texts that occurs `least` times or more, its packed sum of vectors, and four times
    the logarithm of its count."""


    def rows_of(w: np.ndarray, n: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(w), 20_000):
            cut = slice(i, i + 20_000)
            yield pa.RecordBatch.from_arrays([pa.array(w[cut].view(np.int64)), pa.array(n[cut]), pa.array(pack(v[cut]), pa.binary())], ["w", "n", "v"])

    def gather(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in it:
            for _, part in batches(batch.column(0).to_pylist(), 1 << 18):
                sums.add(*neighbours(part))
                if len(sums.w) > HELD or sums.tokens > 1 << 28:  # so that int32 holds the sums
                    yield from rows_of(*sums.all())
                    sums = Sums()
        yield from rows_of(*sums.all())

    def total(t: pa.Table) -> pa.Table:
        sums = Sums(np.int64)
        for b in t.to_batches(max_chunksize=20_000):
            w, n, v = b.column("w").to_numpy().view(np.uint64), b.column("n").to_numpy(), unpack(b.column("v"))
            order = np.argsort(w, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], w[order][1:] != w[order][:-1]]))
            sums.add(w[order][first], np.add.reduceat(n[order], first), np.add.reduceat(v[order], first, axis=0))
        w, n, v = sums.all()
        del sums
        give_back()
        often = n >= least
        w, n, v = w[often], n[often], v[often]
        return pa.table({"w": pa.array(w.view(np.int64)), "v": pa.array(pack(v + index_vectors(w).astype(np.int64) * n[:, None]), pa.binary()), "level": np.floor(4 * np.log2(n)).astype(np.int32)})

    rows = stage(texts.select("text").mapInArrow(lean(gather), "w long, n long, v binary"), "token-sums")
    groups, out = max(1, -(-rows.count() // (CELL * RANGES))), None
    for k in range(RANGES):
        one = stage(rows.where(in_range(k)).groupBy(F.pmod(F.col("w"), F.lit(groups)).alias("g")).applyInArrow(total, "w long, v binary, level int"), "word-vectors")
        out = one if out is None else out.unionByName(one)
    unstage(rows)
    return out


def held(vectors: DataFrame) -> tuple["Vectors", DataFrame | None]:
    """The vectors of the most frequent tokens, at most BROADCAST_TOKENS, and the frame of the others if there are any."""
    cut, total, more = -1, 0, False
    for r in vectors.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 253 levels
        total += r["count"]
        if total > BROADCAST_TOKENS:
            cut, more = r["level"], True
            break
    often, parts = vectors.where(F.col("level") > cut).select("w", "v"), []  # bounded by BROADCAST_TOKENS
    for k in range(RANGES):  # one after another, so that the driver holds the arrays and a part of what they come from
        got = often.where(in_range(k)).toArrow().combine_chunks()
        w, v = got.column("w").to_numpy().view(np.uint64), pa.concat_arrays(got.column("v").chunks) if len(got) else pa.array([], pa.binary())
        order = np.argsort(w)
        wide, v = (pa.compute.binary_length(v).to_numpy() != DIM)[order], v.take(pa.array(order))
        small = np.frombuffer(b"".join(v.filter(pa.array(~wide)).to_pylist()), np.int8).reshape(-1, DIM)
        large = unit(np.frombuffer(b"".join(v.filter(pa.array(wide)).to_pylist()), np.int64).reshape(-1, DIM))
        parts.append((w[order], wide, small, large))
    known, wide, small, large = (np.concatenate(x) for x in zip(*parts))
    own = Vectors(vectors.sparkSession, known, wide, small, large)
    return own, vectors.where(F.col("level") <= cut).select("w", "v") if more else None


class Vectors:
    """Unit vectors of tokens, kept as the integers they came as and broadcast once; a copy of this is only a handle."""

    def __init__(self, spark: SparkSession, known: np.ndarray, wide: np.ndarray, small: np.ndarray, large: np.ndarray):
        place = np.where(wide, np.cumsum(wide), np.cumsum(~wide)).astype(np.int32) - 1
        self.sent = spark.sparkContext.broadcast((known, wide, place, small, large))

    @property
    def known(self) -> np.ndarray:
        return self.sent.value[0]

    def __len__(self) -> int:
        return len(self.known)

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, vectors) of distinct tokens; those that are not known have their index vector."""
        tokens_, wide_, place, small, large = self.sent.value
        spot = np.minimum(np.searchsorted(tokens_, h), max(0, len(tokens_) - 1))
        known = tokens_[spot] == h if len(tokens_) else np.zeros(len(h), bool)
        out = index_vectors(h).astype(np.float32) / np.sqrt(NONZERO)
        at, wide = spot[known], wide_[spot[known]] if len(tokens_) else np.zeros(0, bool)
        rows = np.empty((len(at), DIM), np.float32)
        if len(at):
            rows[~wide], rows[wide] = unit(small[place[at[~wide]]]), large[place[at[wide]]]
        out[known] = rows
        return known, out


MARKS = index_vectors(np.array([CAPITALS, REPEATED], np.uint64)).astype(np.float32) / np.sqrt(NONZERO)


def shapes(part: list[bytes]):
    """Of a run of texts: token hashes, offsets, texts that have tokens, and (capitals, repeats, signs, digits) shares of those."""
    h, at, capital, again, kind = tokens(part)
    full = np.flatnonzero(np.diff(at) > 0)
    if not len(full):
        return h, at, full, np.empty((0, 4), np.float32)
    size = np.diff(at)[full].astype(np.float32)
    return h, at, full, np.stack([np.add.reduceat(x.astype(np.float32), at[:-1][full]) / size for x in (capital, again, kind == 3, kind == 2)], axis=1)


def pooled(mean: np.ndarray, square: np.ndarray, known: np.ndarray, size: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """The features of texts from means over their tokens and shape numbers."""
    mean = mean + shape[:, :1] * MARKS[0] + shape[:, 1:2] * MARKS[1]
    return np.concatenate([mean, np.sqrt(square), shape, known[:, None], np.log1p(size)[:, None] / 10], axis=1)


def features(texts: list[str | None], vectors: Vectors) -> np.ndarray:
    """Pooled vectors and shape numbers of each text."""
    out = np.zeros((len(texts), 2 * DIM + 6), np.float32)
    for first, part in batches(texts, 1 << 18):
        h, at, full, shape = shapes(part)
        if not len(full):
            continue
        words, back = np.unique(h, return_inverse=True)
        known, own = vectors.of(words)
        v, starts, size = own[back], at[:-1][full], np.diff(at)[full].astype(np.float32)
        mean, square = (np.add.reduceat(x, starts, axis=0) / size[:, None] for x in (v, v * v))
        out[first + full] = pooled(mean, square, np.add.reduceat(known[back].astype(np.float32), starts) / size, size, shape)
    return out


def keyed(text: str) -> list:
    return [F.xxhash64(F.col(text)).alias("t1"), F.xxhash64(F.lit(1), F.col(text)).alias("t2")]


def joined_features(docs: DataFrame, vectors: Vectors, rest: DataFrame, text: str, then, field: str) -> DataFrame:
    """(t1, t2, then(features)) of each distinct text: tokens that are not among `vectors` find theirs in `rest` by a join. Copies
    of a text count in its means alike, which leaves them as they are."""

    # A row for each token of a text that is not held, and one with the shape numbers and the sums over its held tokens.
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            for first, part in batches(batch.column(2).to_pylist(), 1 << 18):
                h, at, full, shape = shapes(part)
                doc = np.repeat(np.arange(len(part)), np.diff(at))
                whole = np.zeros((len(part), 5 + 2 * DIM), np.float32)
                if len(full):
                    words, back = np.unique(h, return_inverse=True)
                    known, own = vectors.of(words)
                    own[~known] = 0
                    v, starts = own[back], at[:-1][full]
                    whole[full] = np.concatenate([shape, np.add.reduceat(known[back].astype(np.float32), starts)[:, None], np.add.reduceat(v, starts, axis=0), np.add.reduceat(v * v, starts, axis=0)], axis=1)
                    h, doc = h[~known[back]], doc[~known[back]]
                order = np.lexsort([h, doc])
                h, doc = h[order], doc[order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(h) else np.empty(0, np.int64)
                n = np.diff(np.append(new, len(h)))
                k = key[first + np.concatenate([doc[new], np.arange(len(part))])]
                w = pa.concat_arrays([pa.array(h[new].view(np.int64)), pa.nulls(len(part), pa.int64())])
                sizes = np.concatenate([n, np.diff(at)]).astype(np.int64)
                flat = pa.concat_arrays([pa.nulls(len(new), pa.binary()), pa.array([x.tobytes() for x in whole], pa.binary())])
                yield pa.RecordBatch.from_arrays([pa.array(k[:, 0]), pa.array(k[:, 1]), w, pa.array(sizes), flat], ["t1", "t2", "w", "n", "sums"])

    # Copies of a text give the same rows; one of each is enough, and keeps what comes together small.
    rows = docs.select(*keyed(text), F.col(text).alias("t")).mapInArrow(lean(run), "t1 long, t2 long, w long, n long, sums binary")
    staged = stage(rows, "text-tokens")
    groups = max(1, -(-staged.count() // CELL))
    rows = staged.groupBy("t1", "t2", "w").agg(F.max("n").alias("n"), F.first("sums").alias("sums"))

    def cell(t: pa.Table) -> pa.Table:
        t = t.sort_by([("t1", "ascending"), ("t2", "ascending"), ("w", "ascending")]).combine_chunks()
        a, b, n = (t.column(c).to_numpy() for c in ("t1", "t2", "n"))
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        owner = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(a))))
        token = ~t.column("w").is_null().to_numpy()
        one, at = np.flatnonzero(~token), np.flatnonzero(token)  # a text's own row comes last among its rows
        sums = np.frombuffer(b"".join(t.column("sums").take(pa.array(one)).to_pylist()), np.float32).reshape(len(one), -1)
        size = np.maximum(n[one], 1).astype(np.float32)
        known, mean, square = sums[:, 4].copy(), sums[:, 5 : 5 + DIM].copy(), sums[:, 5 + DIM :].copy()
        if len(at):
            found = pa.array(t.column("v").take(pa.array(at)).to_pylist(), pa.binary())
            have = ~found.is_null().to_numpy(zero_copy_only=False)
            own = index_vectors(t.column("w").take(pa.array(at)).to_numpy().astype(np.int64).view(np.uint64)).astype(np.float32) / np.sqrt(NONZERO)
            if have.any():
                own[have] = unit(unpack(found.filter(pa.array(have))))
            starts = np.flatnonzero(np.concatenate([[True], owner[at][1:] != owner[at][:-1]]))
            full, weight = owner[at][starts], n[at].astype(np.float32)
            known[full] += np.add.reduceat(have * weight, starts)
            mean[full] += np.add.reduceat(own * weight[:, None], starts, axis=0)
            square[full] += np.add.reduceat(own * own * weight[:, None], starts, axis=0)
        x = pooled(mean / size[:, None], square / size[:, None], known / size, size, sums[:, :4])
        x[n[one] == 0] = 0
        return pa.table({"t1": a[new], "t2": b[new], "x": then(x)})

    both = rows.join(rest, "w", "left").select("t1", "t2", "w", "n", "sums", "v")
    out = stage(both.groupBy(F.pmod(F.col("t1"), F.lit(groups)).alias("g")).applyInArrow(cell, f"t1 long, t2 long, x {field}"), "text-features")
    unstage(staged)
    return out


class Network:
    """tanh layer and logistic output on standardised features; fitted by Adam with full batches, from a fixed seed."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 300, rate: float = 0.02, decay: float = 1e-3, seed: int = 7):
        self.mean, self.scale = x.mean(0) if len(x) else 0.0, np.maximum(x.std(0), 1e-3) if len(x) else 1.0
        self.temperature, self.prior = 1.0, (y.sum() + 1) / (len(y) + 2)
        self.w1 = None
        if len(np.unique(y)) < 2:
            return
        rng = np.random.Generator(np.random.PCG64(seed))
        part = rng.random(len(y)) < 0.2
        if len(np.unique(y[part])) < 2 or len(np.unique(y[~part])) < 2:
            part[:] = False
        z, t = ((x - self.mean) / self.scale)[~part], y[~part]
        d = z.shape[1]
        p = [rng.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.array(np.log(t.mean() / (1 - t.mean())))]
        m, s = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        for k in range(1, epochs + 1):
            a = np.tanh(z @ p[0] + p[1])
            e = (1 / (1 + np.exp(-np.clip(a @ p[2] + p[3], -40, 40))) - t) / len(t)
            da = np.outer(e, p[2]) * (1 - a * a)
            grads = [z.T @ da + decay * p[0] / 10, da.sum(0), a.T @ e + decay * p[2] / 10, np.array(e.sum())]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                p[i] = p[i] - rate * (m[i] / (1 - 0.9**k)) / (np.sqrt(s[i] / (1 - 0.999**k)) + 1e-8)
        self.w1, self.b1, self.w2, self.b2 = p
        if part.any():  # the temperature that makes the part kept aside likeliest
            logit, t = self.logit(x[part]), y[part]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 200))
            loss = [np.mean(np.logaddexp(0, logit / g) - t * logit / g) for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.w1 is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -60, 60)))


class Model:
    """A network, the vectors it stands on, and the frame of those that are not held."""

    def __init__(self, vectors: Vectors, rest: DataFrame | None, network: Network):
        self.vectors, self.rest, self.network = vectors, rest, network


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, target: str = "quality", least: int = LEAST) -> Model:
    """Fit on labelled documents: (doc_id, text) and (doc_id, target); at most `max_docs` of them. Tokens that occur `least`
    times or more in the documents have word vectors."""
    wanted = labels.select(F.col("doc_id").alias("l_id"), F.col(target).cast("int").alias("y")).where("y IS NOT NULL AND l_id IS NOT NULL")
    wanted = wanted.groupBy("l_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64(F.lit(4), "l_id"), "l_id").limit(max_docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("l_id"))
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text"))  # one text an id, so that max_docs bounds what comes to the driver
    rows = stage(rows.groupBy("doc_id").agg(first.alias("text"), F.min("y").cast("int").alias("y")), "labelled")
    vectors, rest = held(word_vectors(docs, least))
    if rest is None:

        def pool(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in it:
                x = features(batch.column(1).to_pylist(), vectors)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), flat], ["doc_id", "y", "x"])

        pooled_rows = rows.mapInArrow(lean(pool), "doc_id long, y int, x array<float>")
    else:
        found = joined_features(rows, vectors, rest, "text", lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32())), "array<float>")
        pooled_rows = rows.select("doc_id", "y", *keyed("text")).join(found, ["t1", "t2"]).select("doc_id", "y", "x")
    got = pooled_rows.toArrow()  # bounded by max_docs
    x = np.stack(got.column("x").to_numpy()).astype(np.float64) if len(got) else np.zeros((0, 2 * DIM + 6))
    ids, y = got.column("doc_id").to_numpy(), got.column("y").to_numpy().astype(np.float64)
    order = np.lexsort([*x[:, :3].T, y, ids])
    return Model(vectors, rest, Network(x[order], y[order]))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add score and predicted to the kept columns: one narrow pass, or a join with the texts' features where not all of the
    model's vectors are held."""
    network, vectors = model.network, model.vectors
    if model.rest is not None:
        found = joined_features(docs, vectors, model.rest, text, lambda x: pa.array(network.probability(x.astype(np.float64)), pa.float64()), "double")
        found = found.select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), F.col("x").alias("score"))
        t1, t2 = keyed(text)
        out = docs.select(*keep, t1.alias("__k1"), t2.alias("__k2")).join(found, (F.col("__k1") == F.col("__t1")) & (F.col("__k2") == F.col("__t2")))
        return out.select(*keep, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    at = keep.index(text) if text in keep else len(keep)  # a text that is kept goes to Python once
    df = docs.select(*keep, *([F.col(text).alias("__text")] if at == len(keep) else []))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            p = network.probability(features(batch.column(at).to_pylist(), vectors).astype(np.float64))
            cols = [*batch.columns[: len(keep)], pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, [*keep, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[: len(keep)])
    return df.mapInArrow(lean(run), f"{fields}, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: labels of the held-out fold are not learned from."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"), 5, 0)))
    return score(docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "text"), model, keep=("doc_id", "held_out"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"), 5, 0)))
    own = {c: f"__{i}" for i, c in enumerate(docs.columns)}  # whatever the documents' columns are called
    scored = score(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]), model, text=own["text"], keep=tuple(own.values()))
    return scored.where(F.col("predicted") == 1).select(*[F.col(n).alias(c) for c, n in own.items()])
