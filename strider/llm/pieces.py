"""SentencePiece encoding and decoding by an Aho-Corasick automaton over the pieces and one pass over the text.

The automaton meets every piece that ends at a position, longest first along its output links, and the pass relaxes the
best way to reach that position. What "best" means is the model's: for a unigram model the score summed so far, longest
piece first on ties (Viterbi); for a BPE model, whose scores are only the order of its merges, summed scores would not
give the model's own segmentation, so a piece is accepted where it and the piece before it are exactly what the merges
make of the two together. Exactly one piece can end a position in that sense, so the pass is the same and the ids equal
those of the public library. Characters that no piece covers fall back to bytes, or to <unk> where the model has none.

No piece has a blank mark after another character, so text is cut before each run of blanks and units are encoded once
per Python process while they stay in a bounded cache. Decoding joins the pieces' bytes.

Defined results: null and empty texts have no ids; white space is kept; a literal U+2581 decodes to a blank, as it does in
the public library; repeated rows are encoded each; very long words are a single unit and take linear time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strider.llm.common import KEPT, lean

MARK = "▁"
CACHE = 300_000
MODEL = "piece_bpe_32k.model"


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_model(path: str) -> dict:
    """Pieces, scores, kinds and the normaliser's settings of a SentencePiece model file; read on the driver."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    if m.normalizer_spec.name not in ("", "identity") or m.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models with the identity normaliser that keep white space are supported")
    return {
        "pieces": [p.piece for p in m.pieces],
        "scores": [p.score for p in m.pieces],
        "types": [p.type for p in m.pieces],
        "prefix": m.normalizer_spec.add_dummy_prefix,
        "bpe": m.trainer_spec.model_type == 2,
    }


class Codec:
    """Encoder and decoder of one model, from what read_model() returns."""

    def __init__(self, model: dict, cache: int = CACHE):
        import ahocorasick

        self.pieces, self.scores, self.bpe, self.prefix = model["pieces"], model["scores"], model["bpe"], model["prefix"]
        types = model["types"]  # 1 normal, 2 unknown, 3 control, 4 user defined, 5 unused, 6 byte
        self.unk = types.index(2) if 2 in types else 0
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, types)) if t == 6}
        self.automaton = ahocorasick.Automaton()
        self.rank = {}
        for i, (p, t) in enumerate(zip(self.pieces, types)):
            if t in (1, 4):
                self.automaton.add_word(p, (i, len(p)))
                self.rank[p] = i
        self.automaton.make_automaton()
        self.closed = all(c in self.rank for p in self.rank for c in p)  # else merges start from characters without a piece
        self.newline = not any("\n" in p for p in self.rank)
        self.whole = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.rank)
        self.raw = [b"" if t in (2, 3) else bytes([int(p[3:5], 16)]) if t == 6 else p.replace(MARK, " ").encode() for p, t in zip(self.pieces, types)]
        self.most, self.cache, self.pairs = cache, {"": ()}, {}

    def merges(self, text: str) -> list[str]:
        """What the model's merges make of a short text: always the best-ranked neighbours first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or self.scores[r] > best):
                    best, at = self.scores[r], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, a: int, b: int) -> bool:
        """Whether merges leave the pieces a and b side by side as they are."""
        key = a * 1_000_003 + b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            found = self.pairs[key] = self.merges(self.pieces[a] + self.pieces[b]) == [self.pieces[a], self.pieces[b]]
        return found

    def unit(self, text: str) -> tuple[int, ...]:
        """Encode one unit. last[e] is the piece that ends at e on the best way there, None while there is none."""
        if self.bpe and not self.closed:
            return tuple(chain.from_iterable([self.rank[x]] if x in self.rank else self.fallback(x) for x in self.merges(text)))
        n = len(text)
        last: list = [-1] + [None] * n
        size = [1] * (n + 1)
        done = 0  # positions up to here are settled: one that no piece reached is a fallback character
        if self.bpe:
            agree = self.agree
            for end, (i, length) in self.automaton.iter(text):
                while done < end:
                    done += 1
                    if last[done] is None:
                        last[done] = -1
                e = end + 1
                if last[e] is None:
                    p = last[e - length]
                    if p == -1 or agree(p, i):
                        last[e], size[e] = i, length
            for e in range(done + 1, n + 1):
                if last[e] is None:
                    last[e] = -1
        else:
            best = [0.0] + [-np.inf] * n
            worst = min(self.scores) - 10.0
            for end, (i, length) in chain(self.automaton.iter(text), [(n, (None, 0))]):
                while done < end:  # whatever ends before is settled; a position without any way is a fallback character
                    done += 1
                    if last[done] is None:
                        last[done], best[done] = -1, best[done - 1] + worst
                if i is not None:
                    value = best[end + 1 - length] + self.scores[i]
                    if value > best[end + 1] or last[end + 1] is None:
                        last[end + 1], size[end + 1], best[end + 1] = i, length, value
        out, e = [], n
        while e > 0:
            if last[e] == -1:
                out += reversed(self.fallback(text[e - 1]))
                e -= 1
            else:
                out.append(last[e])
                e -= size[e]
        return tuple(reversed(out))

    def fallback(self, c: str) -> list[int]:
        return [self.bytes.get(x, self.unk) for x in c.encode("utf-8", "surrogatepass")] if self.bytes else [self.unk]

    def units(self, text: str) -> list[str]:
        t = (" " if self.prefix else "") + text
        if self.whole:
            return [t.replace(" ", MARK)]
        if "  " in t or MARK in t:
            return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", t.replace(" ", MARK))
        t = t.replace(" ", " " + MARK)
        return (t.replace("\n", " \n ") if self.newline else t).split(" ")

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        units, cache = self.units(text), self.cache
        if len(cache) > self.most:
            cache.clear()
            cache[""] = ()
        for u in set(units).difference(cache):
            cache[u] = self.unit(u)
        return np.fromiter(chain.from_iterable(map(cache.__getitem__, units)), np.int32)

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


def codec(key: str, sent) -> Codec:
    """This process's codec for a broadcast model, kept until another operator works here."""
    if KEPT.get("pieces", ("",))[0] != key:
        KEPT.pop("pieces", None)
        KEPT["pieces"] = key, Codec(sent.value)
    return KEPT["pieces"][1]


def _sent(spark: SparkSession, path: str | None):
    """The model, about a megabyte, broadcast under a key of its own."""
    return uuid.uuid4().hex, spark.sparkContext.broadcast(read_model(path or model_path()))


def encode(docs: DataFrame, text: str = "text", path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ids, n_tokens and round_trip (whether decoding gives the text again); one narrow pass, no shuffle."""
    key, sent = _sent(docs.sparkSession, path)
    df = docs.select(*keep, F.col(text).alias("__text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(key, sent)
        for batch in it:
            k = len(keep)
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(k).to_pylist()
                ids = [own.encode(t) for t in texts]
                same = [own.decode(i.tolist()) == (t or "") for i, t in zip(ids, texts)]
                sizes = np.fromiter((len(i) for i in ids), np.int64, len(ids))
                flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)
                cols = [*part.columns[:k], pa.array(sizes), lists, pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, [*keep, "n_tokens", "ids", "round_trip"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields[: len(keep)])
    return df.mapInArrow(lean(run, "pieces"), f"{fields}n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The texts of id lists."""
    key, sent = _sent(encoded.sparkSession, path)
    df = encoded.select(*keep, F.col(ids).alias("__ids"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(key, sent)
        for batch in it:
            texts = [own.decode(x or ()) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, "text"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields[: len(keep)])
    return df.mapInArrow(lean(run, "pieces"), f"{fields}text string")
