"""Jaccard join, pieces, training order, WARC audit, language id and quality classifier."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strider.llm import jaccard_join, language_id, pieces, quality_classifier, training_order, warc
from strider.llm.common import batches, shared_dir, shingle_sets
from tests.llm import brute
from tests.llm.test_native import EDGE, frame, words

# ---- hashing and the join ----------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbÉ \n\x0b\x1f", max_size=40), min_size=1, max_size=6))
def test_shingle_sets_are_sets_of_word_runs(texts):
    hashes, real = list(shingle_sets(texts)), [brute.shingles(t) for t in texts]
    assert [len(h) for h in hashes] == [len(r) for r in real]
    for i, a in enumerate(real):
        for j, b in enumerate(real):
            assert (set(hashes[i].tolist()) == set(hashes[j].tolist())) == (a == b)


def test_batches_cover_all():
    texts = ["a" * 700, None, "b" * 700, "", "c" * 5000]
    assert [(i, len(p)) for i, p in batches(texts, 1000)] == [(0, 2), (2, 2), (4, 1)]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 11, 20, 60, 300, 1500])
def test_linked_sets_share_a_signature(size):
    rng = np.random.Generator(np.random.PCG64(size))
    for _ in range(60):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        drop = int(rng.integers(0, size // 4 + 1))
        add = int(rng.integers(0, size // 4 + 2))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
        a = np.unique(a)
        common = len(np.intersect1d(a, b))
        if not len(b) or 100 * common < 75 * (len(a) + len(b) - common):
            continue
        sig, who, spare = jaccard_join.signatures([a, b])
        shared = set(sig[who == 0].tolist()) & set(sig[who == 1].tolist())
        assert len(shared) >= spare.max() and (shared or (spare <= 0).all())


def test_signatures_enumerate_subsets_of_parts():
    s = np.random.Generator(np.random.PCG64(5)).integers(0, 2**63, 400, dtype=np.uint64)
    sig, who, _ = jaccard_join.signatures([s, s[:-1]])
    n1 = sum(int(jaccard_join.N1[x[0]]) for x in jaccard_join.bands(np.array([400])) if x[0] >= 0)
    assert len(set(sig[who == 0].tolist())) == (who == 0).sum() <= 3 * n1
    # one shingle less: of its first-level part only the subset without it is still met, in each band
    both = set(sig[who == 0].tolist()) & set(sig[who == 1].tolist())
    assert (who == 0).sum() - len(both) in (2, 4)


def near(text, seed, share):
    r, w = random.Random(seed), text.split()
    for _ in range(max(1, int(len(w) * share))):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


def corpus():
    base = [words(i, 20 + 17 * i, 5000) for i in range(14)]
    common = words(77, 40, 5000)
    texts = [*EDGE, *base, *base[:5], *[near(b, s, 0.03) for b in base for s in range(3)], *[near(base[9], s, 0.012) for s in range(60)]]
    texts += [f"{common} {words(1000 + i, 12, 5000)}" for i in range(50)] + [f"{words(2000 + i, 3, 5000)} {words(77, 7, 5000)}" for i in range(60)]
    chain = words(55, 120, 5000).split()
    texts += [" ".join(chain[i * 3 : i * 3 + 90]) for i in range(10)]  # each like the next, the ends unlike
    return texts + [t.upper() for t in base[:3]]


def test_join_matches_plain_python(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP", 8)  # so that small families already go the way of large ones
    texts = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(frame(spark, texts)).collect()}
    assert got == brute.components(list(enumerate(texts)))


@pytest.mark.parametrize("sizes", [(1, 1, 1), (40, 10, 5), (300, 200, 150), (64, 0, 3000)])
def test_sketches_never_differ_more_than_sets(sizes):
    rng = np.random.Generator(np.random.PCG64(sum(sizes)))
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in sizes)
    x, y = np.unique(np.concatenate([common, a])), np.unique(np.concatenate([common, b]))
    assert jaccard_join.parity_distance(jaccard_join.parity(x), jaccard_join.parity(y)) <= len(np.setxor1d(x, y))


def test_join_edges(spark):
    docs = frame(spark, EDGE)
    one = jaccard_join.keep_one(docs)
    assert one.columns == docs.columns and {0, 1, 2} <= {r.doc_id for r in one.collect()}
    twice = jaccard_join.join(docs.unionByName(docs)).collect()
    assert len(twice) == 2 * len(EDGE) and all(r.component_id == r.doc_id for r in twice)
    assert jaccard_join.join(docs.limit(0)).count() == 0
    null_id = docs.withColumn("doc_id", F.when(F.col("doc_id") != 7, F.col("doc_id")))
    assert jaccard_join.join(null_id).where("doc_id IS NULL").first().n_shingles == 1


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (901, 900)], "a long, b long")
    got = {r.member: r.component for r in jaccard_join.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {901: 900}


# ---- pieces ------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.read_model(pieces.model_path()))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abe nt\nrsß é①.,0 "), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_equal_the_librarys_and_decode(codec, library, text):
    ids = codec.encode(text).tolist()
    assert ids == library.encode(text)
    assert codec.decode(ids) == text.replace("▁", " ")


def test_long_words_and_query_form(spark, codec, library):
    texts = [*EDGE, "ab" * 20_000, "the  quick   brown\n\n\nfox"]
    rows = {r.doc_id: r for r in pieces.encode(frame(spark, texts).withColumn("ids", F.lit(1))).collect()}
    assert all(rows[i].round_trip and rows[i].ids == library.encode(t or "") and rows[i].n_tokens == len(rows[i].ids) for i, t in enumerate(texts))
    df = pieces.encode(frame(spark, texts))
    assert {r.doc_id: r.text for r in pieces.decode(df).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert pieces.encode(frame(spark, texts).limit(0)).count() == 0


def unigram():
    text = {"▁": -4.0, "a": -3.0, "b": -3.1, "c": -3.2, "ab": -4.5, "abc": -6.0, "bc": -4.4, "▁a": -3.5, "▁ab": -5.5, "cab": -5.0, "aa": -5.9}
    return {"pieces": ["<unk>", *text], "scores": [0.0, *text.values()], "types": [2] + [1] * len(text), "prefix": True, "bpe": False}, text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcx ", max_size=9))
def test_unigram_models_get_the_best_score(text):
    model, score = unigram()
    own, worst = pieces.Codec(model), min(model["scores"]) - 10
    t = "▁" + text.replace(" ", "▁") if text else ""
    best = [0.0] + [-1e18] * len(t)
    for e in range(1, len(t) + 1):
        for s in range(e):
            p = t[s:e]
            if p in score or e - s == 1:
                best[e] = max(best[e], best[s] + score.get(p, worst))
    ids = own.encode(text).tolist()
    assert abs(sum(worst if i == 0 else model["scores"][i] for i in ids) - best[-1]) < 1e-9


# ---- training order ----------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_permutation(n, key):
    p = training_order.permute(np.arange(n), n, key)
    assert sorted(p.tolist()) == list(range(n)) and (training_order.permute(p, n, key, back=True) == np.arange(n)).all()


def test_tokens_decode(spark):
    own = training_order.Encoder(open(training_order.ranks_path(), "rb").read())
    for t in [*EDGE, "it's  <|endoftext|>\u00a0é🙂\n"]:
        assert own.own.decode(own.encode(t).tolist()) == (t or "")


def test_shards_hold_every_sequence_once(spark, tmp_path):
    texts = [*EDGE, *[words(i, 400 * i, 900) for i in range(6)]]
    path = f"file://{tmp_path}/shards"
    docs = frame(spark, texts).repartition(3)
    assert training_order.materialise(docs, path, length=64, per_shard=16) == path
    rows = training_order.read_shards(spark, path, 64).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    own = training_order.Encoder(open(training_order.ranks_path(), "rb").read())
    for i, t in enumerate(texts):
        ids = np.array([*own.encode(t), training_order.END], "<u2")
        mine = sorted((r.part, r.n_tokens, r.token_crc) for r in rows if r.doc_id == i)
        assert mine == [(k, len(c), zlib.crc32(c.tobytes())) for k, c in enumerate(np.split(ids, range(64, len(ids), 64)))]
    files = sorted((tmp_path / "shards").glob("shard=*/part-*"))
    assert len(files) == -(-len(rows) // 16)
    data = files[1].read_bytes()  # direct, sequential reads: slot s is at (s % per_shard) * stride
    size = training_order.stride(64)
    assert [training_order.HEAD.unpack_from(data, k * size)[0] for k in range(len(data) // size)] == list(range(16, 16 + len(data) // size))


def drop(shard):
    for f in [*shard.iterdir()]:
        f.unlink()
    shard.rmdir()


def contents(rows):
    return sorted((r.slot, r.doc_id, r.part, r.token_crc) for r in rows)


def test_resume_keeps_one_numbering(spark, tmp_path, monkeypatch):
    path, docs = f"file://{tmp_path}/shards", frame(spark, [words(i, 40 * i) for i in range(1, 40)])
    with monkeypatch.context() as m:  # the first call breaks off when its shards are written, and some are lost
        m.setattr(training_order, "write_shards", lambda *a, f=training_order.write_shards: (f(*a), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            training_order.materialise(docs.repartition(3), path, length=64, per_shard=16)
    whole = contents(training_order.read_shards(spark, path, 64).collect())
    kept = sorted((tmp_path / "shards").glob("shard=*"))
    for k in (0, 2, 3, len(kept) - 1):
        drop(kept[k])
    training_order.materialise(docs.repartition(5), path, length=64, per_shard=16)  # split otherwise
    assert contents(training_order.read_shards(spark, path, 64).collect()) == whole
    assert len({x[1:] for x in whole}) == len(whole) == len({x[0] for x in whole})
    assert training_order.materialise(docs, path, length=64, per_shard=16) == path  # all is there


def test_another_table_is_refused(spark, tmp_path):
    path, docs = f"file://{tmp_path}/shards", frame(spark, [words(1, 300), words(2, 30)])
    training_order.materialise(docs, path, length=64, per_shard=16)
    before = contents(training_order.read_shards(spark, path, 64).collect())
    for other, kw in ((docs.limit(1), {}), (docs.withColumn("doc_id", F.col("doc_id") + 1), {}), (docs, {"key": 5}), (docs, {"length": 32})):
        with pytest.raises(ValueError):
            training_order.materialise(other, path, **({"length": 64, "per_shard": 16} | kw))
    assert contents(training_order.read_shards(spark, path, 64).collect()) == before


def test_shards_of_odd_rows(spark, tmp_path):
    docs = frame(spark, ["a b", "a b", None, ""]).withColumn("doc_id", F.when(F.col("doc_id") < 2, F.lit(7))).withColumn("slot", F.lit("clash")).withColumn("mark", F.lit(0))
    rows = training_order.read_shards(spark, training_order.materialise(docs, f"file://{tmp_path}/odd")).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in rows) == [(-1, 1), (-1, 1), (7, 3), (7, 3)] and sorted(r.slot for r in rows) == [0, 1, 2, 3]
    assert training_order.read_shards(spark, training_order.materialise(docs.limit(0), f"file://{tmp_path}/none")).count() == 0


# ---- warc --------------------------------------------------------------------------------------------------


def pages(spark, n=3000):
    return spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>") for i in range(n)], "page_id long, url string, html string")


def test_audit_finds_exactly_the_damage(spark):
    p = pages(spark)
    got = warc.fixity(p, warc.damaged(p)).collect()
    want = {i for i in range(3000) if zlib.crc32(str(i).encode()) % 97 == 0}
    assert {r.page_id for r in got if r.status == "differs"} == want and len(got) == 3000 and want
    assert {r.status for r in warc.fixity(p, p).collect()} == {"same"}


def test_tree_matches_plain_python(spark):
    import hashlib

    recs = warc.records(pages(spark, 40), per_file=64)
    own, tree = warc.build(recs, "t", fanout=4, per_file=64)
    sha = lambda kind, data: hashlib.sha256(kind + data).digest()
    leaf = [sha(b"\x00", bytes(r.record)) for r in recs.orderBy("id").collect()]
    level = [sha(b"\x01", sha(b"\x01", h + (1).to_bytes(8, "big"))) for h in leaf]
    while len(level) > 1:
        level = [sha(b"\x01", b"".join(level[i : i + 4])) for i in range(0, len(level), 4)]
    root = tree.orderBy(F.desc("level")).first()
    assert root.hash == level[0].hex() and root.from_offset == 0 and root.to_offset == own.agg(F.sum("length")).first()[0]


def findings(own, other):
    return sorted((r.page_id is None, r.page_id, r.status) for r in warc.fixity(own, other).collect() if r.status != "same")


def test_one_loss_one_insertion_or_one_swap_is_one_finding(spark):
    p = pages(spark, 50)
    less = p.where("page_id <> 7")
    assert findings(p, less) == [(False, 7, "only_own")]
    assert findings(less, p) == [(False, 7, "only_other")]
    got = {r.page_id: r.moved for r in warc.fixity(p, less).collect()}
    assert all(got[i] == (i > 7) for i in range(50) if i != 7)
    swapped = p.withColumn("page_id", F.expr("CASE page_id WHEN 3 THEN 4 WHEN 4 THEN 3 ELSE page_id END"))
    assert findings(p, swapped) == [(False, 3, "differs"), (False, 4, "differs")]
    assert findings(p, p.unionByName(p.where("page_id = 9"))) == [(False, 9, "copies_differ")]
    assert findings(p, p.limit(0)) == [(False, i, "only_own") for i in range(50)]


def test_many_records_of_one_id(spark):
    p = spark.range(6000).select(F.lit(5).cast("long").alias("page_id"), F.lit("u").alias("url"), F.col("id").cast("string").alias("html"))
    got = warc.fixity(p, p.where("html <> '77'")).collect()
    assert len(got) == 6000 and [r.status for r in got if r.status != "same"] == ["only_own"]
    ends = sorted((r.offset, r.offset + r.length) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_audit_edges(spark):
    p = spark.createDataFrame([(1, None, None), (None, "u", "x"), (None, "u", "x"), (2, "v", "y"), (2, "v", "y")], "page_id long, url string, html string").withColumn("file", F.lit("clash"))
    got = warc.fixity(p, p).collect()
    assert {r.status for r in got} == {"same"} and sorted(r.copies for r in got) == [1, 2, 2]
    assert findings(p, p.where("page_id <> 1")) == [(False, 1, "only_own"), (True, None, "only_own")]
    assert warc.fixity(p.limit(0), p.limit(0)).count() == 0


# ---- language and quality ----------------------------------------------------------------------------------

TONGUES = {"en": "the and of this that with from then other which", "fr": "le la des une dans pour avec être très où", "de": "der die und nicht für über ein sich mit auch"}


def prose(lang, seed, n=60):
    r = random.Random(f"{lang}{seed}")
    return " ".join(r.choice(TONGUES[lang].split()) for _ in range(n))


def test_languages(spark):
    rows = [(i, prose(list(TONGUES)[i % 3], i), list(TONGUES)[i % 3]) for i in range(90)] + [(90 + i, t, None) for i, t in enumerate(EDGE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.judge(docs).collect()}
    assert all(got[i].lang_pred == rows[i][2] for i in range(90))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= got[i].score <= 1 for i in got)
    assert [got[90 + i].lang_pred for i in (0, 1, 2)] == ["und"] * 3
    assert {r.lang_pred for r in language_id.judge(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.judge(docs.limit(0)).count() == 0


def test_rank_order_distance_matches_plain_python():
    from collections import Counter

    def profile(text):
        count = Counter()
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            for n in (1, 2, 3):
                padded = word if n == 1 else f" {word} "
                count.update(padded[i : i + n] for i in range(len(padded) - n + 1))
        return [g for g, _ in sorted(count.items(), key=lambda x: (-x[1], len(x[0]), x[0]))][:300]

    texts = [prose(x, 1, 40) for x in TONGUES] + ["Ça va, où? 12 x", "a"]
    learned = {x: profile(" ".join(prose(x, s) for s in range(5))) for x in TONGUES}
    packed = {x: [sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g)) for g in p] for x, p in learned.items()}
    labels, scores = language_id.score_texts(texts, packed)
    for text, label, score in zip(texts, labels, scores):
        own = profile(text)
        distance = {x: sum(abs(learned[x].index(g) - r) if g in learned[x] else 300 for r, g in enumerate(own)) for x in learned}
        assert label == min(sorted(distance), key=distance.get) and abs(score - (1 - distance[label] / (300 * len(own)))) < 1e-9


def test_quality_model(spark):
    good = [words(i, 60, 300) for i in range(150)]
    bad = [" ".join(w.upper() + "!!" for w in words(500 + i, 60, 300).split()) for i in range(60)] + ["For " * 200] * 5
    texts = good + bad + EDGE
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(len(good) + len(bad))] + [(1, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_classifier.judge(docs, labels).collect()}
    out = [r for i, r in got.items() if r.held_out and i < len(good) + len(bad)]
    assert len(out) > 20 and np.mean([r.predicted == int(r.doc_id < 150) for r in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values()) and len(got) == len(texts)
    kept = quality_classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}


@pytest.mark.parametrize("labels", [[], [(0, 1), (3, 1)]])
def test_quality_model_without_both_classes(spark, labels):
    df = spark.createDataFrame(labels, "doc_id long, quality int")
    assert all(r.score > 0.3 for r in quality_classifier.judge(frame(spark, EDGE), df).collect())


def test_shared_folder_is_the_sessions(spark):
    assert spark.conf.get("spark.checkpoint.dir") == shared_dir(spark)
