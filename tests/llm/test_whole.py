"""That the operators do the whole job: all links, all texts, all languages."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strider.llm import jaccard_join, language_id, quality_classifier
from strider.llm.common import batches
from tests.llm import brute
from tests.llm.test_free import corpus
from tests.llm.test_native import EDGE, frame, words

# ---- op9: all links ----------------------------------------------------------------------------------------


def all_links(texts):
    """Pairs of linked documents, exact copies among them."""
    sets = [brute.shingles(t) for t in texts]
    return {(i, j) for i, j in combinations(range(len(texts)), 2) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}


@pytest.mark.parametrize("block", [4, 128])
def test_every_link_is_found(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    texts = corpus()
    want = all_links(texts)
    got = {r.doc_id: r for r in jaccard_join.join(frame(spark, texts)).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: sum(i in p for p in want) for i in range(len(texts))}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute.components(list(enumerate(texts)))
    documents, sets, links = jaccard_join.link(frame(spark, texts))
    rep = {r.set: r.rep for r in sets.collect()}
    own = sorted(tuple(sorted((rep[r.a], rep[r.b]))) for r in links.collect())
    assert own == sorted(p for p in want if set(p) <= set(rep.values()) and len({brute.shingles(texts[i]) for i in p}) == 2)


def test_common_counts():
    rng = np.random.Generator(np.random.PCG64(3))
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (0, 1, 5, 30, 90, 200)]
    for width in (7, 8192):
        assert jaccard_join.common_counts(sets[:4], sets, width).tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:4]]


def test_links_of_copies_and_null_ids(spark):
    text = words(5, 40)
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (3, text + " more"), (4, None), (None, words(6, 9))], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.n_links) for r in jaccard_join.join(docs).collect() if r.doc_id or r.n_shingles > 30)
    assert got == [(0, 36, 3), (1, 36, 2), (1, 36, 2), (2, 36, 2), (3, 37, 2), (4, 0, 0)]
    assert jaccard_join.join(frame(spark, EDGE).limit(0)).count() == 0


def test_a_null_id_before_its_copy_loses_no_link(spark):
    text = words(8, 60)
    rows = [(None, text), (1, text), (2, text + " more"), (None, "a b"), (3, "a b"), (4, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sets = jaccard_join.spanning(docs)[1].collect()
    assert len(sets) == 4 and all(r.sketch is not None and r.spare < 1 << 30 for r in sets)
    got = sorted((r.doc_id or 0, r.component_id, r.n_links) for r in jaccard_join.join(docs).collect())
    assert got == [(0, 1, 2), (0, 3, 1), (1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 0)]


# ---- op4: corpus counts over all documents -------------------------------------------------------------------


def test_word_vectors_cover_every_text(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "HELD", 50)
    monkeypatch.setattr(quality_classifier, "CELL", 60)
    texts = [words(i, 80, 40) for i in range(40)] + EDGE + ["ab " * 700]
    got = quality_classifier.word_vectors(frame(spark, texts).repartition(3)).toArrow()
    found = dict(zip(got.column("w").to_numpy().view(np.uint64).tolist(), quality_classifier.unpack(got.column("v").combine_chunks()).tolist()))
    count, near = {}, {}
    for t in texts:
        h = quality_classifier.tokens([b for _, p in batches([t]) for b in p])[0] if t else []
        index = quality_classifier.index_vectors(np.array(h, np.uint64)).astype(int)
        for i, w in enumerate(h):
            count[int(w)] = count.get(int(w), 0) + 1
            around = [index[j] for j in range(max(0, i - 2), min(len(h), i + 3))]  # itself among them
            near[int(w)] = near.get(int(w), 0) + sum(around)
    assert found == {w: near[w].tolist() for w in count if count[w] >= 3}


def rated(spark):
    texts = [words(i, 60, 300) for i in range(60)] + [" ".join(w.upper() + "!!" for w in words(500 + i, 60, 300).split()) for i in range(60)]
    texts += [*EDGE, texts[0], *["unseen words of texts without labels"] * 3]
    return frame(spark, texts), spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")


def test_unlabelled_texts_and_rare_tokens_have_vectors(spark):
    docs, labels = rated(spark)
    known, _ = quality_classifier.fit(docs, labels).vectors.of(np.unique(quality_classifier.tokens([b"unseen words of texts without labels"])[0]))
    assert known.all() and not hasattr(quality_classifier, "MAX_VOCAB")


@pytest.mark.parametrize("most", [0, 150])
def test_joined_vectors_score_like_broadcast_ones(spark, monkeypatch, most):
    docs, labels = rated(spark)
    want = {r.doc_id: r.score for r in quality_classifier.judge(docs, labels).collect()}
    monkeypatch.setattr(quality_classifier, "BROADCAST_TOKENS", most)
    monkeypatch.setattr(quality_classifier, "CELL", 500)
    vectors, rest = quality_classifier.held(quality_classifier.word_vectors(docs))
    assert len(vectors) <= most and (len(vectors) > 0) == (most > 0) and rest.count() > 0
    got = {r.doc_id: r.score for r in quality_classifier.judge(docs, labels).collect()}
    assert got.keys() == want.keys() and len(got) == docs.count() and all(abs(got[i] - want[i]) < 1e-3 for i in want)
    assert quality_classifier.keep_good(docs, labels).columns == docs.columns


# ---- op1: every language is learned --------------------------------------------------------------------------


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_every_language_has_its_sample(spark, most):
    rows = [(i, f"word {i}", "en") for i in range(400)] + [(400 + i, "1 2 3" if i % 2 else None, "xx") for i in range(60)] + [(500 + i, f"mot {i}", "fr") for i in range(7)]
    rows += [(508, "1 2", "xx"), (509, "\u65e5\u672c", "xx"), (None, "x", "en"), (510, "x", None)] + [(511, "same id", "de")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.training_rows(docs, F.lit(True), most)
    assert {r.lang: r.n for r in got.groupBy("lang").agg(F.countDistinct("doc_id").alias("n")).collect()} == {"en": min(most, 400), "fr": min(most, 7), "xx": 1, "de": 1}
    assert set(language_id.learn(got)) == {"en", "fr", "xx", "de"}
    first = docs.where("lang = 'en' AND doc_id IS NOT NULL").orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(most)
    assert {r.doc_id for r in got.where("lang = 'en'").collect()} == {r.doc_id for r in first.collect()}
