"""Odd tables for the operators and the pipeline: clashes, repeats, empty and very long texts, empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strider.llm import decontamination, jaccard_join, language_id, quality_classifier
from strider.llm.common import shared_dir
from tests.llm import brute
from tests.llm.test_native import EDGE, frame, words

CLASH = ("score", "predicted", "set", "key", "n", "text_hash", "held_out", "lang_pred", "w", "d_id", "item_id", "bad_id", "ids", "__text", "stay_id")


def crowded(docs):
    """The documents with columns named like the operators' own."""
    for c in CLASH:
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    return docs


def test_letters_of_all_scripts_in_many_short_texts():
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    texts = ["".join(letters[i::4096]) for i in range(4096)]
    doc, (gram, _), n = language_id._grams(texts, 3)
    assert (np.diff(doc) >= 0).all() and len(set(doc.tolist())) == 4096
    for i in (0, 2047, 2048, 4095):
        one = language_id._grams([texts[i]], 3)
        assert sorted(gram[doc == i].tolist()) == sorted(one[1][0].tolist()) and n[doc == i].sum() == one[2].sum()


@pytest.fixture(scope="module")
def small(spark):
    texts = [*EDGE, *[words(i, 60) for i in range(30)], *[words(i, 60) for i in range(5)], "long " * 60_000, words(999, 30_000)]
    docs = frame(spark, texts).withColumn("source", F.lit("web")).withColumn("n_chars", F.length("text").cast("long"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(25)], "doc_id long, quality int, toxic int")
    return docs, labels, texts


def test_clashing_columns_are_kept(spark, small):
    docs, labels, _ = small
    own = crowded(docs)
    good = quality_classifier.keep_good(own, labels)
    assert good.columns == own.columns and good.where("score <> 'own score' OR __text <> 'own __text'").count() == 0
    assert good.count() == quality_classifier.keep_good(docs, labels).count()
    one = jaccard_join.keep_one(own)
    assert one.columns == own.columns and one.count() == jaccard_join.keep_one(docs).count()
    bench = spark.createDataFrame([(1, words(3, 60)), (2, None), (3, "")], "item_id long, text string")
    clean = decontamination.decontaminate(own, bench)
    assert clean.columns == own.columns and clean.count() == docs.count() - 2


def test_repeated_labels_and_ids_count_once(spark, small):
    docs, labels, _ = small
    many = docs.unionByName(docs).unionByName(docs)
    wide = labels.unionByName(labels)
    a, b = (quality_classifier.score(docs, quality_classifier.fit(d, l, least=10**9)).orderBy("doc_id").collect() for d, l in ((docs, labels), (many, wide)))
    assert [r.score for r in a] == pytest.approx([r.score for r in b])


def test_equal_ids_are_judged_by_their_own_text(spark):
    docs = spark.createDataFrame([(3, words(1, 50)), (5, words(1, 50)), (5, words(2, 50)), (5, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id, r.n_shingles) for r in jaccard_join.classes(docs).collect()) == [(3, 3, 46), (5, 3, 46), (5, 5, 0), (5, 5, 46)]


def test_a_large_loose_group(spark):
    """Thousands of texts around one, most of them too far from each other; some not linked with any."""
    rng, base = np.random.Generator(np.random.PCG64(3)), words(5, 150).split()
    texts = [" ".join(base)]
    for i in range(1500):
        w = list(base)
        for k in rng.choice(len(w), int(rng.integers(1, 9)), replace=False):
            w[k] = f"e{i}x{k}"
        texts.append(" ".join(w))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.classes(frame(spark, texts)).collect()}
    sets = [brute.shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = {s: i for i, s in enumerate(set().union(*sets))}
    table = np.zeros((len(sets), len(index)), np.float32)
    for i, s in enumerate(sets):
        table[i, [index[x] for x in s]] = 1
    common, n = table @ table.T, table.sum(1)
    for a, b in zip(*np.nonzero(np.triu(100 * common >= 75 * (n[:, None] + n[None, :] - common), 1))):
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert got == {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_a_shared_folder_is_asked_for(spark, monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})

    with pytest.raises(ValueError):
        shared_dir(Session)


def test_pipeline(spark, small, tmp_path):
    docs, labels, texts = small
    sf = f"file://{tmp_path}/sf"
    crowded(docs).write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, words(3, 60)), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "PII", "SentencePiece encoding"]
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, rows, sf)
        assert out.columns == rows.columns, name
        rows = corpus_pipeline.stage(out, "test")
    want = {r.doc_id: r.text for r in rows.collect()}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == set(want) and 0 < len(got) < len(texts) - 5
    # by plain Python: of the texts that the classifier keeps one of each group, without those that hold the item
    good = {r.doc_id: r.text for r in quality_classifier.keep_good(docs, labels).collect()}
    groups = brute.components(list(good.items()))
    item = brute.shingles(words(3, 60))
    kept = {i for i, t in good.items() if groups[i][0] == 0 or groups[i][1] == i}
    assert set(got) == {i for i in kept if 100 * len(item & brute.shingles(good[i])) < 75 * len(item)}


def test_pipeline_of_empty_tables(spark, small, tmp_path):
    docs, labels, _ = small
    sf = f"file://{tmp_path}/none"
    docs.limit(0).write.parquet(f"{sf}/documents.parquet")
    labels.limit(0).write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
