"""URL reputation, decontamination, quality rules and personal data, against plain Python."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strider.llm import decontamination, pii, quality_rules, url_filters
from tests.llm import brute

EDGE = [None, "", "  \n\t ", "a", "a b c d", "x\x0by\x0cz", "A B C D E F", "word " * 60, "l1\nl1\n\nl1\n \n", "é ß 日本 # $ % 🙂 a b", "a b c a b c a b c d", "one two three four one two three five"]


def frame(spark, texts, **more):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def words(seed, n, vocabulary=30):
    r = random.Random(seed)
    return " ".join(r.choice("abcdefghij") + str(r.randrange(vocabulary)) for _ in range(n))


# ---- quality rules -----------------------------------------------------------------------------------------


def test_base_counts_match_plain_python(spark):
    texts = EDGE + [words(i, 10 + 40 * i, 4) for i in range(8)] + ["\n".join([words(1, 9)] * 3 + [words(2, 9)]), words(3, 20_000, 400), "w" * 50_000]
    got = {r.doc_id: tuple(r)[3:] for r in quality_rules.base_counts(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = brute.base_counts(t)
        n, chars, symbols, dup, rep = want[0], want[1], want[2], want[3], want[4]
        assert got[i] == (n, chars, symbols, dup, rep), (i, (t or "")[:40])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n#é", max_size=60), min_size=1, max_size=8))
def test_base_counts_on_random_texts(spark, texts):
    got = {r.doc_id: tuple(r)[3:] for r in quality_rules.base_counts(frame(spark, texts)).collect()}
    assert got == {i: brute.base_counts(t)[:5] for i, t in enumerate(texts)}


def test_outliers_go_and_clean_texts_stay(spark):
    clean = [words(i, 80 + i % 300, 900) for i in range(300)]
    noisy = [" ".join(w + "###" * 4 for w in words(i, 90, 900).split()) for i in range(6)]
    docs = spark.createDataFrame([(i, t, "en", "hot" if i % 3 else "s1") for i, t in enumerate(clean + noisy)], "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(300, 306))


def test_quality_edges(spark):
    docs = frame(spark, EDGE).withColumn("g", F.lit(1)).withColumn("n_words", F.lit("clash"))
    got = quality_rules.judge(docs.unionByName(docs)).collect()
    assert len(got) == 2 * len(EDGE) and all(r.kept is False and r.base_failed for r in got if r.doc_id != 7)
    assert quality_rules.judge(docs.limit(0)).count() == 0


# ---- personal data -----------------------------------------------------------------------------------------

PRIVATE = [
    "mail ab.c@x.org, a@b, @c.de x@y.z.", "ips 1.2.3.4.5 256.1.1.1 10.0.0.255 1.1.1", "card 4111 1111 1111 1111 and 4111-1111-1111-1112 12345678901234", "tel +49 (30) 1234-5678 +1 2 +123456789012345678",
    "a@b.com_x@y.z é🙂 q@w.e", "+1 (738) 555-4493", "1" * 5000, "a." * 3000, "no digits here", "0.0.0.0 00000.1.1.1 001.2.3.4", "4111111111111111+4912345678901", "a@b.c@d.e", "9 9 9 9-9 9 9 9 9 9 9 9 9 9 9 9 9 9 9 9",
]


def test_base_spans_match_plain_python(spark):
    texts = EDGE + PRIVATE
    got = {r.doc_id: r for r in pii.digest(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = brute.base_spans(t)
        assert got[i].base_sha256 == brute.span_hash(t), (t, want, got[i].spans)
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(sum(s.startswith(k) for s in want) for k in ("email", "ip", "card", "phone"))
        assert set(want) <= set(filter(None, got[i].spans.split(",")))


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="01239a@.+- ()é_", max_size=50), min_size=1, max_size=12))
def test_base_spans_on_random_texts(spark, texts):
    got = {r.doc_id: r.base_sha256 for r in pii.digest(frame(spark, texts)).collect()}
    assert got == {i: brute.span_hash(t) for i, t in enumerate(texts)}


def test_method_adds_confirmed_spans_and_redacts(spark):
    texts = ["iban DE89370400440532013000 ok DE89370400440532013001 no", "social security 123-45-6789 but 123-45-6789 alone is far" + " x" * 40, "call 555-123-4567 now", "x@y.org 🙂 10.0.0.1", None]
    docs = frame(spark, texts).withColumn("n_chars", F.length("text").cast("long"))
    got = {r.doc_id: r.spans for r in pii.digest(docs).collect()}
    assert got[0] == "iban:5:27" and got[1].startswith("ssn:16:27") and got[2] == "national_phone:5:17" and got[4] == ""
    red = {r.doc_id: r for r in pii.redacted(docs).collect()}
    assert red[0].text == "iban <IBAN> ok DE89370400440532013001 no" and red[3].text == "<EMAIL> 🙂 <IP>" and red[3].n_chars == len(red[3].text) and red[4].text is None
    assert pii.redacted(docs).columns == docs.columns and pii.digest(docs.limit(0)).count() == 0


# ---- decontamination ---------------------------------------------------------------------------------------


def test_leaks_match_plain_python(spark):
    items = [(i, words(i, 6 + 9 * i, 500)) for i in range(6)] + [(6, "just three words"), (7, ""), (8, None), (9, "Solo"), (10, words(3, 33, 500))]
    long = words(99, 3000, 500)
    texts = EDGE + [f"{long} {t} {long}" for _, t in items if t] + [f"{items[4][1].upper()} {long}", " ".join(items[5][1].split()[3:]), " ".join(items[5][1].split()[:30]) + " cut " + " ".join(items[5][1].split()[31:]), "x just three words", "solo"]
    docs, bench = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(list(enumerate(texts)), items)
    got = {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in decontamination.leaks(docs, bench).collect()}
    assert got == want and len(want) >= 12
    kept = decontamination.decontaminate(docs, bench)
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want} and kept.columns == docs.columns
    twice = decontamination.leaks(docs.unionByName(docs), bench.unionByName(bench))
    assert {(r.doc_id, r.item_id) for r in twice.collect()} == set(want) and twice.count() == len(want)


def test_leaks_without_rows(spark):
    docs, bench = frame(spark, EDGE), spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(docs, bench).count() == 0 and decontamination.leaks(docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


# ---- urls --------------------------------------------------------------------------------------------------

URLS = [
    ("http://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"), ("http://EXAMPLE.org/en/15?q#f", "example.org", "/en/15", "example.org/en/1", "block"), ("https://b.org/x", "b.org", "/x", "org/", "allow"),
    ("https://b.org", "b.org", "", None, "allow"), ("http://x.com/fr/1#t", "x.com", "/fr/1", "com/fr/", "allow"), ("http://x.com/de/?a", "x.com", "/de/", "com/de/", "block"), ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("http://com", "com", "", None, "allow"), ("x://y?z://w/", "y", "", None, "allow"), ("://Ä.COM/fr/", "Ä.com", "/fr/", "com/fr/", "allow"),
]


def test_rules_and_parts(spark):
    df = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(df).collect()}
    assert got == {i: u[1:] for i, u in enumerate(URLS)}
    assert url_filters.judge(df.limit(0)).count() == 0


def test_bad_hosts_are_blocked_by_reputation(spark):
    rows = [("bad.x.net", 1)] * 40 + [("good.x.net", 0)] * 40 + [("mixed.y.net", i % 2) for i in range(20)] + [("worse.bad.info", 1)] * 30 + [("w2.bad.info", 1)] * 30
    labelled = spark.createDataFrame(rows, "host string, bad int")
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(["bad.x.net", "good.x.net", "mixed.y.net", "new.bad.info", "other.zz"])], "page_id long, url string")
    got = {r.page_id: r for r in url_filters.judge(pages, labelled=labelled).collect()}
    assert [got[i].verdict for i in range(5)] == ["block", "allow", "allow", "block", "allow"]
    assert got[0].bad_rate < 1 and got[1].bad_rate > 0 and got[0].bad_bound < got[0].bad_rate


@pytest.mark.parametrize("pairs", [[], [("a.b", None)]])
def test_reputation_without_labels(spark, pairs):
    pages = spark.createDataFrame([(1, "http://q.net/")], "page_id long, url string")
    labelled = spark.createDataFrame(pairs, "host string, bad int").where("bad IS NOT NULL")
    assert url_filters.judge(pages, labelled=labelled).first().verdict == "allow"


@pytest.mark.parametrize(("a", "b"), [(6.0, 1.0), (20.5, 1.2), (12.0, 9.0), (3.0, 40.0), (400.0, 100.0), (0.05, 3.0)])
def test_bound_against_a_summed_density(spark, a, b):
    """The quantile of beta(a, b) from its density, summed over a fine grid in the log-odds, where it has no pole."""
    t = np.linspace(-60, 60, 400_001)
    x = 1 / (1 + np.exp(-t))
    logs = -a * np.logaddexp(0, -t) - b * np.logaddexp(0, t)
    mass = np.cumsum(np.exp(logs - logs.max()))
    want = x[np.searchsorted(mass, 0.1 * mass[-1])]
    got = spark.range(1).select(url_filters.lower_bound(F.lit(a), F.lit(b), 0.9).alias("q")).first().q
    assert abs(got - want) < 0.03


def test_names_domains_and_suffixes(spark):
    hosts = ["u:p@a.x.com:8080", "shop.b.co.uk.", "co.uk", "10.0.0.1:80", "[::1]:443", "", "localhost", "a.b.org"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string").select(url_filters.name_of(F.col("host")).alias("n"))
    got = [tuple(r) for r in df.select("n", url_filters.domain_of(F.col("n")), url_filters.suffix_of(F.col("n"))).collect()]
    assert got == [
        ("a.x.com", "x.com", "com"), ("shop.b.co.uk", "b.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("10.0.0.1", "10.0.0.1", "(address)"),
        ("[::1]", "[::1]", "(address)"), ("", "", ""), ("localhost", "localhost", "localhost"), ("a.b.org", "b.org", "org"),
    ]


@pytest.mark.parametrize("most", [200_000, 0])
def test_outcomes_of_pages_decide_without_rules(spark, monkeypatch, most):
    """Both ways of joining; a host of many unwanted pages is blocked, copies and null columns are judged, other columns go."""
    monkeypatch.setattr(url_filters, "BROADCAST_HOSTS", most)
    monkeypatch.setattr(url_filters, "HOT_SHARE", 3)
    rows = [(i, "http://casino-x.site.net/en/1", "<p>fine</p>") for i in range(40)] + [(40 + i, f"http://h{i % 7}.good.net/en/", "casino <p>" + "word " * 50_000) for i in range(14)]
    rows += [(60 + i, "http://odd.page.net/", "<b>Casino</b> poker, PILLS") for i in range(30)] + [(99, None, None), (99, None, None)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, name string, `count` int")
    got = sorted((r.page_id, r.verdict) for r in url_filters.judge(pages).collect())
    assert got == sorted((i, "block" if i < 40 or 60 <= i < 90 else "allow") for i, *_ in rows)


def test_scores_follow_spans(spark):
    row = pii.digest(frame(spark, ["mail a@b.cd or +49 30 1234567 89"])).first()
    assert row.spans.split(",")[0].startswith("email:") and len(row.scores.split(",")) == len(row.spans.split(",")) and row.scores.split(",")[0] == "1.00"
