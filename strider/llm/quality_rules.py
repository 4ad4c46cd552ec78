"""Quality rules: base counts, then robust multivariate outliers by minimum covariance determinant.

Native: DataFrame functions only. The base counts and four transformed statistics of each document come from one pass
over the text; the statistics are rounded to thousandths and kept as integers, so that sums over rows are exact and a
lost task changes nothing. For each group (language and source) the estimate is the deterministic MCD: from each of three
starts (the half of the rows nearest to the medians, each feature scaled by its quartiles, in the Euclidean, the absolute
and the largest coordinate) a few C-steps are taken: mean and covariance of the `share` of rows nearest to the present
estimate. The start with the least determinant goes on until no group's determinant falls any more. The covariance then
gets the consistency factor of its share, rows within the chi-square's 0.975 quantile give the reweighted estimate with
its own factor, and a row is rejected where its squared Mahalanobis distance exceeds the 0.999 quantile. A step is a
partial aggregation to a few sums a group, its quantile comes from a histogram of distances (`BINS` bins an e-fold), and
estimates are broadcast after a count, so no task ever holds a group and a hot source costs no more than others.

Groups under `least` rows are pooled with the small groups of their language, and these, where still under `least`, with
all such rows; that last pool is judged at any size. FLOOR is added to every covariance's diagonal (a regularised MCD), so
that features that hardly vary, or pools of few rows, have an estimate too.

Defined results: null text has no words (base_failed, not kept), null language or source is a group of its own, repeated
rows count each, an empty table gives an empty result. Extra columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strider.llm.common import stage, words

#: Thousandths; the least standard deviation that each feature is taken to have.
FEATURES = ("f_len", "f_word", "f_sym", "f_rep")
FLOOR = (300.0, 300.0, 150.0, 60.0)
D = len(FEATURES)
STARTS = 3
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
#: Chi-square quantiles for four features at 0.975 and at 0.999.
CHI_NEAR, CHI_CUT = 11.143, 18.467
BINS = 200
Few = Callable[[DataFrame], DataFrame]
#: What has a row a group is broadcast up to so many groups, by count, and joined beyond.
BROADCAST_GROUPS = 30_000


def base_counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The contract's counts of every whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.select(
        *keep,
        words(t).alias("w"),
        F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    n = F.size("w")
    df = df.select(
        *keep, "word_chars", "n_symbols", n.cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 4, F.transform(F.slice("w", 1, n - 2), lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))).otherwise(F.expr("cast(array() as array<bigint>)")).alias("tri"),
    )
    # Only windows whose hash occurs again go on; most texts have few.
    bits = F.length(F.bin(F.size("tri").cast("long")))
    df = df.withColumn("bits", bits)
    dup = F.size("tri") > F.size(F.array_distinct("tri"))
    keys = F.array_sort(F.transform("tri", lambda h, i: F.call_function("shiftleft", h, F.col("bits")).bitwiseOR(i.cast("long"))))
    df = df.withColumn("keys", F.when(dup, keys).otherwise(F.expr("cast(array() as array<bigint>)")))
    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1
    spot = lambda key: key.bitwiseAND(low).cast("int")
    same = lambda a, b: F.coalesce((a.bitwiseXOR(b) <= low) & (a.bitwiseXOR(b) >= 0) & (F.get("tri", spot(a)) == F.get("tri", spot(b))), F.lit(False))
    twice = F.filter("keys", lambda k, i: same(k, F.get("keys", i + 1)) | ((i > 0) & same(k, F.get("keys", F.greatest(i - 1, F.lit(0))))))
    df = df.withColumn("spots", F.array_sort(F.transform(twice, spot)))
    covered = F.aggregate(
        "spots",
        F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")),
        lambda a: a["n"],
    )
    return df.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def statistics() -> list[Column]:
    """The transformed statistics, in thousandths: log length, word length, log of the symbols' share, repeats' share."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    milli = lambda c: F.round(c * 1000).cast("long")
    return [
        milli(F.log1p(n)).alias("f_len"),
        milli(4 * F.log1p(F.col("word_chars") / n)).alias("f_word"),
        milli(F.log1p(100 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)))).alias("f_sym"),
        milli((F.col("n_repeat_words") + 5 * F.col("n_dup_lines")) / n).alias("f_rep"),
    ]


def consistency(share: float, cut: float) -> float:
    """What the covariance of a normal sample's nearest `share`, within the squared distance `cut`, falls short by: the
    share over the chi-square distribution with two more degrees of freedom (here six) at `cut`."""
    h = cut / 2
    return share / (1 - math.exp(-h) * (1 + h + h * h / 2))


def chi_quantile(share: float) -> float:
    """The chi-square quantile for four features, by bisection of its distribution function."""
    low, high = 0.0, 100.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - math.exp(-mid / 2) * (1 + mid / 2) < share else (low, mid)
    return high


def moments(rows: DataFrame, *key: str) -> DataFrame:
    """Exact sums, then mean (mu) and covariance (c) of each group."""
    big = lambda c: c.cast("decimal(38,0)")
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    sums += [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}{j}") for i, j in PAIRS]
    g = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("m"), *sums)
    cov = lambda i, j: (big(F.col("m")) * big(F.col(f"s{i}{j}")) - big(F.col(f"s{i}")) * big(F.col(f"s{j}"))).cast("double") / F.col("m") / F.col("m")
    mu = [(F.col(f"s{i}") / F.col("m")).alias(f"mu{i}") for i in range(D)]
    return g.select(*key, *mu, *[cov(i, j).alias(f"c{i}{j}") for i, j in PAIRS])


def factored(fit: DataFrame, scale: float, *key: str) -> DataFrame:
    """The Cholesky factor (l) and the determinant's logarithm of the covariance times `scale`, plus the floor."""
    g = fit
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}") * scale + (FLOOR[i] ** 2 if i == j else 0.0)
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        g = g.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / F.col(f"l{j}{j}"))
    logdet = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(D)), F.lit(0.0)).alias("logdet")
    return g.select(*key, *[f"mu{i}" for i in range(D)], *[f"c{i}{j}" for i, j in PAIRS], *[f"l{i}{j}" for i, j in PAIRS], logdet)


def distances(rows: DataFrame, fit: DataFrame, key: tuple[str, ...], few: Few) -> DataFrame:
    """Add d2, the squared Mahalanobis distance to the row's group; null where the group has no estimate."""
    x = rows.join(few(fit), list(key), "left")
    for i in range(D):
        rest = F.col(FEATURES[i]) - F.col(f"mu{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        x = x.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(D)), F.lit(0.0))
    return x.withColumn("d2", d2).select(*rows.columns, "d2")


def quantiles(rows: DataFrame, key: tuple[str, ...], shares: tuple[float, ...]) -> DataFrame:
    """By group, for each share the least `bin` with that share of the rows at or below it: a histogram, then running sums
    over its bins, whose number does not grow with the rows."""
    bins = rows.groupBy(*key, "bin").agg(F.count(F.lit(1)).alias("c"))
    w = W.partitionBy(*key)
    run = bins.select(*key, "bin", F.sum("c").over(w.orderBy("bin")).alias("upto"), F.sum("c").over(w).alias("all"))
    at = [F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("bin"))).alias(f"q{i}") for i, share in enumerate(shares)]
    return run.groupBy(*key).agg(*at)


def nearest(rows: DataFrame, key: tuple[str, ...], share: float, few: Few) -> DataFrame:
    """The `share` of each group's rows with the least d2."""
    x = rows.withColumn("bin", F.round(F.log(F.greatest(F.col("d2"), F.lit(1e-4))) * BINS).cast("int"))
    return x.join(few(quantiles(x, key, (share,))), list(key)).where(F.col("bin") <= F.col("q0"))


def c_step(rows: DataFrame, fit: DataFrame, key: tuple[str, ...], share: float, few: Few) -> DataFrame:
    return factored(moments(nearest(distances(rows, fit, key, few), key, share, few), *key), 1.0, *key)


def starts(fit_rows: DataFrame, few: Few) -> DataFrame:
    """Every row once for each start, with d2 as that start measures it."""
    long = fit_rows.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(f) / 10).cast("int").alias("bin")) for i, f in enumerate(FEATURES)])).alias("f"))
    q = quantiles(long.select("g", "f.i", "f.bin"), ("g", "i"), (0.25, 0.5, 0.75))
    one = lambda i, c: F.max(F.when(F.col("i") == i, c))
    spread = (F.col("q2") - F.col("q0")) * 10 / 1.349
    scale = q.groupBy("g").agg(*[one(i, F.col("q1") * 10).alias(f"mid{i}") for i in range(D)], *[one(i, F.greatest(spread, F.lit(FLOOR[i]))).alias(f"s{i}") for i in range(D)])
    z = [F.abs((F.col(f) - F.col(f"mid{i}")) / F.col(f"s{i}")) for i, f in enumerate(FEATURES)]
    square, total = sum((c * c for c in z), F.lit(0.0)), sum(z, F.lit(0.0))
    most = F.greatest(*z)
    ways = F.array(*[F.struct(F.lit(k).alias("start"), d.alias("d2")) for k, d in enumerate((square, total * total, most * most))])
    return fit_rows.join(few(scale), "g").select("g", *FEATURES, F.explode(ways).alias("w")).select("g", "w.start", *FEATURES, "w.d2")


def mcd(fit_rows: DataFrame, few: Few, share: float = 0.75, first: int = 2, least_fall: float = 1e-3) -> DataFrame:
    """One row a group of (g, FEATURES) rows: the estimate of least determinant that the starts lead to.

    Each start takes `first` C-steps, the best goes on until no determinant's logarithm falls by `least_fall`; a step that
    does not lower a group's determinant is not taken, so the loop ends.
    """
    key = ("g", "start")
    fit = stage(factored(moments(nearest(starts(fit_rows, few), key, 0.5, few), *key), 1.0, *key), "start")
    each = fit_rows.withColumn("start", F.explode(F.array(*[F.lit(k) for k in range(STARTS)])))
    for _ in range(first):
        fit = stage(c_step(each, fit, key, share, few), "start")
    best = fit.groupBy("g").agg(F.min_by(F.struct(*[c for c in fit.columns if c not in key]), F.struct("logdet", "start")).alias("b"))
    fit = stage(best.select("g", "b.*"), "best")
    falls = True
    while falls:
        new = c_step(fit_rows, fit, ("g",), share, few)
        cols = [c for c in new.columns if c != "g"]
        both = new.select("g", F.struct(*cols).alias("n")).join(fit.select("g", F.struct(*cols).alias("o")), "g")
        lower = F.col("n.logdet") < F.col("o.logdet") - least_fall
        fit = stage(both.select("g", F.when(lower, F.col("n")).otherwise(F.col("o")).alias("f"), lower.alias("fell")).select("g", "f.*", "fell"), "step")
        falls = bool(fit.agg(F.max("fell")).first()[0])
        fit = fit.drop("fell")
    return fit


def grouped(rows: DataFrame, least: int) -> tuple[DataFrame, Few]:
    """Add `g`: language and source, or the pool of a language's small groups, or that of all small ones. Also returns the
    mark for frames with a row a group: a broadcast where the count of groups allows it."""
    lang, source = F.coalesce("lang", F.lit("\x00")), F.coalesce("source", F.lit("\x00"))
    keyed = rows.withColumn("g_lang", lang).withColumn("g_source", F.concat_ws("\x01", lang, source))
    sizes = stage(keyed.where("fit").groupBy("g_source", "g_lang").agg(F.count(F.lit(1)).alias("n")), "sizes")
    few = F.broadcast if sizes.count() <= BROADCAST_GROUPS else lambda df: df
    small = sizes.where(F.col("n") < least).groupBy("g_lang").agg(F.sum("n").alias("pool"))
    big = sizes.where(F.col("n") >= least).select("g_source", F.lit(True).alias("big"))
    small = small.where(F.col("pool") >= least).select("g_lang", F.lit(True).alias("small"))
    keyed = keyed.join(few(big), "g_source", "left").join(few(small), "g_lang", "left")
    g = F.when(F.col("big"), F.col("g_source")).when(F.col("small"), F.concat(F.lit("\x02"), F.col("g_lang"))).otherwise(F.lit("\x03"))
    return keyed.select(*rows.columns, g.alias("g")), few


def outliers(rows: DataFrame, share: float = 0.75, cut: float = CHI_CUT, least: int = 50) -> DataFrame:
    """Add `distance2` and `outlier` to staged rows with lang, source, FEATURES and `fit` (whether a row shapes the estimates)."""
    rows, few = grouped(rows, least)
    rows = stage(rows, "mcd")
    fit_rows = rows.where("fit").select("g", *FEATURES)
    raw = factored(mcd(fit_rows, few, share), consistency(share, chi_quantile(share)), "g")
    near = distances(fit_rows, raw, ("g",), few).where(F.col("d2") <= CHI_NEAR)
    final = stage(factored(moments(near, "g"), consistency(0.975, CHI_NEAR), "g"), "reweighted")
    scored = distances(rows, final, ("g",), few)
    return scored.select(*[c for c in rows.columns if c != "g"], F.round("d2", 4).alias("distance2"), F.coalesce(F.col("d2") > cut, F.lit(False)).alias("outlier"))


def judge(docs: DataFrame, **kw) -> DataFrame:
    """The contract's columns and `distance2` for every document."""
    counts = base_counts(docs.select("doc_id", "lang", "source", "text"))
    rows = stage(counts.select("*", base_failed().alias("base_failed"), *statistics(), (~base_failed()).alias("fit")), "counts")
    out = outliers(rows, **kw)
    ids = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return out.select(*ids, (~F.col("base_failed") & ~F.col("outlier")).alias("kept"), "distance2")
