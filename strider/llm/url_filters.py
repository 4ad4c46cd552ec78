"""URL filters: explicit host and path rules, then an empirical-Bayes reputation of hosts.

Native: DataFrame functions only. Labelled page outcomes (good or bad) are counted by host; the counts of hosts roll up
to registered domains and those to suffixes. At each level a beta-binomial prior, its mean and strength fitted by moments
over the groups below the parent, shrinks a group's bad rate toward its parent's: suffix toward the whole, registered
domain toward its suffix, host toward its domain. A host is blocked where the lower bound of its bad rate, the
1 - `confidence` quantile of its beta posterior (by the Cornish-Fisher expansion of the posterior's own moments), is above
`max_bad`. Outcomes come from the caller, or else from the pages themselves (see `outcome`), never from the rules.

A host's name for the reputation is the host without user info, port and trailing dots; the rules see the host as it is.

Defined results: a null url, or one without `://`, has an empty host and path, fits no rule and takes the reputation of
the empty name; a null html shows nothing bad; a name without labelled pages takes the prior its domain gives, else its
suffix's, else that of all (wide, where members differ, so that its bound is low); without any label the prior mean
`base_rate` holds and nothing is blocked by the method. Repeated rows are judged each; extra columns are dropped, whatever
their names.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strider.llm.common import ascii_lower, stage

#: (action, host, path); a rule fits its host and every subdomain, where the path starts with the rule's.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Words of unwanted pages: one in the url, or LEAST_WORDS different ones in the html, make a page a bad outcome.
BAD_WORDS = ("adult", "ads", "bets", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx")
LEAST_WORDS = 3
#: Second-level labels that, before a country's two letters, are part of the public suffix.
SHARED_LABELS = ("ac", "co", "com", "edu", "gov", "net", "org")
#: Reputations of so many hosts are broadcast; of more only those of hosts with a HOT_SHARE-th of the pages (so HOT_SHARE at most).
BROADCAST_HOSTS, HOT_SHARE = 200_000, 10_000


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    return ((host == rule[1]) | host.endswith(f".{rule[1]}")) & path.startswith(rule[2])


def rule_for(host: Column, path: Column, rules, what) -> Column:
    """The longest rule that fits, as what(rule); null where none does. Rules are a short, fixed list."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        out = F.when(fits(host, path, rule), F.lit(what(rule))).otherwise(out)
    return out


def name_of(host: Column) -> Column:
    """The host without user info, port and trailing dots."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.*(:[0-9]*)?$", "")


ADDRESS = r"^[0-9]+(\.[0-9]+){3}$|^\["
SHARED = rf"(^|\.)({'|'.join(SHARED_LABELS)})\.[a-z]{{2}}$"


def suffix_of(name: Column) -> Column:
    """The last label, or two where the last but one is shared under a country; numeric addresses have one suffix together."""
    return F.when(name.rlike(ADDRESS), "(address)").when(name.rlike(SHARED), F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))


def domain_of(name: Column) -> Column:
    """The registered domain: one label more than the suffix. (No public suffix list is at hand; pass another column if you have one.)"""
    return F.when(name.rlike(ADDRESS), name).when(name.rlike(SHARED), F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))


def outcome(url: Column, html: Column) -> Column:
    """1 where a page's own words show it to be unwanted, else 0: see BAD_WORDS."""
    bad = F.array(*map(F.lit, BAD_WORDS))
    found = lambda text: F.size(F.array_intersect(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "[^a-z]+"), bad))
    return ((found(url) > 0) | (found(html) >= LEAST_WORDS)).cast("int")


def lower_bound(a: Column, b: Column, confidence: float) -> Column:
    """The 1 - confidence quantile of beta(a, b), from its mean, variance, skewness and excess kurtosis, between 0 and the mean."""
    z, n, ab = NormalDist().inv_cdf(1 - confidence), a + b, a * b
    sd = F.sqrt(ab / (n + 1)) / n
    skew = 2 * (b - a) * F.sqrt(n + 1) / ((n + 2) * F.sqrt(ab))
    kurt = 6 * ((a - b) * (a - b) * (n + 1) - ab * (n + 2)) / (ab * (n + 2) * (n + 3))
    w = z + (z * z - 1) / 6 * skew + (z**3 - 3 * z) / 24 * kurt - (2 * z**3 - 5 * z) / 36 * skew * skew
    return F.greatest(F.lit(0.0), F.least(a / n, a / n + sd * w))


def shrink(groups: DataFrame, parent: str, mean: Column, floor: float, most: float) -> DataFrame:
    """Add `strength`: the beta-binomial prior's size for the groups (bad, n) below each parent, by moments.

    With m the parent's mean and s2 the size-weighted variance of the groups' rates around it, a beta-binomial has
    s2 = m(1-m)(1 + (k-1)rho) for groups of mean size k, rho = 1 / (strength + 1).
    """
    rate = F.col("bad") / F.col("n")
    fit = (
        groups.withColumn("m", mean)
        .groupBy(parent)
        .agg(
            F.sum(F.col("n") * (rate - F.col("m")) * (rate - F.col("m"))).alias("ss"),
            F.sum("n").alias("nn"),
            F.count(F.lit(1)).alias("g"),
            F.max("m").alias("mm"),
        )
    )
    var, k = F.col("ss") / F.col("nn"), F.col("nn") / F.col("g")
    spread = F.col("mm") * (1 - F.col("mm"))
    rho = F.when((spread > 0) & (k > 1), (var * k / spread - 1) / (k - 1)).otherwise(F.lit(0.0))
    strength = F.when(rho <= 0, F.lit(most)).otherwise(F.least(F.lit(most), F.greatest(F.lit(floor), 1 / rho - 1)))
    return fit.select(F.col(parent).alias(f"{parent}_"), strength.alias("strength"))


def reputation(
    labelled: DataFrame, base_rate: float = 0.5, base_strength: float = 2.0, floor: float = 1.0, most: float = 200.0
) -> tuple[DataFrame, DataFrame, DataFrame, tuple[float, float]]:
    """From (host, bad 0/1), hosts by name: posteriors (alpha, beta) by host, and by domain, suffix and for all the prior (alpha, beta)
    that each gives to a member without labels.

    `floor` and `most` bound a prior's strength, which moments of few groups leave at nothing or without end.
    Each level is one partial aggregation of the level below, so a hot host costs one row per task.
    """
    hosts = labelled.groupBy("host").agg(F.sum("bad").cast("double").alias("bad"), F.count(F.lit(1)).cast("double").alias("n"))
    hosts = stage(hosts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "bad", "n"), "hosts")
    domains = stage(hosts.groupBy("domain", "suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")), "domains")
    suffixes = stage(domains.groupBy("suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")), "suffixes")
    bad, n = suffixes.agg(F.coalesce(F.sum("bad"), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0.0))).first()
    mean = (bad + base_rate * base_strength) / (n + base_strength)
    fitted = shrink(suffixes.withColumn("all", F.lit(0)), "all", F.lit(mean), floor, most).first()
    strength = fitted["strength"] if fitted else base_strength

    def below(groups: DataFrame, pm: Column, s: Column, *keep: str) -> DataFrame:
        """Posteriors of groups under the prior of mean pm and size s."""
        return groups.select(*keep, (F.col("bad") + pm * s).alias("alpha"), (F.col("n") - F.col("bad") + (1 - pm) * s).alias("beta"))

    def prior(parents: DataFrame, key: str, groups: DataFrame) -> DataFrame:
        """What each parent gives its members: its posterior mean m, at the strength fitted over the groups below it."""
        up = parents.select(F.col(key).alias("up"), (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("m"))
        joined = groups.join(up, groups[key] == up["up"])
        fit = shrink(joined.select(key, "bad", "n", F.col("m").alias("pm")), key, F.col("pm"), floor, most)
        out = up.join(fit, up["up"] == fit[f"{key}_"])
        return out.select(F.col("up").alias(f"{key}_k"), F.col("m"), F.col("strength").alias("s"))

    by_suffix = below(suffixes, F.lit(mean), F.lit(strength), "suffix")
    suffix_prior = stage(prior(by_suffix, "suffix", domains), "suffix-prior")
    d = domains.join(suffix_prior, domains["suffix"] == suffix_prior["suffix_k"])
    domain_prior = stage(prior(below(d, F.col("m"), F.col("s"), "domain"), "domain", hosts), "domain-prior")
    h = hosts.join(domain_prior, hosts["domain"] == domain_prior["domain_k"])
    by_host = below(h, F.col("m"), F.col("s"), "host")
    split = lambda df, key: df.select(F.col(f"{key}_k").alias(key), (F.col("m") * F.col("s")).alias("alpha"), ((1 - F.col("m")) * F.col("s")).alias("beta"))
    return by_host, split(domain_prior, "domain"), split(suffix_prior, "suffix"), (mean * strength, (1 - mean) * strength)


def judge(
    pages: DataFrame,
    url: str = "url",
    rules=RULES,
    labelled: DataFrame | None = None,
    max_bad: float = 0.6,
    confidence: float = 0.9,
    keep: tuple[str, ...] = ("page_id",),
    html: str = "html",
) -> DataFrame:
    """Judge every url: host, path, the rule that fits, the verdict, and the posterior the method would use.

    labelled: (host, bad). By default every page is a labelled one, by `outcome` of its url and, where there is that column, html.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    h, p = F.col("host"), F.col("path")
    base = pages.select(*keep, host.alias("host"), path.alias("path")).select(
        *keep, "host", "path", name_of(h).alias("name"),
        rule_for(h, p, rules, lambda r: r[1] + r[2]).alias("rule"),
        rule_for(h, p, rules, lambda r: r[0]).alias("ruled"),
    )
    if labelled is None:
        source = F.col(html) if html in pages.columns else F.lit(None).cast("string")
        labelled = pages.select(host.alias("host"), outcome(F.col(url), source).alias("bad"))
    by_host, by_domain, by_suffix, (alpha, beta) = reputation(labelled.select(name_of(h).alias("host"), "bad"))

    # One row for each name that is asked for: the pages' own join is then a single one, on the name alone.
    n = F.col("name")
    asked = base.where(F.col("ruled").isNull()).groupBy("name").count().select("name", "count", domain_of(n).alias("domain"), suffix_of(n).alias("suffix"))

    def take(df: DataFrame, source: DataFrame, key: str, of: str, level: str) -> DataFrame:
        return df.join(
            source.select(F.col(of).alias(f"{level}_k"), F.col("alpha").alias(f"{level}_a"), F.col("beta").alias(f"{level}_b")),
            df[key] == F.col(f"{level}_k"),
            "left",
        ).drop(f"{level}_k")

    for source, key, of, level in ((by_host, "name", "host", "h"), (by_domain, "domain", "domain", "d"), (by_suffix, "suffix", "suffix", "s")):
        asked = take(asked, source, key, of, level)
    a, b = F.coalesce("h_a", "d_a", "s_a", F.lit(alpha)), F.coalesce("h_b", "d_b", "s_b", F.lit(beta))
    bounds = F.round(a / (a + b), 6).alias("bad_rate"), F.round(lower_bound(a, b, confidence), 6).alias("bad_bound")
    asked = stage(asked.select(F.col("name").alias("asked"), "count", *bounds), "asked")
    out = with_reputation(base, asked)
    by_method = F.when(F.col("bad_bound") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        *keep, "host", "path", "rule", F.coalesce("ruled", by_method).alias("verdict"),
        F.when(F.col("ruled").isNull(), F.col("bad_rate")).alias("bad_rate"),
        F.when(F.col("ruled").isNull(), F.col("bad_bound")).alias("bad_bound"),
    )


def with_reputation(base: DataFrame, asked: DataFrame) -> DataFrame:
    """The pages with their name's bounds. Beyond BROADCAST_HOSTS only the few names with many pages are broadcast, so that
    none of them meets in one task; the pages of the others are shuffled by name."""
    there = asked.agg(F.count(F.lit(1)).alias("names"), F.coalesce(F.sum("count"), F.lit(0)).alias("pages")).first()
    one = F.col("name") == F.col("asked")
    if there["names"] <= BROADCAST_HOSTS:
        return base.join(F.broadcast(asked), one, "left")
    often = F.col("count") * HOT_SHARE >= there["pages"]
    hot = F.broadcast(asked.where(often))
    return base.join(hot, one).unionByName(base.join(hot, one, "left_anti").join(asked.where(~often), one, "left"))
